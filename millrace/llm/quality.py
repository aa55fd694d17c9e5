"""Quality rules: robust multivariate outliers of text statistics, per language and source.

Every text is measured whole. The measures become a vector whose parts are close to symmetric (logarithms and roots of rates). For
every language and source the minimum-covariance-determinant estimate of place and spread is found by concentration steps
over all its documents: distances from the present estimate, the share ``h`` with the smallest ones, their mean and
covariance, again. Two deterministic starts (medians with median deviations; plain mean and covariance) are followed and
the smaller determinant wins. A document is rejected where its squared Mahalanobis distance, scaled so that the group's
median is that of a chi-square, exceeds ``cutoff``; documents that fail the base rule are rejected and take no part in the estimate.

A group is never gathered: each step is a grouped sum and an approximate percentile (rank error 1e-4), reduced where rows are read.

Defined cases: null and empty texts have no words and fail the base rule; null language or source is a group of its own; groups under
``least_rows`` documents are judged by the estimate of their language, then of all documents, and keep what the base rule keeps if that has too few as
well; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stored
from millrace.llm.words import NOT_SPACE, find_words, mixed, run_starts, runs_of_words, slices

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
WINDOW_WORDS = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CONTINUES = np.array([0x80 <= b < 0xC0 for b in range(256)])
_BLANK = " \t\n\v\f\r"

DIMENSIONS = 5
#: Median of the chi-square distribution with five degrees of freedom.
CHI_SQUARE_MEDIAN = 4.351
#: Its 0.999 quantile.
CHI_SQUARE_FAR = 20.515


@dataclass(frozen=True)
class Rule:
    h: float = 0.75
    steps: int = 4
    least_rows: int = 50
    #: least spread of a part, so that a part that is constant in most documents doesn't reject the rest
    least_spread: float = 0.25
    #: by how much the tails of real texts, above all of their lengths, exceed those of the chi-square distribution (README)
    tail: float = 3.0

    @property
    def cutoff(self) -> float:
        return self.tail * CHI_SQUARE_FAR


def _repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line; lines with a word."""
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return len(lines) - len(set(lines)), len(lines)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    words = find_words(column, NOT_SPACE)
    within = NOT_SPACE[words.data] & ~_CONTINUES[words.data]
    starts = run_starts(words, WINDOW_WORDS)
    of_text = words.text_of_word
    runs = runs_of_words(words.hashes, WINDOW_WORDS)[starts] ^ mixed(of_text[starts].astype(np.uint64))
    _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
    change = np.zeros(len(words.hashes) + 1, np.int64)
    again = starts[times[which] > 1]
    change[again] += 1
    change[again + WINDOW_WORDS] -= 1
    lines = np.array([_repeated_lines(t or "") for t in column.to_pylist()], np.int64).reshape(-1, 2)
    return {
        "n_words": words.counts,
        "word_chars": _per_text(within, words.offsets),
        "n_symbols": _per_text(_SYMBOL[words.data], words.offsets),
        "n_dup_lines": lines[:, 0],
        "n_repeat_words": _per_text(np.cumsum(change[:-1]) > 0, words.first),
        "n_lines": lines[:, 1],
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of each text. One narrow pass."""
    rows = docs.select("doc_id", "lang", "source", docs["text"].cast("string").alias("text"))
    kept = rows.drop("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = measures(part.column(3))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *(pa.array(found[m].astype(np.int64)) for m in MEASURES)],
                    names=["doc_id", "lang", "source", *MEASURES],
                )

    return rows.mapInArrow(run, fields + "".join(f", {m} long" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vector() -> list[Column]:
    words, chars = F.col("n_words") + 1.0, F.col("word_chars") + 1.0
    return [
        F.log(words),
        4 * F.log(chars / words),
        4 * F.sqrt(F.col("n_symbols") / chars),
        2 * F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 1.0)),
        2 * F.sqrt(F.col("n_repeat_words") / words),
    ]


_PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
GROUP = ["lang", "source"]


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from ``place`` with the inverse spread ``inverse`` (row by row)."""
    off = [F.col("x")[i] - F.col("place")[i] for i in range(DIMENSIONS)]
    terms = [off[i] * off[j] * F.col("inverse")[i * DIMENSIONS + j] * (1 if i == j else 2) for i, j in _PAIRS]
    return sum(terms[1:], terms[0])


def _with_estimate(rows: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    right = estimate.withColumnsRenamed({c: f"e_{c}" for c in GROUP})
    return rows.join(right, [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in GROUP], how).drop(*[f"e_{c}" for c in GROUP])


def _estimates(sums: DataFrame, least_spread: float) -> DataFrame:
    """place, inverse and log determinant of each group and start from its sums."""

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"place": [], "inverse": [], "log_det": []}
            for row in frame.itertuples(index=False):
                place = np.array(row.sums) / row.n
                spread = np.zeros((DIMENSIONS, DIMENSIONS))
                for (i, j), s in zip(_PAIRS, row.products, strict=True):
                    spread[i, j] = spread[j, i] = s / row.n - place[i] * place[j]
                values, axes = np.linalg.eigh(spread)
                values = np.maximum(values, least_spread**2)
                out["place"].append(place.tolist())
                out["inverse"].append(((axes / values) @ axes.T).ravel().tolist())
                out["log_det"].append(float(np.log(values).sum()))
            yield frame[[*GROUP, "start"]].assign(**out)

    kinds = {f.name: f.dataType.simpleString() for f in sums.schema}
    fields = ", ".join(f"{c} {kinds[c]}" for c in [*GROUP, "start"])
    return sums.mapInPandas(solve, f"{fields}, place array<double>, inverse array<double>, log_det double")


def _sums(rows: DataFrame) -> DataFrame:
    x = [F.col("x")[i] for i in range(DIMENSIONS)]
    return rows.groupBy(*GROUP, "start").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("sums"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in _PAIRS]).alias("products"),
    )


def robust_estimates(rows: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """lang, source, place, inverse, scale: the estimate of each group of at least ``least_rows`` rows with a vector ``x``."""
    sized = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.percentile_approx(F.col("x")[i], 0.5, 10_000).alias(f"m{i}") for i in range(DIMENSIONS)
    ]).where(F.col("n_rows") >= rule.least_rows)
    medians = sized.select(*GROUP, F.array(*[f"m{i}" for i in range(DIMENSIONS)]).alias("place"))
    medians = stored(medians, "mcd-medians")
    away = _with_estimate(rows, medians).groupBy(*GROUP).agg(*[
        F.percentile_approx(F.abs(F.col("x")[i] - F.col("place")[i]), 0.5, 10_000).alias(f"d{i}") for i in range(DIMENSIONS)
    ])
    weight = [F.pow(F.greatest(1.4826 * F.col(f"d{i}"), F.lit(rule.least_spread)), -2) for i in range(DIMENSIONS)]
    zero = F.lit(0.0)
    away = away.select(*GROUP, F.array(*[weight[i] if i == j else zero for i in range(DIMENSIONS) for j in range(DIMENSIONS)]).alias("inverse"))
    by_medians = _with_estimate(medians, away).select(*GROUP, F.lit(0).alias("start"), "place", "inverse", zero.alias("log_det"))
    plain = _estimates(_sums(_with_estimate(rows, medians).drop("place").withColumn("start", F.lit(1))), rule.least_spread)
    estimate = stored(by_medians.unionByName(plain), "mcd-start")
    for _ in range(rule.steps):
        far = _with_estimate(rows, estimate).select(*GROUP, "start", "x", _distance().alias("d"))
        edge = far.groupBy(*GROUP, "start").agg(F.percentile_approx("d", rule.h, 10_000).alias("edge"))
        edge = edge.withColumnsRenamed({c: f"g_{c}" for c in [*GROUP, "start"]})
        near = far.join(edge, [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in [*GROUP, "start"]]).where("d <= edge")
        estimate = stored(_estimates(_sums(near), rule.least_spread), "mcd-step")
    best = estimate.groupBy(*GROUP).agg(
        F.min_by(F.struct("place", "inverse"), F.struct("log_det", "start")).alias("best")
    ).select(*GROUP, "best.place", "best.inverse")
    scale = _with_estimate(rows, best).groupBy(*GROUP).agg(
        (F.greatest(F.percentile_approx(_distance(), 0.5, 10_000), F.lit(1e-6)) / CHI_SQUARE_MEDIAN).alias("scale")
    )
    return _with_estimate(best, scale)


def _of_small_groups(rows: DataFrame, estimate: DataFrame, rule: Rule) -> DataFrame:
    """For groups without an estimate, the one of their language, or else of all rows; a group without either has none."""
    names = rows.schema["lang"].dataType, rows.schema["source"].dataType
    any_lang, any_source = F.lit(None).cast(names[0]), F.lit(None).cast(names[1])
    found = estimate.select(*GROUP, F.lit(True).alias("found"))
    small = stored(_with_estimate(rows.select(*GROUP).distinct(), found, "left").where("found IS NULL").drop("found"), "mcd-small")
    if small.isEmpty():
        return estimate
    languages = small.select(F.col("lang").alias("l")).distinct()
    of_language = rows.join(languages, F.col("lang").eqNullSafe(F.col("l")), "left_semi").withColumn("source", any_source)
    by_language = stored(robust_estimates(of_language, rule), "mcd-language").drop("source").withColumnRenamed("lang", "l")
    placed = stored(small.join(by_language, F.col("lang").eqNullSafe(F.col("l")), "left").drop("l"), "mcd-placed")
    left = placed.where("place IS NULL").select(*GROUP)
    estimate = estimate.unionByName(placed.where("place IS NOT NULL"))
    if left.isEmpty():
        return estimate
    of_all = robust_estimates(rows.withColumns({"lang": any_lang, "source": any_source}), rule).drop(*GROUP)
    return estimate.unionByName(left.crossJoin(of_all))


def judge(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Measures, base_failed, distance (null without an estimate) and kept for every document."""
    rows = stored(measure(docs), "quality-measures").withColumn("base_failed", base_failed())
    rows = rows.withColumn("x", F.array(*vector()))
    judged = rows.where(~F.col("base_failed"))
    estimate = stored(robust_estimates(judged, rule), "mcd-groups")
    estimate = stored(_of_small_groups(judged, estimate, rule), "mcd-final")
    far = _with_estimate(rows, estimate, "left").withColumn("distance", _distance() / F.col("scale"))
    inside = F.coalesce(F.col("distance") <= rule.cutoff, F.lit(True))
    return far.withColumn("kept", ~F.col("base_failed") & inside).drop("x", "place", "inverse", "scale")
