"""Toxicity by class-conditional Kneser-Ney models of expressions.

Two models, one of toxic and one of ordinary labelled texts, give the likelihood of an expression, which is a word of any length, or a character of a script without
spaces. A model counts the texts of its class that hold the expression, takes a discount from each count, and spreads what it took in proportion to
the shared backoff counts, those of both classes together. So an expression that one class never had, or that both had seldom, is judged by how often it was met at all, and one
that nobody met says the same for every text.

The log-likelihoods of both models are compared per expression, and normalised by length twice: over the few strongest different expressions of a text, so a short
insult in a long text still shows, and over all its words. The score is a logistic function of the two, fitted on labelled texts.

Counts are summed up by Spark over all labelled texts, every expression under a 64-bit key of its own, and stay a Spark table. If its measured size
allows, tasks get it whole; otherwise the different expressions of each different text are joined to it.

Defined cases: null and empty texts have no expressions and get the score of a text without any sign; a document with several labels counts as toxic
if one says so; labels that are null or of unknown documents are left out; without labels of both classes every score is the share of toxic labels, or 0;
repeated rows are scored each; language, source and id are no inputs; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import counted, stored
from millrace.llm.words import slices, text_bytes

_KEY = "millrace_toxic__"
_SLICE_BYTES = 1 << 20
_SEPARATORS = r"[^\p{L}\p{N}]+"
#: Scripts that don't part words by spaces, and the first bytes of their characters in UTF-8.
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
_UNSPACED_BYTES = np.array([b in (0xE0, 0xE1) or 0xE3 <= b <= 0xED or b == 0xF0 for b in range(256)])
HELD_OUT = 1
SECOND_PART = 2
THRESHOLD = 0.7

SIGNS, SCORE = ("__toxicity_strongest", "__toxicity_mean"), "__toxicity_score"
FOUND, DIGEST = "__toxicity_found", ("__toxicity_d1", "__toxicity_d2")


@dataclass(frozen=True)
class Settings:
    #: tables of counts of more expressions than this (24 bytes each) are joined, not broadcast
    broadcast_entries: int = 4_000_000
    discount: float = 0.75
    #: how many different expressions of a text are its strongest ones
    strongest: int = 2


def held_out() -> Column:
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == HELD_OUT) & F.col("doc_id").isNotNull()


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of all labelled documents outside the held-out part."""
    rows = labels.where(labels["doc_id"].isNotNull() & labels["toxic"].isNotNull() & ~held_out())
    return rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words of all texts, and where each text begins among them (empty pieces included)."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    if _UNSPACED_BYTES[text_bytes(texts)[0]].any():
        texts = pc.replace_substring_regex(texts, _UNSPACED, r" \1 ")
    parts = pc.split_pattern(pc.replace_substring_regex(texts, _SEPARATORS, " "), " ")
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return parts.flatten(), first


def _word_counts(texts: DataFrame) -> DataFrame:
    """word and n0 .. n3: in how many texts of each kind each word is. kind = 2 * (in the second part) + toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=_SLICE_BYTES):
                words, first = words_of(part.column(0))
                coded = words.dictionary_encode()
                n = max(1, len(coded.dictionary))
                text = np.repeat(np.arange(part.num_rows), np.diff(first))
                once = np.unique(text * n + coded.indices.to_numpy(zero_copy_only=False))
                kind = part.column(1).to_numpy(zero_copy_only=False)[once // n]
                counts = [np.bincount((once % n)[kind == k], minlength=len(coded.dictionary)) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.cast(pa.string()), *map(pa.array, counts)], names=["word", "n0", "n1", "n2", "n3"]
                )

    counted = texts.mapInArrow(run, "word string, n0 long, n1 long, n2 long, n3 long").groupBy("word")
    return counted.agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(4)])


def _keys(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.cast(pa.string()).to_numpy(zero_copy_only=False), hash_key=_KEY, categorize=False).view(np.int64)


@dataclass
class Counts:
    """Counts of expressions of both classes. ``rows`` (key, c0, c1) holds all; ``table`` the same, sorted by key, where it could be broadcast."""

    rows: DataFrame
    table: object
    #: per class, the sum of counts and what the discount takes of it; the number of different expressions
    total: np.ndarray
    spare: np.ndarray
    different: int

    def destroy(self) -> None:
        if self.table is not None:
            self.table.destroy()


def _counts(words: DataFrame, settings: Settings) -> Counts:
    """Counts of both classes from columns word, n0 and n1, one row for every expression that either has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_keys(batch.column(0))), batch.column(1), batch.column(2)], names=["key", "c0", "c1"])

    keyed = words.select("word", "n0", "n1").where("n0 + n1 > 0").mapInArrow(run, "key long, c0 long, c1 long")
    rows = stored(keyed.groupBy("key").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "toxicity-counts")
    sums = [F.count(F.lit(1)).alias("different")]
    for k in (0, 1):
        sums += [F.sum(f"c{k}").alias(f"total{k}"), F.sum(F.least(F.col(f"c{k}"), F.lit(settings.discount))).alias(f"spare{k}")]
    r = rows.agg(*sums).first()
    table = None
    if r["different"] <= settings.broadcast_entries:
        found = rows.toArrow()
        key, *counts = (found.column(c).to_numpy() for c in ("key", "c0", "c1"))
        order = np.argsort(key)
        table = words.sparkSession.sparkContext.broadcast((key[order], np.stack(counts)[:, order]))
    total, spare = (np.array([float(r[f"{name}{k}"] or 0) for k in (0, 1)]) for name in ("total", "spare"))
    return Counts(rows, table, total, spare, r["different"])


def _looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Counts (class, expression) of the keys; 0 where the table has none."""
    own, counts = table
    out = np.zeros((2, len(keys)))
    if len(own):
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        met = own[at] == keys
        out[:, met] = counts[:, at[met]]
    return out


def log_ratios(counts: np.ndarray, total: np.ndarray, spare: np.ndarray, different: int, discount: float) -> np.ndarray:
    """Log of toxic over ordinary likelihood of expressions from their counts (class, expression)."""
    # the share of an expression in both classes together, with half a count for what was never met
    shared = (counts.sum(axis=0) + 0.5) / (total.sum() + different / 2)
    likely = np.maximum(counts - discount, 0.0) / total[:, None] + (spare / total)[:, None] * shared
    return np.log(likely[1]) - np.log(likely[0])


class Scorer:
    """Signs of texts under given totals; the counts of their expressions come with them."""

    def __init__(self, counts: Counts, settings: Settings) -> None:
        self.model, self.settings = (counts.total, counts.spare, counts.different, settings.discount), settings
        self.unknown = float(log_ratios(np.zeros((2, 1)), *self.model)[0])

    def signs(self, texts: pa.Array, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, the mean log-likelihood ratio of its strongest different expressions, unknown ones where there are too few, and of all its words, 0 without any."""
        words, first = words_of(texts)
        coded = words.dictionary_encode()
        ratio = log_ratios(_looked_up(table, _keys(coded.dictionary)), *self.model)
        index = coded.indices.to_numpy(zero_copy_only=False)
        n_texts, text = len(first) - 1, np.repeat(np.arange(len(first) - 1), np.diff(first))
        # pieces between separators may be empty; they are no words
        full = (pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0)[index] if len(index) else np.zeros(0, bool)
        index, text = index[full], text[full]
        sizes = np.bincount(text, minlength=n_texts)
        mean = np.bincount(text, ratio[index], n_texts) / np.maximum(sizes, 1)
        once = np.unique(text * max(1, len(ratio)) + index)
        text, value = once // max(1, len(ratio)), ratio[once % max(1, len(ratio))]
        order = np.lexsort((-value, text))
        text, value = text[order], value[order]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        top = rank < self.settings.strongest
        held = np.bincount(text[top], minlength=n_texts)
        strongest = np.bincount(text[top], value[top], n_texts) + (self.settings.strongest - held) * self.unknown
        return strongest / self.settings.strongest, mean


def _wanted_keys(rows: DataFrame) -> DataFrame:
    """Digest of each different text and the keys of its expressions, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=_SLICE_BYTES):
                words, first = words_of(part.column(2))
                coded = words.dictionary_encode()
                keys = _keys(coded.dictionary)
                index = coded.indices.to_numpy(zero_copy_only=False)
                for d in range(part.num_rows):
                    wanted = np.unique(keys[np.unique(index[first[d] : first[d + 1]])])
                    digest = [part.column(k).slice(d, 1).take(pa.array(np.zeros(len(wanted), np.int64))) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*digest, pa.array(wanted)], names=["d1", "d2", "key"])

    texts = rows.where(F.length("text") > 0).select(*_digests(), "text").dropDuplicates(["d1", "d2"])
    return texts.mapInArrow(run, "d1 long, d2 long, key long")


def _digests() -> list[Column]:
    return [F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), F.col("text")).alias("d2")]


def _signs(rows: DataFrame, counts: Counts, settings: Settings) -> DataFrame:
    """The rows, text included, with both signs of each text. Rows keep their columns whatever their names; none but the text is looked at."""
    fields = [*rows.schema.fields, *(T.StructField(sign, T.DoubleType()) for sign in SIGNS)]
    text, table, scorer = rows.columns.index("text"), counts.table, Scorer(counts, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=_SLICE_BYTES):
                signs = map(pa.array, scorer.signs(part.column(text), table.value))
                yield pa.RecordBatch.from_arrays([*part.columns, *signs], names=[*part.schema.names, *SIGNS])

    if table is not None:
        return rows.mapInArrow(run, T.StructType(fields))

    # the table is large: each text comes with the counts of its own expressions
    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=_SLICE_BYTES):
                signs, found = np.zeros((2, part.num_rows)), part.column(part.num_columns - 1)
                for d in range(part.num_rows):
                    own = found[d].values
                    if own is None or not len(own):
                        own = pa.StructArray.from_arrays([pa.array([], pa.int64())] * 3, names=["key", "c0", "c1"])
                    key, *c = (x.to_numpy(zero_copy_only=False) for x in own.flatten())
                    order = np.argsort(key)
                    signs[:, d] = [x[0] for x in scorer.signs(part.column(text).slice(d, 1), (key[order], np.stack(c)[:, order]))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, signs)], names=[*part.schema.names[:-1], *SIGNS])

    found = _wanted_keys(rows).join(counts.rows, "key").groupBy(
        F.col("d1").alias(DIGEST[0]), F.col("d2").alias(DIGEST[1])
    ).agg(F.collect_list(F.struct("key", "c0", "c1")).alias(FOUND))
    with_digest = rows.withColumns(dict(zip(DIGEST, _digests(), strict=True)))
    return with_digest.join(found, list(DIGEST), "left").select(*(f"`{c}`" for c in rows.columns), FOUND).mapInArrow(run_joined, T.StructType(fields))


def _logistic(bins: list) -> np.ndarray:
    """Weights and bias of a logistic function, by Newton's method over (values.., toxic, rows), with a slight pull of the weights to zero."""
    *x, y, n = (np.array(c, float) for c in zip(*bins, strict=True))
    x = np.stack([*x, np.ones(len(y))], axis=1)
    w, pull = np.zeros(x.shape[1]), np.diag([0.1] * (x.shape[1] - 1) + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (p - y)) + pull @ w
        h = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + pull
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


#: Steps of the signs in the fit, so that what comes to the driver does not grow with the number of labelled texts.
_STEP = 0.02


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()):
    """Counts and the logistic function from the labelled documents outside the held-out part: (counts or None, weights and bias).

    The logistic function is fitted where the counts don't know the texts: counts of one part, texts of the other.
    """
    chosen = training_labels(labels)
    texts = docs.select("doc_id", docs["text"].cast("string").alias("text")).join(counted(chosen), "doc_id").select("text", "toxic", "doc_id")
    second = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == SECOND_PART
    texts = texts.withColumn("kind", (F.col("toxic") + F.when(second, 2).otherwise(0)).cast("int"))
    words = stored(_word_counts(texts.select("text", "kind")).where("word <> ''"), "toxicity-words")
    totals = words.agg(*[F.sum(f"n{k}") for k in range(4)]).first()
    n = [totals[k] or 0 for k in range(4)]
    if not n[0] + n[2] or not n[1] + n[3]:
        share = chosen.agg(F.avg("toxic")).first()[0]
        return None, np.array([0.0, 0.0, float(share or 0.0)])
    everything = words.select("word", (F.col("n0") + F.col("n2")).alias("n0"), (F.col("n1") + F.col("n3")).alias("n1"))
    counts = _counts(everything, settings)
    apart = all(n)
    known = _counts(words, settings) if apart else counts
    rows = texts.where("kind >= 2") if apart else texts
    steps = [F.floor(F.col(sign) / _STEP).alias(sign) for sign in SIGNS]
    bins = _signs(rows.select("toxic", "text"), known, settings).groupBy(*steps, "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    if apart:
        known.destroy()
    return counts, _logistic([(*((r[sign] + 0.5) * _STEP for sign in SIGNS), r["toxic"], r["n"]) for r in bins])


def _scored(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """The documents with a column ``SCORE``, whose name no table has."""
    counts, weights = train(docs, labels, settings)
    bias = F.lit(float(weights[-1]))
    if counts is None:
        return docs.withColumn(SCORE, bias)
    z = sum((F.lit(float(w)) * F.col(sign) for w, sign in zip(weights, SIGNS, strict=False)), bias)
    return _signs(docs, counts, settings).withColumn(SCORE, 1 / (1 + F.exp(-z))).drop(*SIGNS)


def with_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents with score (0 to 1) and predicted (1 from THRESHOLD). Columns of these two names are replaced."""
    scored = _scored(docs.drop("score", "predicted"), labels, settings)
    return scored.withColumn("predicted", (F.col(SCORE) >= THRESHOLD).cast("int")).withColumnRenamed(SCORE, "score")


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents whose score is below THRESHOLD, with all their columns."""
    return _scored(docs, labels, settings).where(F.col(SCORE) < THRESHOLD).select(docs.columns)


def score(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, score and predicted of every document; other columns are not read."""
    return with_scores(docs.select("doc_id", docs["text"].cast("string").alias("text")), labels, settings).drop("text")
