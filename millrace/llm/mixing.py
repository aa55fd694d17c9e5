"""Mixing sources to target weights by Poisson replication, by DataFrame functions alone.

Each source is to hold a share of the mixture, in characters of text, given by its weight. The rate of a source is how often its
documents must be repeated on average for that. How often one document is repeated is the inverse of the Poisson distribution with that mean at a number
in [0, 1) hashed from seed and document: the same on every run, independent of partitions, without any sum over documents but the sizes of the sources.
Copies are then put in the order of a second hash, a global shuffle.

The distribution is tabulated once per source, up to where the rest is below 2**-53.

Defined cases: null texts have no characters; documents without source are a source of their own; sources that are not listed have ``other``
as weight; a source of empty texts alone has rate 1; documents that share an id share their number of copies; documents without
id are hashed by the word null; further columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stored

_BITS = 52
RATE, COPY, KEY = "__mix_rate", "__mix_copy", "__mix_key"
_SOURCE, _TABLE, _COPIES = "__mix_source", "__mix_table", "__mix_copies"


def hashed(seed: str, *parts: Column) -> Column:
    """A whole number below 2**52 from the MD5 of seed and parts, joined by slashes."""
    text = F.concat_ws("/", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: dict[str, float], other: float = 1.0, size: float = 1.0) -> DataFrame:
    """source, n_chars, rate. ``size``: characters of the mixture as a share of the characters of all documents."""
    chars = docs.groupBy("source").agg(F.sum(F.length(F.coalesce(docs["text"], F.lit(""))).cast("long")).alias("chars"))
    listed = F.create_map(*[F.lit(x).cast("string" if k % 2 == 0 else "double") for k, x in enumerate(i for kv in weights.items() for i in kv)]) if weights else None
    weight = F.coalesce(listed[F.col("source")], F.lit(other)) if weights else F.lit(other)
    chars = stored(chars.withColumn("weight", weight), "mixing-sources")
    all_chars, all_weight = chars.agg(F.sum("chars"), F.sum("weight")).first()
    rate = F.lit(float(all_chars or 0)) * F.lit(size) * F.col("weight") / F.lit(all_weight or 1.0) / F.col("chars")
    return chars.select("source", "chars", F.when(F.col("chars") > 0, rate).otherwise(1.0).alias("rate"))


def poisson_table(rate: Column) -> Column:
    """The distribution function at 0, 1, 2, ... in logarithms term by term, so large rates don't vanish."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    walked = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct((-rate).alias("log_p"), F.array(F.exp(-rate)).alias("sums")),
        lambda acc, k: F.struct(
            (acc["log_p"] + F.log(rate / k)).alias("log_p"),
            F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + F.exp(acc["log_p"] + F.log(rate / k)))).alias("sums"),
        ),
        lambda acc: acc["sums"],
    )
    return F.when(rate > 0, walked).otherwise(F.array(F.lit(1.0)))


def _replicated(docs: DataFrame, weights: dict[str, float], other: float, size: float, seed: str) -> DataFrame:
    """The documents' copies with ``RATE``, ``COPY`` and ``KEY``, in the order of the key. No table has columns of these names."""
    rates = source_rates(docs.select("source", docs["text"].cast("string").alias("text")), weights, other, size)
    rates = rates.select(F.col("source").alias(_SOURCE), F.col("rate").alias(RATE), poisson_table(F.col("rate")).alias(_TABLE))
    placed = docs.join(rates, docs["source"].eqNullSafe(rates[_SOURCE]))
    share = hashed(seed, F.col("doc_id")) / F.lit(float(1 << _BITS))
    # the share is made once per document, not once per entry of the table
    copies = F.transform(F.array(share), lambda s: F.size(F.filter(_TABLE, lambda c: c <= s)))[0]
    placed = placed.withColumn(_COPIES, copies).where(F.col(_COPIES) > 0)
    placed = placed.withColumn(COPY, F.explode(F.sequence(F.lit(1), F.col(_COPIES)))).drop(_SOURCE, _TABLE, _COPIES)
    keyed = placed.withColumn(KEY, hashed(f"{seed}/order", F.col("doc_id"), F.col(COPY)))
    return keyed.orderBy(KEY, "doc_id", COPY)


def mix(docs: DataFrame, weights: dict[str, float], other: float = 1.0, size: float = 1.0, seed: str = "mix") -> DataFrame:
    """The documents' copies with copy, rate and shuffle_key, in the order of shuffle_key. Columns of these three names are replaced."""
    mixed = _replicated(docs.drop("copy", "rate", "shuffle_key"), weights, other, size, seed)
    return mixed.withColumnsRenamed({RATE: "rate", COPY: "copy", KEY: "shuffle_key"})


def mix_rows(docs: DataFrame, weights: dict[str, float], other: float = 1.0, size: float = 1.0, seed: str = "mix") -> DataFrame:
    """The copies with the columns of the documents alone, whatever their names."""
    return _replicated(docs, weights, other, size, seed).drop(RATE, COPY, KEY)
