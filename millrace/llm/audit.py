"""How filters interact: what each removes in every order, from a removal game over the sets of filters.

A filter fails a document; what a set of filters removes is what at least one of them fails. So all that is asked of any order follows from
how many documents fail exactly which filters: 32 numbers for five filters, per part of the corpus. Documents are reduced to that histogram where they are
read, and only the filter for repeated texts needs the other documents.

The worth v(S) of a set of filters S is what they remove. The Hart-Mas-Colell potential is P() = 0 and P(S) = (v(S) + sum of P(S without i) over i in S) / |S|; the Shapley value
of filter i is P(all) - P(all without i). Sixty times a potential is a whole number for five filters, so 120 Shapley values, the sum of a filter's removals
over all 120 orders, are exact. The steps of an order are differences of v between the sets before and after them.

Defined cases: null texts are empty, null parts the empty string; labels that are null count as 0, and of several labels of an id the highest counts; a text is a repetition
if a row with a smaller id has it, so rows that share the id are none of each other, and rows without id neither are nor make repetitions; each row counts.
An empty table has no parts. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stored

FILTERS = "ABCDE"
KINDS = ("all", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def own_failures(text: Column) -> list[Column]:
    """Of one text alone: short, few different words, many capitals, symbols."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    return [
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part and fails (a bit for each filter) of every row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    bits = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(own_failures(text))), F.lit(0))
    part = F.coalesce(docs["source"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), part.alias("part"), bits.alias("fails"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    rows = stored(rows, "audit-rows")
    # only texts that two ids have can be repetitions; a text that a third of all rows have is one row here
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id").drop("last_id")
    repeats = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return rows.join(first, "digest", "left").select("doc_id", "part", (F.col("fails") + F.when(repeats, 1 << 4).otherwise(0)).alias("fails"))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails and how many documents, good ones and toxic ones there are."""
    marks = labels.where(labels["doc_id"].isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(labels["quality"] == 1, F.lit(False))).alias("good"), F.max(F.coalesce(labels["toxic"] == 1, F.lit(False))).alias("toxic")
    )
    marked = failures(docs).join(marks.where("good OR toxic"), "doc_id", "left")
    count = lambda name: F.count(F.when(F.col(name), 1)).alias(name)
    return marked.groupBy("part", "fails").agg(F.count(F.lit(1)).alias("all"), count("good"), count("toxic"))


def worths(counts: np.ndarray) -> np.ndarray:
    """v(S) along the last axis: how many documents fail a filter of S, from how many fail exactly each set."""
    n = counts.shape[-1]
    sets = np.arange(n)
    met = (sets[:, None] & sets[None, :]) > 0
    return counts @ met.astype(np.int64)


def scaled_potentials(v: np.ndarray) -> tuple[np.ndarray, int]:
    """Potentials of all sets along the last axis times a factor that makes them whole, and the factor."""
    n = v.shape[-1]
    size = n.bit_length() - 1
    factor = lcm(*range(1, size + 1))
    out = np.zeros_like(v)
    for coalition in range(1, n):
        members = [coalition ^ (1 << k) for k in range(size) if coalition >> k & 1]
        out[..., coalition] = (factor * v[..., coalition] + out[..., members].sum(axis=-1)) // len(members)
    return out, factor


def all_steps(counts: np.ndarray) -> list[tuple[str, int, np.ndarray]]:
    """(order, step, numbers by part in the order of COUNTS) from counts (part, kind, set that fails)."""
    v = worths(counts)
    n_docs, everything = counts.sum(axis=-1), v.shape[-1] - 1
    potential, factor = scaled_potentials(v[:, 0])
    per_order = factorial(len(FILTERS)) // factor
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            lost = v[:, :, after] - v[:, :, before]
            without = everything ^ (1 << k)
            out.append((
                "".join(FILTERS[x] for x in order), step,
                np.stack([
                    n_docs[:, 0] - v[:, 0, after], lost[:, 0], v[:, 0, 1 << k] - lost[:, 0], v[:, 0, everything] - v[:, 0, without],
                    lost[:, 1], lost[:, 2], per_order * (potential[:, everything] - potential[:, without]),
                ], axis=1),
            ))
            before = after
    return out


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and COUNTS: a row for every part, order of the filters and step."""
    held = failure_counts(docs, labels)
    sets = range(1 << len(FILTERS))
    slot = lambda kind, s: F.sum(F.when(F.col("fails") == s, F.col(kind)).otherwise(0)).alias(f"{kind}_{s}")
    by_part = held.groupBy("part").agg(*[slot(kind, s) for kind in KINDS for s in sets])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: Sequence = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, batch.num_columns)]
            counts = np.stack(columns, axis=1).reshape(batch.num_rows, len(KINDS), len(sets)).astype(np.int64)
            for order, step, numbers in all_steps(counts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([order] * batch.num_rows), pa.array(np.full(batch.num_rows, step, np.int32)), *(pa.array(numbers[:, c]) for c in range(len(COUNTS)))],
                    names=["part", "filter_order", "step", *COUNTS],
                )

    return by_part.mapInArrow(run, ", ".join(["part string, filter_order string, step int", *(f"{c} long" for c in COUNTS)]))
