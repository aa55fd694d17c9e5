"""Vector codes: the parts of a vector replaced by the nearest entries of trained codebooks, searched in tries over the distinct parts.

Components become integers, vectors are cut into consecutive parts, and each part position has a codebook of its own. The parts that occur are grouped with
their counts and sorted. Sorted parts are a trie: those with a common beginning are neighbours. A walk, depth first, holds at each node the squared
distances of the beginning to all entries; a child adds one dimension to its parent's. Below the last branching a part's remaining dimensions are
added at once. A leaf takes the smallest distance, ties to the lower entry, and adds its part to the entry's sums as often as it occurs.

Rounds run over the stored distinct parts, and a task returns sums per entry only. Codebooks go through the driver: their size depends on the
dimensions, not on the number of vectors. The last assignment walks a trie of each batch of vectors, so no vector is shuffled for it.

Defined cases: vectors that are null or hold null or non-finite components are left out, and so are those with components that scaled reach 2**53, which are no
exact integers. Lengths that can't be divided give parts that differ by one. The vector of the smallest id sets the length; rows of another length have null as
code and error. Rows without id come after all others, rows that share an id in the order of their vectors. Fewer vectors than entries make smaller codebooks.
Sums are exact at any size; an error beyond 2**63 - 1 is given as that. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stored

_EXACT = 1 << 53
_LARGEST = (1 << 63) - 1
_AT_ONCE = 2048


@dataclass(frozen=True)
class Coding:
    parts: int = 4
    #: at most 256, so an index has two hex digits
    entries: int = 256
    rounds: int = 4
    scale: int = 1024

    def cuts(self, width: int) -> list[int]:
        return [width * k // self.parts for k in range(self.parts + 1)]


Books = list[np.ndarray]


def whole_vectors(embeddings: DataFrame, coding: Coding = Coding()) -> DataFrame:
    """vec_id, label and vector (integers) of the rows that are kept."""
    numbers = F.col("embedding").cast("array<double>")
    fits = F.forall(numbers, lambda x: F.coalesce(F.abs(x * coding.scale) < float(_EXACT), F.lit(False)))  # not so for NaN, which is larger than any number
    rows = embeddings.where(F.col("embedding").isNotNull() & fits)
    return rows.select("vec_id", "label", F.transform(numbers, lambda x: F.floor(x * coding.scale)).alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, and which of them each row is."""
    order = np.lexsort(rows.T[::-1]) if rows.shape[1] else np.arange(len(rows))
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    which = np.empty(len(rows), np.int64)
    which[order] = np.cumsum(new) - 1
    return rows[new], which


def _exact(book: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As floating point numbers where sums of squares are exact integers in them, else as Python's integers."""
    most = max((int(np.abs(a).max(initial=0)) for a in (book, parts)), default=0)
    kind = np.float64 if book.shape[1] * (2 * most) ** 2 < _EXACT else object
    return book.astype(kind), parts.astype(kind)


def _rest(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all parts to all entries over the dimensions given."""
    if parts.dtype == object:
        return ((parts[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    return (parts * parts).sum(axis=1)[:, None] - 2 * (parts @ book.T) + (book * book).sum(axis=1)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance for distinct parts in lexicographic order, by a walk through their trie."""
    book, parts = _exact(book, parts)
    n, width = parts.shape
    entry, distance = np.zeros(n, np.int64), np.zeros(n, parts.dtype)

    def leaves(at: np.ndarray, found: np.ndarray) -> None:
        best = found.argmin(axis=1)
        entry[at], distance[at] = best, found[np.arange(len(at)), best]

    # (begin, end, depth, distances of the parent's beginning): the rows share their first ``depth`` dimensions
    nodes = [(0, n, 0, np.zeros(len(book), parts.dtype))] if n else []
    while nodes:
        begin, end, depth, held = nodes.pop()
        if depth:
            held = held + (parts[begin, depth - 1] - book[:, depth - 1]) ** 2
        if depth == width:
            leaves(np.array([begin]), held[None, :])
            continue
        values = parts[begin:end, depth]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) + begin
        last = np.append(first[1:], end)
        alone = first[last - first == 1]
        for k in range(0, len(alone), _AT_ONCE):
            at = alone[k : k + _AT_ONCE]
            leaves(at, held + _rest(parts[at, depth:], book[:, depth:]))
        nodes += [(a, z, depth + 1, held) for a, z in zip(first, last, strict=True) if z - a > 1][::-1]
    return entry, distance


class _Sums:
    """Sums of parts per entry of one position, exact."""

    def __init__(self, entries: int, width: int) -> None:
        self.count, self.sums = np.zeros(entries, object), np.zeros((entries, width), object)

    def add(self, parts: np.ndarray, counts: np.ndarray, entry: np.ndarray) -> None:
        order = np.argsort(entry, kind="stable")
        at = np.flatnonzero(np.diff(entry[order], prepend=-1))
        own = entry[order][at]
        most = int(np.abs(parts).max(initial=0)) * int(counts.sum())
        weighted = parts[order].astype(np.int64 if most < _LARGEST else object) * counts[order][:, None]
        self.count[own] += np.add.reduceat(counts[order], at).astype(object)
        self.sums[own] += np.add.reduceat(weighted, at, axis=0).astype(object)


def _distinct_parts(rows: DataFrame, coding: Coding, width: int) -> DataFrame:
    """position, part and n, how often it occurs; sorted within partitions, so that parts with a common beginning come together."""
    cuts = coding.cuts(width)
    parts = F.array(*[F.struct(F.lit(k).alias("position"), F.slice("vector", a + 1, z - a).alias("part")) for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))])
    one = rows.where(F.size("vector") == width).select(F.explode(parts).alias("p")).select("p.position", "p.part")
    return stored(one.groupBy("position", "part").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("position", "part"), "vector-parts")


def _next_books(parts: DataFrame, books: Books, cuts: list[int]) -> Books:
    """Every entry replaced by the floor of the mean of the parts it is nearest to; entries without parts stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, _Sums] = {}
        for batch in batches:
            position = batch.column(0).to_numpy(zero_copy_only=False)
            for p in np.unique(position).tolist():
                own = batch.filter(pa.array(position == p))
                rows, which = distinct_rows(_matrix(own.column(1), cuts[p + 1] - cuts[p]))
                counts = np.zeros(len(rows), np.int64)
                np.add.at(counts, which, own.column(2).to_numpy(zero_copy_only=False))
                held = sums.setdefault(p, _Sums(*books[p].shape))
                held.add(rows, counts, nearest(rows, books[p])[0])
        for p, held in sums.items():
            used = np.flatnonzero(held.count > 0)
            # a row for the count, at place -1, and one for every sum, in two halves that stay exact when summed up
            for place in range(-1, held.sums.shape[1]):
                value = (held.count if place < 0 else held.sums[:, place])[used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), p)), pa.array(used), pa.array(np.full(len(used), place)),
                     pa.array([int(v) >> 32 for v in value], pa.int64()), pa.array([int(v) & 0xFFFFFFFF for v in value], pa.int64())],
                    names=["position", "entry", "place", "high", "low"],
                )

    sums = parts.select("position", "part", "n").mapInArrow(run, "position long, entry long, place long, high long, low long")
    sums = sums.groupBy("position", "entry", "place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    value = {(r["position"], r["entry"], r["place"]): (r["high"] << 32) + r["low"] for r in sums.collect()}
    after = [book.copy() for book in books]
    for (p, e, place), total in value.items():
        if place >= 0:
            after[p][e, place] = total // value[p, e, -1]
    return after


def train(rows: DataFrame, coding: Coding = Coding()) -> tuple[Books, int]:
    """Codebooks of all positions from the rows of ``whole_vectors``, and the length of the vectors they are for."""
    in_order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    first = [r["vector"] for r in rows.orderBy(*in_order).limit(coding.entries).collect()]
    width = len(first[0]) if first else 0
    if any(len(v) != width for v in first):
        first = [r["vector"] for r in rows.where(F.size("vector") == width).orderBy(*in_order).limit(coding.entries).collect()]
    start = np.array(first, np.int64).reshape(len(first), width)
    cuts = coding.cuts(width)
    books = [start[:, a:z].copy() for a, z in zip(cuts, cuts[1:], strict=False)]
    if first:
        parts = _distinct_parts(rows, coding, width)
        for _ in range(coding.rounds):
            books = _next_books(parts, books, cuts)
    return books, width


def encode(rows: DataFrame, books: Books, width: int, coding: Coding = Coding()) -> DataFrame:
    """vec_id, label, code (two hex digits for the entry of each part) and error (squared distance, summed over parts) of every row."""
    cuts = coding.cuts(width)
    label = rows.schema["label"].dataType.simpleString()
    vec_id = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            fits = np.flatnonzero(np.diff(vectors.offsets.to_numpy(zero_copy_only=False)) == width)
            whole = _matrix(vectors.take(pa.array(fits)), width)
            codes, errors = np.zeros((len(fits), coding.parts), np.uint8), np.zeros(len(fits), object)
            for p, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                parts, which = distinct_rows(whole[:, a:z])
                entry, distance = nearest(parts, books[p])
                codes[:, p] = entry[which]
                errors += distance[which].astype(object)
            code, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            code[fits] = [row.tobytes().hex() for row in codes]
            error[fits] = [min(int(e), _LARGEST) for e in errors]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"]
            )

    return rows.select("vec_id", "label", "vector").mapInArrow(run, f"vec_id {vec_id}, label {label}, code string, error long")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """The coded rows and label_error, the errors summed over equal labels; rows without label are one group."""
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(exact > _LARGEST, F.lit(_LARGEST)).otherwise(exact.cast("long"))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"])).drop("_label")


def books_digest(books: Books) -> str:
    """SHA-256 of all entries' decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def compress(embeddings: DataFrame, coding: Coding = Coding()) -> tuple[DataFrame, Books]:
    """(vec_id, label, code, error, label_error) of the kept rows, and the codebooks."""
    rows = whole_vectors(embeddings, coding)
    books, width = train(rows, coding)
    coded = stored(encode(rows, books, width, coding), "vector-codes")
    return with_label_errors(coded), books


def decode(code: str, books: Books) -> list[int]:
    """The integers a code stands for."""
    return [int(x) for p, k in enumerate(bytes.fromhex(code)) for x in books[p][k]]
