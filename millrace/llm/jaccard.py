"""N-gram Jaccard join: all links between texts whose word shingle sets are similar, exactly, by universe partition.

Texts with equal sets form a class; the join works on classes. Sets are grouped in bands of size. In the scheme of a band the universe of shingles is
cut by hash into segments, and a set into what it has in each. Two sets that are similar enough differ in at most H
elements, so with more than H segments one of them is equal in both (pigeonhole): its content is a common signature. A segment
with a one-deletion neighbourhood, the content and the content without each of its elements, also meets a set that differs there in one element, and
counts for two. How many segments there are and how many of them have neighbourhoods is allocated per band by cost: rows written, and rows in
segments so small that unrelated sets share them. Contents of no element say nothing and are left out as long as the segments left
still exceed H; the same holds for signatures found to be frequent. A set for which they don't keeps all its signatures, so no link is lost.

What is left in frequent signatures, such as pages of one form that are not alike enough, is split again: shingles that most sets of such a crowd hold are
taken out of all sets, and what remains gets signatures under the same bound on differences, now with a neighbourhood for every segment. To take a shingle out
of all sets never adds a difference, so no link is lost.

Every candidate pair is verified on whole sets. Before whole sets move, sketches are compared: the parities of the elements by hash bit. Every bit in which two
sketches differ stands for at least one element in one of the sets only, so pairs with more such bits than linked sets have differences fall without a look at the sets. A set is first verified against one candidate; what is linked then needs no
further comparison, and the rest goes on in rounds: in each round, members of a signature are compared with some more members that
are not yet in their component, until no such pair is left. What is left is compared in one round where it is little, or where rounds link little. So groups of near copies cost a few comparisons per member.

A set has one band, or two when it is near the lower edge of its own. Null texts and texts without words have an empty set, no links and their own id
as component. Texts with fewer words than a shingle have their whole sequence as one. Documents that share an id count as one document that has
each of the texts: all are linked. Rows without ``doc_id`` are left out. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.tables import counted, stored
from millrace.llm.words import NOT_SPACE, find_words, mixed, run_starts, runs_of_words, slices

_SEEN_AT_MOST = 200_000
_SLICE_BYTES = 1 << 20
_ODD = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Join:
    """Sets are linked when 100 * intersection >= percent * union."""

    shingle_words: int = 4
    percent: int = 85
    band_ratio: float = 1.5
    #: a row in a segment of at most one element costs as much as so many others
    small_segment_cost: float = 32.0
    #: a signature of more sets than this is left out where the remaining ones suffice
    frequent: int = 24
    #: all that is left is compared in one round if the members that a set meets in its signatures but not in its component are so many a row on average,
    others_at_once: int = 4
    #: or, after a round that linked a quarter of its pairs at most, all members that it meets
    met_at_once: int = 256


@dataclass(frozen=True)
class Scheme:
    number: int
    low: int
    high: int
    segments: int
    deletions: int

    @property
    def units(self) -> int:
        return self.segments + self.deletions


def most_differences(join: Join, total: int) -> int:
    """Elements in one of two linked sets only, at most, when the sets have ``total`` elements together."""
    return total * (100 - join.percent) // (100 + join.percent)


def largest_partner(join: Join, n: int) -> int:
    return n * 100 // join.percent


def schemes(join: Join, largest: int) -> list[Scheme]:
    """Schemes by band of the smaller set, up to sets of ``largest`` elements. Sets too small to differ have none."""
    low = 1
    while most_differences(join, low + largest_partner(join, low)) == 0:
        low += 1
    found = []
    while low <= largest:
        high = max(low, math.ceil(low * join.band_ratio) - 1)
        need = most_differences(join, high + largest_partner(join, high)) + 1
        best = None
        for deletions in range(0, need // 2 + 1):
            segments = max(1, need - deletions)
            for _ in range(3):  # spare segments for those that will be empty, and two for frequent ones
                empty = segments * math.exp(-high / segments)
                segments = max(1, need + math.ceil(empty + 3 * math.sqrt(empty)) + 2 - deletions)
            size = high / segments
            small = segments * math.exp(-size) * (1 + size)
            cost = segments + deletions * size + join.small_segment_cost * small
            if deletions <= segments and (best is None or cost < best[0]):
                best = (cost, segments, deletions)
        found.append(Scheme(len(found), low, high, best[1], best[2]))
        low = high + 1
    return found


def second_schemes(plans: list[Scheme], join: Join) -> list[Scheme]:
    """For the same bands and bounds: half as many segments, each with a neighbourhood, and some to spare."""
    found = []
    for p in plans:
        need = most_differences(join, p.high + largest_partner(join, p.high)) + 1
        segments = need // 2 + 1 + max(1, need // 8)
        found.append(Scheme(p.number, p.low, p.high, segments, segments))
    return found


@dataclass
class Sets:
    """Distinct shingles of consecutive texts, those of text d from ``first[d]``."""

    items: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def sums(self, salt: int) -> np.ndarray:
        """An order-free 64-bit digest of each set."""
        value = mixed(self.items + np.uint64(salt * int(_ODD) % 2**64))
        return _digest(*_split_sums(value, np.repeat(np.arange(len(self.counts)), self.counts), len(self.counts)))


def _split_sums(value: np.ndarray, slot: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the low and the high halves per slot; exact, since sums of 32-bit halves stay far below 2**53."""
    low = np.bincount(slot, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), slots)
    high = np.bincount(slot, (value >> np.uint64(32)).astype(np.float64), slots)
    return low.astype(np.uint64), high.astype(np.uint64)


def _digest(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return mixed(low + mixed(high) * _ODD)


def shingle_sets(column: pa.Array, k: int) -> Sets:
    words = find_words(column, NOT_SPACE, lower=True)
    counts, of_word = words.counts, words.text_of_word
    starts = run_starts(words, k)
    values, texts = [runs_of_words(words.hashes, k)[starts]], [of_word[starts]]
    for short in range(1, k):
        at = words.first[:-1][counts == short]
        values.append(runs_of_words(words.hashes, short)[at])
        texts.append(of_word[at])
    value, text = np.concatenate(values), np.concatenate(texts)
    _, kept = np.unique(mixed(value ^ mixed(text.astype(np.uint64) + np.uint64(1))), return_index=True)
    value, text = value[kept], text[kept]
    order = np.argsort(text, kind="stable")
    return Sets(value[order], np.searchsorted(text[order], np.arange(len(counts) + 1)))


def signatures(sets: Sets, texts: np.ndarray, join: Join, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of some of the texts: (signature, text, note). note = 8 * slack + 2 * units + (1 in the scheme of the band below).

    With ``sizes``, the sets are what is left of sets of these sizes, and get the signatures of the second split: contents of no element never have one, and slack is -1
    where those that are left don't suffice.
    """
    counts = sets.counts if sizes is None else sizes
    plans = schemes(join, int(counts[texts].max(initial=0)))
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not plans:
        return empty
    lows = np.array([p.low for p in plans])
    band = np.searchsorted(lows, counts[texts], "right") - 1
    # (text, scheme): the own band, and the one below where a set of that band may be similar
    own = band >= 0
    reach = np.array([largest_partner(join, p.high) for p in plans])
    below = (band >= 1) & (counts[texts] <= reach[np.maximum(band - 1, 0)])
    text = np.concatenate([texts[own], texts[below]])
    scheme = np.concatenate([band[own], band[below] - 1])
    is_below = np.concatenate([np.zeros(own.sum(), np.int64), np.ones(below.sum(), np.int64)])
    if not len(text):
        return empty
    if sizes is not None:
        plans = second_schemes(plans, join)
    segments = np.array([p.segments for p in plans])[scheme]
    deletions = np.array([p.deletions for p in plans])[scheme]
    highs = np.array([p.high for p in plans])[scheme]
    n, held = counts[text], sets.counts[text]
    base = np.concatenate([[0], np.cumsum(segments)])
    # every shingle of every entry, in its slot
    entry = np.repeat(np.arange(len(text)), held)
    at = np.arange(len(entry)) - np.repeat(np.cumsum(held) - held, held) + np.repeat(sets.first[text], held)
    value = mixed(sets.items[at])
    segment = ((value >> np.uint64(32)) * segments[entry].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    value = mixed(value)
    slot = base[entry] + segment
    size = np.bincount(slot, minlength=base[-1])
    low, high = _split_sums(value, slot, base[-1])
    slot_entry = np.repeat(np.arange(len(text)), segments)
    slot_segment = np.arange(base[-1]) - base[slot_entry]
    salt = mixed((scheme[slot_entry].astype(np.uint64) << np.uint64(32)) + slot_segment.astype(np.uint64))
    if sizes is not None:
        salt = mixed(salt)
    deleting = slot_segment < deletions[slot_entry]
    lost = np.where(size == 0, np.where(deleting, 2, 1), np.where(deleting & (size == 1), 1, 0))
    lost = np.bincount(slot_entry, lost, len(text)).astype(np.int64)
    # as the smaller or, in the scheme below, the larger set of a pair
    partner = np.where(is_below == 1, np.minimum(highs, n), n * 100 // join.percent)
    most = (n + partner) * (100 - join.percent) // (100 + join.percent)
    slack = segments + deletions - lost - (most + 1)
    keeps_all = (slack < 0) & (sizes is None)
    slack = np.maximum(slack, 0 if sizes is None else -1)
    whole = np.flatnonzero((size > 0) | keeps_all[slot_entry])
    less = np.flatnonzero(deleting[slot] & ((size[slot] > 1) | keeps_all[entry]))
    less_slot = slot[less]
    minus_low = low[less_slot] - (value[less] & np.uint64(0xFFFFFFFF))
    minus_high = high[less_slot] - (value[less] >> np.uint64(32))
    out = np.concatenate([_digest(low[whole], high[whole]) ^ salt[whole], _digest(minus_low, minus_high) ^ salt[less_slot]])
    of = np.concatenate([slot_entry[whole], entry[less]])
    units = np.concatenate([np.where(deleting[whole], 2, 1), np.full(len(less), 2)])
    return mixed(out), text[of], 8 * slack[of] + 2 * units + is_below[of]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where(docs["doc_id"].isNotNull()).select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def describe(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, n (size of the set) and a 128-bit digest of the set (d1, d2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=_SLICE_BYTES):
                sets = shingle_sets(part.column(1), join.shingle_words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets.counts), *(pa.array(sets.sums(k).view(np.int64)) for k in (1, 2))],
                    names=["doc_id", "n", "d1", "d2"],
                )

    return _texts(docs).mapInArrow(run, "doc_id long, n long, d1 long, d2 long")


def _signature_rows(docs: DataFrame, join: Join) -> DataFrame:
    """(sig, doc_id, note) of every set; of equal sets in one task, of one only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for part in slices(batch, limit=_SLICE_BYTES):
                sets = shingle_sets(part.column(1), join.shingle_words)
                fresh = []
                for d, digest in enumerate(zip(sets.sums(1).tolist(), sets.sums(2).tolist(), strict=True)):
                    if digest not in seen:
                        seen.add(digest)
                        fresh.append(d)
                if len(seen) > _SEEN_AT_MOST:
                    seen.clear()
                sig, text, note = signatures(sets, np.array(fresh, np.int64), join)
                ids = part.column(0).to_numpy(zero_copy_only=False)[text]
                for k in range(0, len(sig), 200_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[k : k + 200_000]) for x in (sig.view(np.int64), ids, note)], names=["sig", "doc_id", "note"]
                    )

    return _texts(docs).mapInArrow(run, "sig long, doc_id long, note long")


def sketch_bits(join: Join, n: int) -> int:
    """A power of two, several times the differences that a linked set may have."""
    return 1 << max(7, (4 * most_differences(join, n + largest_partner(join, n))).bit_length())


def sketch(items: np.ndarray, bits: int) -> bytes:
    """Parity, for each of so many hash values, of the number of elements that have it."""
    at = (mixed(items ^ _ODD) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def surely_different(a: bytes, b: bytes) -> int:
    """A lower bound of the elements that are in one set only. The longer sketch is folded to the length of the shorter one."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, n), axis=0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _candidate_sets(docs: DataFrame, wanted: DataFrame, join: Join) -> DataFrame:
    """doc_id, n, sketch and items: the whole sets of the wanted documents."""
    ids = counted(wanted.select("doc_id").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=_SLICE_BYTES):
                sets = shingle_sets(part.column(1), join.shingle_words)
                items = pa.LargeListArray.from_arrays(pa.array(sets.first, pa.int64()), pa.array(sets.items.view(np.int64)))
                counts = sets.counts
                short = [sketch(sets.items[a : a + n], sketch_bits(join, int(n))) for a, n in zip(sets.first[:-1], counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(short, pa.binary()), items.cast(pa.list_(pa.int64()))], names=["doc_id", "n", "sketch", "items"]
                )

    return _texts(docs).join(ids, "doc_id", "left_semi").mapInArrow(run, "doc_id long, n long, sketch binary, items array<long>")


def _sides(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """The pairs (u, v) with the columns of both sets."""
    both = pairs
    for side in "uv":
        both = both.join(sets.select(F.col("doc_id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return both


def _perhaps(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Those of the pairs (u, v) whose sketches leave open whether they are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, u_n, u_sketch, v_n, v_sketch = (batch.column(c) for c in ("u", "v", "u_n", "u_sketch", "v_n", "v_sketch"))
            total = u_n.to_numpy(zero_copy_only=False) + v_n.to_numpy(zero_copy_only=False)
            differ = np.array([surely_different(a, b) for a, b in zip(u_sketch.to_pylist(), v_sketch.to_pylist(), strict=True)], np.int64)
            ok = pa.array((100 + join.percent) * differ <= (100 - join.percent) * total)
            yield pa.RecordBatch.from_arrays([u.filter(ok), v.filter(ok)], names=["u", "v"])

    return _sides(pairs, sets, "n", "sketch").mapInArrow(run, "u long, v long")


def _verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Those of the pairs (u, v) whose sets are similar enough."""
    both = _sides(stored(_perhaps(pairs, sets, join), "jaccard-perhaps"), sets, "items")
    shared = F.size(F.array_intersect("u_items", "v_items")).cast("long")
    total = F.size("u_items").cast("long") + F.size("v_items") - shared
    return both.where(100 * shared >= join.percent * total).select("u", "v")


def _with_members(rows: DataFrame) -> DataFrame:
    """Signatures that two or more sets share, with their number."""
    return rows.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("sig"))).where("members > 1")


def _without_spare(rows: DataFrame, join: Join) -> DataFrame:
    """(sig, doc_id, members): of rows with notes, a set's most frequent signatures go, as long as those that remain still suffice.

    A set leaves all its signatures of more than so many members, a number of its own. Of two linked sets the one with the lower number still shares a signature
    with the other among those it has kept, and the other has kept that one as well.
    """
    note = F.col("note")
    rows = rows.select("*", F.pmod(note, F.lit(2)).alias("below"), F.pmod(F.floor(note / 2), F.lit(4)).alias("units"), F.floor(note / 8).alias("slack"))
    rows = stored(_with_members(rows), "jaccard-members")
    heavy = rows.where(F.col("members") > join.frequent)
    # equal numbers count together
    lost = F.sum("units").over(Window.partitionBy("doc_id", "below").orderBy(F.desc("members")).rangeBetween(Window.unboundedPreceding, 0))
    heavy = heavy.withColumn("lost", lost).where("lost > slack").drop("lost")
    kept = rows.where(F.col("members") <= join.frequent).unionByName(heavy)
    return kept.select("sig", "doc_id", "members")


def _candidates(docs: DataFrame, copies: DataFrame, join: Join) -> DataFrame:
    """(sig, doc_id, members): signatures that two or more classes share. Of a class, only its smallest id appears."""
    rows = stored(_with_members(_signature_rows(docs, join)).drop("members"), "jaccard-shared")
    rows = rows.join(copies, "doc_id", "left").select("sig", F.coalesce("class_id", "doc_id").alias("doc_id"), "note")
    rows = rows.groupBy("sig", "doc_id").agg(F.min("note").alias("note"))
    return stored(_without_spare(rows, join), "jaccard-kept")


def _split_again(kept: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """(sig, doc_id): the frequent signatures replaced by those of the second split, where enough is left of the sets.

    A shingle is common if more sets of the crowd hold it than half of the largest signature that any of its holders is in.
    """
    crowded = kept.where(F.col("members") > join.frequent)
    largest = stored(crowded.groupBy("doc_id").agg(F.max("members").alias("crowd")), "jaccard-crowd")
    if largest.isEmpty():
        return kept.select("sig", "doc_id")
    crowd = sets.join(largest, "doc_id").select("doc_id", "n", "crowd", "items")
    held = crowd.select("doc_id", "crowd", F.explode("items").alias("item")).groupBy("item")
    common = held.agg(F.count(F.lit(1)).alias("holders"), F.max("crowd").alias("crowd")).where("holders > 1 AND 2 * holders > crowd").select("item")
    rest = crowd.select("doc_id", F.explode("items").alias("item")).join(common, "item", "left_anti").groupBy("doc_id").agg(F.collect_list("item").alias("rest"))
    left = crowd.select("doc_id", "n").join(rest, "doc_id", "left").select("doc_id", "n", F.coalesce("rest", F.array().cast("array<long>")).alias("items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                lists = part.column(2)
                first = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy(zero_copy_only=False)))]).astype(np.int64)
                own = Sets(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), first)
                sig, text, note = signatures(own, np.arange(part.num_rows), join, part.column(1).to_numpy(zero_copy_only=False))
                ids = part.column(0).to_numpy(zero_copy_only=False)[text]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (sig.view(np.int64), ids, note)], names=["sig", "doc_id", "note"])

    again = stored(left.mapInArrow(run, "sig long, doc_id long, note long").groupBy("sig", "doc_id").agg(F.min("note").alias("note")), "jaccard-again")
    # sets of which enough is left meet all that they are linked to in the second split, but for sets outside of the crowd; of those that don't
    # suffice two meet as before, and one meets the sufficient ones
    enough = stored(again.groupBy("doc_id").agg(F.min("note").alias("note")).where("note >= 0").select("doc_id", F.lit(True).alias("enough")), "jaccard-enough")
    before = kept.join(enough, "doc_id", "left")
    others = F.max(F.col("enough").isNull()).over(Window.partitionBy("sig"))
    rare = before.where(F.col("members") <= join.frequent).withColumn("others", others).where("others")
    before = rare.select("sig", "doc_id").unionByName(before.where(F.col("enough").isNull() & (F.col("members") > join.frequent)).select("sig", "doc_id"))
    return stored(before.unionByName(_without_spare(again, join).select("sig", "doc_id")), "jaccard-split")


def _without_hopeless(rows: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """(sig, doc_id, rank, members, n, r) without sets that can't be linked to any other set of a frequent signature.

    In a crowd of edited copies of one text all signatures are frequent, also for copies too far from all others. Of the sets that are
    left in frequent signatures, r shingles are rare: in at most ``frequent`` of these sets. Two sets either share a rare shingle, which
    is a signature of its own here, or differ in all their rare ones and in the sizes of the rest. So if no rare one is shared,
    |X - Y| + |Y - X| >= rx + ry + |(nx - rx) - (ny - ry)| >= 2 rx - |nx - ny|, and where that is more than linked sets may differ in, X leaves the signature.
    """
    sig = Window.partitionBy("sig")
    rows = _with_members(rows)
    crowded = rows.where(F.col("members") > join.frequent)
    crowd = sets.join(counted(crowded.select("doc_id").distinct()), "doc_id", "left_semi")
    one = crowd.select("doc_id", F.explode("items").alias("item"))
    one = one.withColumn("holders", F.count(F.lit(1)).over(Window.partitionBy("item"))).where(F.col("holders") <= join.frequent)
    rare = stored(one.select("item", "doc_id", "holders"), "jaccard-rare")
    sizes = crowd.select("doc_id", "n").join(
        rare.groupBy("doc_id").agg(F.count(F.lit(1)).alias("r")), "doc_id", "left"
    )
    placed = crowded.select("sig", "doc_id").join(sizes.fillna(0, ["r"]), "doc_id")
    largest, smallest = F.max("n").over(sig), F.min("n").over(sig)
    differs = 2 * F.col("r") - F.greatest(F.col("n") - smallest, largest - F.col("n"))
    allowed = (F.col("n") + largest) * (100 - join.percent) / (100 + join.percent)
    hopeful = placed.withColumns({"differs": differs, "allowed": allowed}).where("differs <= allowed").select("sig", "doc_id", "n", "r")
    # hashed again, so that shingles and signatures stay apart
    shared = rare.where("holders > 1").select(F.xxhash64("item", F.lit("rare")).alias("sig"), "doc_id")
    unknown = F.lit(None).cast("long")
    others = rows.where(F.col("members") <= join.frequent).select("sig", "doc_id").unionByName(shared)
    kept = others.select("*", unknown.alias("n"), unknown.alias("r")).unionByName(hopeful)
    kept = kept.withColumns({"rank": F.row_number().over(sig.orderBy("doc_id")) - 1, "members": F.count(F.lit(1)).over(sig)})
    return stored(kept.where("members > 1"), "jaccard-candidates")


def _compatible(join: Join) -> Column:
    """Whether two sets of a frequent signature may be linked by their sizes and numbers of rare shingles, if they share no rare one."""
    rest = F.abs((F.col("n") - F.col("r")) - (F.col("v_n") - F.col("v_r")))
    differs = F.col("r") + F.col("v_r") + rest
    return F.coalesce((100 + join.percent) * differs <= (100 - join.percent) * (F.col("n") + F.col("v_n")), F.lit(True))


def similarity_links(docs: DataFrame, copies: DataFrame, join: Join) -> DataFrame:
    """(u, v): v is the smallest class id reachable from class u by links, for every u that is not it."""
    kept = _candidates(docs, copies, join)
    sets = stored(_candidate_sets(docs, kept, join), "jaccard-sets")
    shared = _without_hopeless(_split_again(kept, sets, join), sets, join)
    first = shared.where("rank = 0").select("sig", F.col("doc_id").alias("v"), F.col("n").alias("v_n"), F.col("r").alias("v_r"))
    pairs = shared.where("rank > 0").join(first, "sig").where(_compatible(join)).groupBy(F.col("doc_id").alias("u")).agg(F.min("v").alias("v"))
    tried = stored(pairs, "jaccard-tried")
    joined = components(_verified(tried, sets, join))
    rows, low, step, apart = shared.count(), 0, 2, False
    while True:
        placed = shared.where(F.col("members") > low + 1).join(
            joined.select(F.col("u").alias("doc_id"), F.col("v").alias("top")), "doc_id", "left"
        ).select("sig", "doc_id", "rank", "n", "r", F.coalesce("top", "doc_id").alias("top"))
        sig, here = Window.partitionBy("sig"), F.count(F.lit(1))
        open_ = placed.withColumns({"a": F.min("top").over(sig), "z": F.max("top").over(sig), "met": here.over(sig)}).where("a < z").drop("a", "z")
        open_ = stored(open_.withColumn("others", F.col("met") - here.over(Window.partitionBy("sig", "top"))), "jaccard-open")
        left = open_.agg(F.sum("met").alias("met"), F.sum("others").alias("others")).first()
        if left["met"] is None:
            return joined
        # a round spares comparisons only by what it links
        at_once = left["others"] <= join.others_at_once * rows or (apart and left["met"] <= join.met_at_once * rows)
        centres = open_ if at_once else open_.where((F.col("rank") >= low) & (F.col("rank") < low + step))
        centres = centres.select(
            "sig", F.col("doc_id").alias("v"), F.col("rank").alias("v_rank"), F.col("top").alias("v_top"),
            F.col("n").alias("v_n"), F.col("r").alias("v_r"),
        )
        pairs = (
            open_.join(centres, "sig").where("rank > v_rank AND top <> v_top").where(_compatible(join)).select(F.col("doc_id").alias("u"), "v").distinct()
            .join(tried, ["u", "v"], "left_anti")
        )
        pairs = stored(pairs, "jaccard-pairs")
        tried = tried.unionByName(pairs)
        links = stored(_verified(pairs, sets, join), "jaccard-links")
        n_links = links.count()
        if n_links:
            joined = components(links.unionByName(joined))
        if at_once:
            return joined
        apart = 4 * n_links <= pairs.count()
        low, step = low + step, step * 4


def jaccard_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) for every document."""
    described = stored(describe(docs, join), "jaccard-sizes")
    several = described.groupBy("doc_id").agg(F.min(F.struct("n", "d1", "d2")).alias("a"), F.max(F.struct("n", "d1", "d2")).alias("z")).where("a <> z")
    if several.isEmpty():
        return _components_of_sets(docs, described, join)
    # ids with several texts: each text is a node of its own, and the nodes of an id are linked at the end
    texts = _texts(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("node"), "text")
    nodes = stored(texts.select("node", "doc_id").distinct(), "jaccard-nodes")
    by_node = texts.select(F.col("node").alias("doc_id"), "text")
    placed = stored(_components_of_sets(by_node, stored(describe(by_node, join), "jaccard-node-sizes"), join), "jaccard-placed")
    links = placed.select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    of_id = nodes.join(nodes.groupBy("doc_id").agg(F.min("node").alias("v")), "doc_id").select(F.col("node").alias("u"), "v")
    top = components(links.unionByName(of_id)).select(F.col("u").alias("node"), F.col("v").alias("top"))
    nodes = nodes.join(top, "node", "left").select("node", "doc_id", F.coalesce("top", "node").alias("top"))
    least = nodes.groupBy("top").agg(F.min("doc_id").alias("component_id"))
    rows = placed.select(F.col("doc_id").alias("node"), "n_shingles").join(nodes, "node").join(least, "top")
    return rows.select("doc_id", "n_shingles", "component_id")


def _components_of_sets(docs: DataFrame, described: DataFrame, join: Join) -> DataFrame:
    """Components where each doc_id has one set, though maybe several rows."""
    filled = described.where("n > 0")
    classes = filled.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("members")).where("members > 1")
    # equal sets: each copy knows the smallest id of its class
    copies = stored(filled.join(classes.drop("members"), ["d1", "d2", "n"]).where("doc_id <> class_id").select("doc_id", "class_id").distinct(), "jaccard-copies")
    first_class = copies.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    joined = similarity_links(docs, first_class, join)
    top = joined.select(F.col("u").alias("t_u"), F.col("v").alias("top"))
    placed = described.join(first_class, "doc_id", "left")
    placed = placed.withColumn("c", F.coalesce("class_id", "doc_id")).join(top, F.col("c") == F.col("t_u"), "left")
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("top", "c").alias("component_id"))
