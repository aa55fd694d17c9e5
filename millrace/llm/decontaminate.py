"""Benchmark decontamination by suffix arrays of the training texts.

Training texts are taken in shards. In each shard a suffix array puts all places that begin with benchmark words in the
order of the words that follow. Every suffix of every benchmark item is then looked up by binary search: its neighbours
in the array give its longest verbatim match, and the range of suffixes that begin with its first 13 words gives all places
of that window. Both are exact; a shard's array lives in its task alone and nothing but matches leaves it.

The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text; one block at a time is sent to all tasks, whatever the
size of the benchmark. An item is one text and never cut, so an item over the bound makes a block of its own.

Defined cases: null or empty texts have no words and no hits; items without words have no windows; an item of fewer
than 13 words is one window; repeated rows of documents are judged each, repeated item rows count as one item; rows without an
``item_id`` mark hits but are not listed; other columns are ignored by the search and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import counted, stored
from millrace.llm.words import LETTER_OR_DIGIT, Words, find_words, slices

WINDOW = 13
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 4 << 20

#: A word of a block is a number below this, so that three words make one 63-bit sort key.
_WORDS = 1 << 21


@dataclass
class Block:
    """Benchmark items as word numbers (0 ends each item) and their windows, equal windows once."""

    vocabulary: np.ndarray
    suffixes: np.ndarray
    suffix_item: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    window_items: list[np.ndarray]
    item_ids: list


def _padded(stream: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """``width`` numbers from each start; zeros after the first zero and past the end."""
    out = np.zeros((len(starts), width), np.int32)
    alive = np.ones(len(starts), bool)
    for k in range(width):
        at = starts + k
        alive = alive & (at < len(stream))
        value = stream[np.minimum(at, len(stream) - 1)] if len(stream) else np.zeros(len(starts), np.int32)
        alive = alive & (value > 0)
        out[:, k] = np.where(alive, value, 0)
    return out


def make_block(items: list[tuple]) -> Block:
    """items: (item_id, text)."""
    words = find_words(pa.array([t or "" for _, t in items], pa.large_string()), LETTER_OR_DIGIT, lower=True)
    vocabulary = np.unique(words.hashes)
    if len(vocabulary) >= _WORDS:
        raise ValueError(f"a benchmark block has {len(vocabulary)} different words; make BLOCK_BYTES smaller")
    stream = (np.searchsorted(vocabulary, words.hashes) + 1).astype(np.int32)
    of_item, position = words.text_of_word, np.arange(len(stream))
    # a zero after every item, so that nothing reaches over its end
    place = position + of_item
    spaced = np.zeros(len(stream) + len(items), np.int32)
    spaced[place] = stream
    left = np.repeat(words.first[1:], words.counts) - position
    first = position == np.repeat(words.first[:-1], words.counts)
    opens = (left >= WINDOW) | (first & (left < WINDOW))
    table = _padded(spaced, place[opens], WINDOW)
    windows, which = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
    which = which.ravel()
    order = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[order], np.arange(1, len(windows)))
    items_of = np.split(of_item[opens][order], cuts) if len(windows) else []
    return Block(
        vocabulary, spaced, place, windows, (windows > 0).sum(axis=1), [np.unique(x) for x in items_of], [i for i, _ in items]
    )


def blocks_of(benchmark: DataFrame) -> Iterator[Block]:
    """The items, block after block; the driver holds one at a time."""
    items, size = [], 0
    for row in benchmark.select("item_id", benchmark["text"].cast("string").alias("text")).toLocalIterator():
        grown = len((row["text"] or "").encode())
        if items and size + grown > BLOCK_BYTES:
            yield make_block(items)
            items, size = [], 0
        items.append((row["item_id"], row["text"]))
        size += grown
    if items:
        yield make_block(items)


def suffix_array(stream: np.ndarray, depth: int) -> np.ndarray:
    """Places of nonzero words in the order of what follows up to the next zero, ``depth`` words at least. A zero ends the stream.

    The first sort takes three words at once. After that only places that are still equal are sorted again, by the ranks of the places
    as many words further as are in order already.
    """
    n = len(stream)
    at = np.flatnonzero(stream)
    if not len(at):
        return at
    ahead = np.concatenate([stream, np.zeros(2, stream.dtype)]).astype(np.int64)
    second = ahead[at + 1]
    third = np.where(second > 0, ahead[at + 2], 0)
    key = (ahead[at] << 42) | (second << 21) | third
    order = np.argsort(key, kind="stable")
    array, key = at[order], key[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.zeros(n + 1, np.int64)  # 1 and up; 0 past the end
    rank[array] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] + 1
    zeros = np.flatnonzero(stream == 0)
    in_order = 3
    while in_order < depth:
        tied = np.flatnonzero(~(fresh & np.concatenate([fresh[1:], [True]])))
        places = array[tied]
        reach = zeros[np.searchsorted(zeros, places)] - places
        further = np.where(reach > in_order, rank[np.minimum(places + in_order, n)], 0)
        if not further.any():
            break
        here = rank[places]
        step = np.lexsort((further, here))
        places, here, further = places[step], here[step], further[step]
        array[tied] = places
        fresh[tied] = np.concatenate([[True], (here[1:] != here[:-1]) | (further[1:] != further[:-1])])
        rank[places] = tied[np.flatnonzero(fresh[tied])[np.cumsum(fresh[tied]) - 1]] + 1
        in_order *= 2
    return array


def _search(stream, array, wanted, lengths, right, within=None, skip=0) -> np.ndarray:  # noqa: PLR0913
    """For every row of ``wanted``, where its first ``lengths`` words go in the array: before equal suffixes, or after.

    ``within`` (low, high) is the range of the array for each row; its suffixes are compared from their word ``skip`` on, up to which they are equal.
    """
    low, high = within or (np.zeros(len(wanted), np.int64), np.full(len(wanted), len(array), np.int64))
    low, high = low.copy(), high.copy()
    width = wanted.shape[1]
    beyond = np.arange(width)[None, :] >= lengths[:, None]
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        have = _padded(stream, array[middle] + skip, width)
        have[beyond[open_]] = 0
        differs = have != wanted[open_]
        column = differs.argmax(axis=1)
        row = np.arange(len(open_))
        sign = np.where(differs.any(axis=1), np.sign(have[row, column] - wanted[open_][row, column]), 0)
        down = sign <= 0 if right else sign < 0
        low[open_] = np.where(down, middle + 1, low[open_])
        high[open_] = np.where(down, high[open_], middle)
    return low


@dataclass
class Shard:
    """Word numbers of the shard's texts with a zero after each text, and their suffix array."""

    stream: np.ndarray
    array: np.ndarray
    #: for each place of the stream, the index of its word among all words of the shard
    first: np.ndarray

    def ranges(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """For each window of the block, the range of suffixes that begin with it."""
        low = _search(self.stream, self.array, block.windows, block.lengths, right=False)
        high = _search(self.stream, self.array, block.windows, block.lengths, right=True)
        return low, high

    def longest(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix of the block's items: the words of its longest match in the shard, and the place of one (-1: none)."""
        width, n = 64, len(block.suffix_item)
        at, end = np.zeros(n, np.int64), np.full(n, len(self.array), np.int64)
        # 64 words at a time, within the range of those that are equal so far, until none is or the item ends
        going, skip = np.arange(n), 0
        while going.size:
            rows, lengths = _padded(block.suffixes, block.suffix_item[going] + skip, width), np.full(len(going), width)
            low = _search(self.stream, self.array, rows, lengths, False, (at[going], end[going]), skip)
            high = _search(self.stream, self.array, rows, lengths, True, (low, end[going]), skip)
            at[going], end[going] = low, high
            going, skip = going[(low < high) & (rows[:, -1] > 0)], skip + width
        length, place = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        for beside in (at - 1, at):
            ok = np.flatnonzero((beside >= 0) & (beside < len(self.array)))
            here = self.array[beside[ok]]
            common, going, k = np.zeros(len(ok), np.int64), np.arange(len(ok)), 0
            while going.size:
                a, b = here[going] + k, block.suffix_item[ok[going]] + k
                inside = (a < len(self.stream)) & (b < len(block.suffixes))
                going, a, b = going[inside], a[inside], b[inside]
                equal = (self.stream[a] == block.suffixes[b]) & (self.stream[a] > 0)
                going = going[equal]
                common[going] += 1
                k += 1
            better = common > length[ok]
            length[ok[better]], place[ok[better]] = common[better], here[better]
        return length, place


def make_shard(words: Words, block: Block) -> Shard:
    found = np.searchsorted(block.vocabulary, words.hashes)
    found[found == len(block.vocabulary)] = 0
    known = block.vocabulary[found] == words.hashes if len(block.vocabulary) else np.zeros(len(words.hashes), bool)
    texts = len(words.first) - 1
    stream = np.zeros(len(words.hashes) + texts, np.int32)
    stream[np.arange(len(words.hashes)) + words.text_of_word] = np.where(known, found + 1, 0)
    deepest = max(WINDOW, int(np.diff(np.flatnonzero(np.concatenate([[0], block.suffixes]) == 0)).max(initial=0)))
    return Shard(stream, suffix_array(stream, deepest), words.first[:-1] + np.arange(texts))


def hits(shard: Shard, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which places of the stream are hit, and pairs (text, item) with a window of the item in the text."""
    low, high = shard.ranges(block)
    change = np.zeros(len(shard.stream) + 1, np.int32)
    texts, items = [], []
    for w in np.flatnonzero(high > low):
        at = shard.array[low[w] : high[w]]
        np.add.at(change, at, 1)
        np.add.at(change, at + block.lengths[w], -1)
        text = np.unique(np.searchsorted(shard.first, at, "right") - 1)
        texts.append(np.repeat(text, len(block.window_items[w])))
        items.append(np.tile(block.window_items[w], len(text)))
    if not texts:
        return np.zeros(len(shard.stream), bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(items)]), axis=1)
    return np.cumsum(change[:-1]) > 0, pairs[0], pairs[1]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, limit=SHARD_BYTES)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", docs["text"].cast("string").alias("text"))


def find_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, hit_spans (word numbers, end exclusive) and item_ids with occurring windows."""
    spark, rows = docs.sparkSession, _numbered(docs)
    key, item = rows.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        T.StructField("doc_id", key), T.StructField("content", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(span)), T.StructField("item_ids", T.ArrayType(item)),
    ])

    def search(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for part in _shards(batches):
                words = find_words(part.column(2), LETTER_OR_DIGIT, lower=True)
                shard = make_shard(words, block)
                hit, text, which = hits(shard, block)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                spans, found = [[] for _ in range(part.num_rows)], [set() for _ in range(part.num_rows)]
                for a, b in edges.reshape(-1, 2).tolist():
                    d = int(np.searchsorted(shard.first, a, "right")) - 1
                    base = int(shard.first[d])
                    spans[d].append({"start": a - base, "end": b - base})
                for d, i in zip(text.tolist(), which.tolist(), strict=True):
                    if block.item_ids[i] is not None:
                        found[d].add(block.item_ids[i])
                arrow = [f.type for f in _arrow_schema(schema)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(words.counts.astype(np.int64)), pa.array(spans, arrow[3]),
                     pa.array([sorted(x) for x in found], arrow[4])],
                    names=schema.names,
                )

        return run

    rows = rows.select("doc_id", F.xxhash64("text").alias("content"), "text")
    passes = [rows.mapInArrow(search(spark.sparkContext.broadcast(block)), schema) for block in blocks_of(benchmark)]
    if not passes:
        passes = [rows.mapInArrow(search(spark.sparkContext.broadcast(make_block([]))), schema)]
    if len(passes) == 1:
        return passes[0].drop("content")
    # more blocks than one: the same rows came once per block; their spans and items are put together
    all_rows = passes[0]
    for other in passes[1:]:
        all_rows = all_rows.unionByName(other)
    together = all_rows.groupBy("doc_id", "content", "n_words").agg(
        F.expr(f"count(1) DIV {len(passes)}").alias("copies"),
        F.array_distinct(F.flatten(F.collect_list("hit_spans"))).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )
    return together.select("doc_id", "n_words", _merged("hit_spans").alias("hit_spans"), "item_ids", "copies").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), "copies"))
    ).drop("copy", "copies")


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _merged(column: str):
    """Spans that touch or overlap become one."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(
        F.array_sort(column), empty,
        lambda acc, s: F.when((F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]), F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))),
        )).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, least_words: int = 5) -> DataFrame:
    """Longest verbatim match of every benchmark suffix: item_id, word (where the suffix begins), n_words, doc_id, doc_word.

    One row per suffix whose longest match over all shards has ``least_words`` or more, with one of the places where it stands.
    """
    spark, rows = docs.sparkSession, _numbered(docs)
    key, item = rows.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = T.StructType([
        T.StructField("item_id", item), T.StructField("word", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("doc_id", key), T.StructField("doc_word", T.LongType()),
    ])

    def search(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = sent.value
            ends = np.flatnonzero(block.suffixes == 0)
            begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
            arrow = _arrow_schema(schema)
            for part in _shards(batches):
                shard = make_shard(find_words(part.column(1), LETTER_OR_DIGIT, lower=True), block)
                length, place = shard.longest(block)
                ok = np.flatnonzero(length >= least_words)
                item_of = np.searchsorted(ends, block.suffix_item[ok])
                doc = np.searchsorted(shard.first, place[ok], "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.item_ids[i] for i in item_of], arrow[0].type), pa.array(block.suffix_item[ok] - begins[item_of]),
                     pa.array(length[ok]), part.column(0).take(pa.array(doc)), pa.array(place[ok] - shard.first[doc])],
                    schema=arrow,
                )

        return run

    found = None
    for block in blocks_of(benchmark):
        one = rows.mapInArrow(search(spark.sparkContext.broadcast(block)), schema)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], schema)
    best = F.min_by(F.struct("doc_id", "doc_word"), F.struct(-F.col("n_words"), "doc_id", "doc_word"))
    return found.groupBy("item_id", "word").agg(F.max("n_words").alias("n_words"), best.alias("at")).select(
        "item_id", "word", "n_words", "at.doc_id", "at.doc_word"
    )


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids, contaminated: at least one word hit, and hits are a twentieth of all words or more."""
    found = find_hits(docs, benchmark)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "item_ids").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns kept. Ids judged contaminated are few and taken out by an anti join.

    Where documents share an id, all of them go if one is contaminated; documents without id are judged by their own text.
    """
    bad = stored(judged(docs.where(docs["doc_id"].isNotNull()), benchmark).where("contaminated").select("doc_id").distinct(), "contaminated")
    named = docs.where(docs["doc_id"].isNotNull()).join(counted(bad), "doc_id", "left_anti").select(docs.columns)
    nameless = docs.where(docs["doc_id"].isNull())
    texts = nameless.select(F.xxhash64("text").alias("doc_id"), "text").distinct()
    wrong = judged(texts, benchmark).where("contaminated").select(F.col("doc_id").alias("__bad_text"))
    nameless = nameless.join(wrong, F.xxhash64(nameless["text"]) == wrong["__bad_text"], "left_anti")
    return named.unionByName(nameless)
