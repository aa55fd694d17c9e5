"""Token ids of whole texts with a byte-level BPE of the tokenizers library, and exact length histograms.

The tokenizer splits a text before every single space that a word follows, so what lies between two such places is encoded alone with the same result.
A batch of texts is cut there in bulk, each different piece is encoded once, and the ids of the texts are put together from
the pieces. Pieces met before are kept in arrays, up to a bound, and of them those that are met again and again. Texts in which that rule doesn't hold, with blanks after blanks or with an added token of
the vocabulary, are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import small_batches, stored
from millrace.llm.words import kept_in_worker, slices, text_bytes, text_hashes

#: Pieces kept by a worker, and their ids; beyond that it lets those go that it has met least.
PIECES_AT_MOST = 1_000_000
IDS_AT_MOST = 8_000_000
_PIECES_AT_ONCE = 400
BYTES_AT_ONCE = 1 << 20
_IRREGULAR = re.compile(r" (?:\s|$)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _begins(sizes: np.ndarray) -> np.ndarray:
    return (np.cumsum(sizes) - sizes).astype(np.int32)


def _places(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of each range, one range after the other."""
    places = np.repeat(begins - _begins(sizes), sizes)
    places += np.arange(len(places), dtype=np.int32)
    return places


class _Store:
    """Numbers put one after the other in an array that grows."""

    def __init__(self, kind: type) -> None:
        self.held, self.filled = np.zeros(1 << 16, kind), 0

    def put(self, values: np.ndarray) -> int:
        """Where the values lie now."""
        if self.filled + len(values) > len(self.held):
            more = max(len(values), len(self.held) // 2)
            self.held = np.concatenate([self.held[: self.filled], np.zeros(more, self.held.dtype)])
        self.held[self.filled : self.filled + len(values)] = values
        self.filled += len(values)
        return self.filled - len(values)

    def of(self, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.held[_places(begins, sizes)]


class Encoder:
    """Ids of many texts at once. One per task process."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = re.compile("|".join(re.escape(t.content) for t in added.values())) if added else None
        self.vocabulary_size = self.tokenizer.get_vocab_size()
        self.opens = np.zeros(max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1, bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.opens[number] = token.startswith("Ġ")
        self._clear()

    def _clear(self) -> None:
        #: hashes of the pieces, ascending, and the number of the piece of each
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        #: by number: where the bytes and the ids of a piece lie, how many there are, and in how many batches it was met
        self.bytes_at, self.n_bytes, self.ids_at, self.n_ids, self.met = (np.zeros(0, np.int32) for _ in range(5))
        self.bytes, self.ids = _Store(np.uint8), _Store(np.uint32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: pa.Array) -> None:
        """Encodes pieces not met before, many in one call: each begins with a space, and no other token does."""
        ids_at, n_ids = [self.ids_at], [self.n_ids]
        texts = pieces.to_numpy(zero_copy_only=False).tolist()
        for k in range(0, len(texts), _PIECES_AT_ONCE):
            some = texts[k : k + _PIECES_AT_ONCE]
            ids = self._whole([" " + " ".join(some)])[0]
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) != len(some):
                raise AssertionError("the vocabulary joins or splits pieces at spaces")
            ids_at.append((self.ids.put(ids) + begins).astype(np.int32))
            n_ids.append(np.diff(begins, append=len(ids)).astype(np.int32))
        data, offsets = text_bytes(pieces)
        self.bytes_at = np.concatenate([self.bytes_at, (self.bytes.put(data) + offsets[:-1]).astype(np.int32)])
        self.n_bytes = np.concatenate([self.n_bytes, np.diff(offsets).astype(np.int32)])
        self.ids_at, self.n_ids = np.concatenate(ids_at), np.concatenate(n_ids)
        self.met = np.concatenate([self.met, np.zeros(len(texts), np.int32)])

    def _forget(self) -> None:
        """Keeps the pieces that were met in most batches, half of the bound at most; those met before count half next time."""
        stay = np.zeros(len(self.met), bool)
        stay[self.numbers] = True
        least = 1
        while np.count_nonzero(self.met[stay] > least) > PIECES_AT_MOST // 2:
            least += 1
        stay &= self.met > least
        if self.n_ids[stay].sum() > IDS_AT_MOST // 2:
            stay[:] = False
        kept = stay[self.numbers]
        keys, numbers = self.keys[kept], (np.cumsum(stay) - 1).astype(np.int32)[self.numbers[kept]]
        data, ids = self.bytes.of(self.bytes_at[stay], self.n_bytes[stay]), self.ids.of(self.ids_at[stay], self.n_ids[stay])
        n_bytes, n_ids, met = self.n_bytes[stay], self.n_ids[stay], self.met[stay] // 2
        self._clear()
        self.keys, self.numbers, self.n_bytes, self.n_ids, self.met = keys, numbers, n_bytes, n_ids, met
        self.bytes.put(data)
        self.ids.put(ids)
        self.bytes_at, self.ids_at = _begins(n_bytes), _begins(n_ids)

    def _pieces(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of different pieces. Found by hash and compared byte by byte; of pieces with one hash the first is kept."""
        if len(self.met) > PIECES_AT_MOST or self.ids.filled > IDS_AT_MOST:
            self._forget()
        data, offsets = text_bytes(pieces)
        keys, n_bytes = text_hashes(data, offsets), np.diff(offsets).astype(np.int32)
        order = np.argsort(keys)
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(self.keys, keys[order])
        numbers = np.full(len(keys), -1, np.int32)
        here = np.flatnonzero(at < len(self.keys))
        here = here[self.keys[at[here]] == keys[here]]
        numbers[here] = self.numbers[at[here]]
        here = here[self.n_bytes[numbers[here]] == n_bytes[here]]
        own = data[_places(offsets[here].astype(np.int32), n_bytes[here])]
        equal = own == self.bytes.of(self.bytes_at[numbers[here]], n_bytes[here])
        known = np.zeros(len(keys), bool)
        known[here] = np.logical_and.reduceat(equal, _begins(n_bytes[here])) if len(here) else False
        fresh = np.flatnonzero(~known)
        if len(fresh):
            first = len(self.met)
            self._learn(pieces.take(pa.array(fresh)))
            named = numbers[fresh] < 0  # others share the hash of a known piece
            numbers[fresh] = first + np.arange(len(fresh))
            new, which = np.unique(keys[fresh[named]], return_index=True)
            place = at[fresh[named]][which]
            self.keys = np.insert(self.keys, place, new)
            self.numbers = np.insert(self.numbers, place, numbers[fresh[named]][which])
        self.met[numbers] += 1
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text begins in it. Null is an empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.array([bool(_IRREGULAR.search(t) or (self.added and self.added.search(t)) or t[:1].isspace()) for t in texts.to_pylist()], bool)
        plain = ~odd & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        parts = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        words, cuts = parts.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = words.dictionary_encode()
        piece = self._pieces(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int32)
        begins, lengths = self.ids_at[piece], self.n_ids[piece]
        # the first piece of a text has no space before it and is encoded as it stands
        heads = words.take(pa.array(cuts[:-1])).dictionary_encode()
        head_ids = self._whole(heads.dictionary.to_pylist())
        head_of, filled = heads.indices.to_numpy(zero_copy_only=False), self.ids.filled
        begins[cuts[:-1]] = np.array([self.ids.put(ids) for ids in head_ids], np.int32)[head_of]
        lengths[cuts[:-1]] = np.array([len(ids) for ids in head_ids], np.int32)[head_of]
        out = self.ids.of(begins, lengths)
        self.ids.filled = filled
        at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        sizes = np.zeros(len(texts), np.int64)
        sizes[plain] = np.diff(at[cuts])
        if not odd.any():
            return out, np.concatenate([[0], np.cumsum(sizes)])
        whole = self._whole(texts.filter(pa.array(odd)).to_pylist())
        sizes[odd] = [len(w) for w in whole]
        first = np.concatenate([[0], np.cumsum(sizes)])
        merged = np.zeros(int(first[-1]), np.uint32)
        merged[np.repeat(plain, sizes)] = out
        merged[np.repeat(odd, sizes)] = np.concatenate(whole)
        return merged, first


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder of a vocabulary; pieces met in one task serve the next."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
        kept_in_worker.append(_encoders.clear)
    return _encoders[path]


def encoded_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """source and n_tokens of each whole text, without any end id."""
    path = path or default_vocabulary()
    rows = docs.select("source", docs["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for part in slices(batch, limit=BYTES_AT_ONCE, keep=True):
                _, first = encode(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(first))], names=["source", "n_tokens"])

    return rows.mapInArrow(run, f"source {rows.schema['source'].dataType.simpleString()}, n_tokens long")


#: Lengths in the same stretch are summed up in one task; stretches are put together by their totals.
LENGTHS_PER_STRETCH = 1024


def length_histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """source, n_tokens, n_docs: how many texts of a source have each encoded length. Exact; texts don't leave their task.

    Written out, since answers read it more than once and encoding is dear.
    """
    with small_batches(docs.sparkSession, BYTES_AT_ONCE):
        return stored(encoded_lengths(docs, path).groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "length-histogram")


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds, per source and length L: docs_from and tokens_from (texts of L tokens or more), docs and tokens in all, and

    kept_at_limit: tokens that remain if every text is cut to L. Suffix sums are taken within stretches of lengths and the totals
    of the longer stretches added, so no task holds a whole source.
    """
    rows = histogram.withColumns({"stretch": F.floor(F.col("n_tokens") / LENGTHS_PER_STRETCH), "tokens": F.col("n_tokens") * F.col("n_docs")})
    totals = rows.groupBy("source", "stretch").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    longer = Window.partitionBy("source").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    source = Window.partitionBy("source")
    totals = totals.select(
        F.col("source").alias("s_source"), F.col("stretch").alias("s_stretch"),
        F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("d_longer"), F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("t_longer"),
        F.sum("d").over(source).alias("docs_in_all"), F.sum("t").over(source).alias("tokens_in_all"),
    )
    inside = Window.partitionBy("source", "stretch").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"d_here": F.sum("n_docs").over(inside), "t_here": F.sum("tokens").over(inside)})
    same = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("stretch") == F.col("s_stretch"))
    rows = rows.join(totals, same).withColumns({
        "docs_from": F.col("d_here") + F.col("d_longer"), "tokens_from": F.col("t_here") + F.col("t_longer"),
    })
    return rows.select(
        "source", "n_tokens", "n_docs", "docs_from", "tokens_from", "docs_in_all", "tokens_in_all",
        (F.col("tokens_in_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("kept_at_limit"),
    )


def kept_at(sums: DataFrame, limit: int) -> DataFrame:
    """Per source, the tokens that remain if every text is cut to ``limit``, for any limit, also one that no text has as length."""
    longer = F.col("n_tokens") > limit
    total = F.max("tokens_in_all")
    cut = F.coalesce(F.max(F.when(longer, F.col("tokens_from"))), F.lit(0)) - limit * F.coalesce(F.max(F.when(longer, F.col("docs_from"))), F.lit(0))
    return sums.groupBy("source").agg((total - cut).alias("kept"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """Per source, the smallest length with at least ``share`` of the texts at or below it; exact."""
    below: Column = F.col("docs_in_all") - F.col("docs_from") + F.col("n_docs")
    return sums.where(below >= share * F.col("docs_in_all")).groupBy("source").agg(F.min("n_tokens").alias("n_tokens"))
