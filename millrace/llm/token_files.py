"""Token ids of a corpus in bit-packed files, in ascending order of documents.

Every id takes as many bits as the largest id of the vocabulary needs. Ids lie in blocks of ``BLOCK_IDS``; a block is packed as rows of 64 ids in as many 64-bit
words as an id has bits, so numpy unpacks a block by 64 shifts, and any id is found from its number alone.

File: header (magic, bits, ids per block), blocks, then the footer: offset of each block, document ids, number of ids of each document; its
sizes and place; magic. Shards are ranges of document ids. A file is written under a temporary name and then named; the manifest, written last,
lists the files that belong to the corpus, and only they are read.

Defined cases: null and empty texts hold the end id alone; rows without ``doc_id`` come first; rows with equal ids are in the order of
their texts, each on its own; an empty table gives a manifest without files; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shards import committed, dealt_by_range, file_system
from millrace.llm.tables import small_batches
from millrace.llm.tokens import BYTES_AT_ONCE, default_vocabulary, encoder
from millrace.llm.words import let_go, release_memory, slices

END_ID = 0
BLOCK_IDS = 1 << 16
DOCS_PER_SHARD = 10_000
_MAGIC = b"IDBITS01"
_HEADER = struct.Struct("<8sHI")
_TAIL = struct.Struct("<QQQQQ8s")  # blocks, documents, documents without id, ids, place of the footer


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in rows of 64, each row in ``bits`` 64-bit words, little end first; the last row is filled up with zeros."""
    rows = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    rows.ravel()[: len(ids)] = ids
    words = np.zeros((len(rows), bits), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= rows[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= rows[:, k] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    rows = np.zeros((len(words), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        rows[:, k] = value & mask
    return rows.ravel()[:n]


class TokenWriter:
    """Appends documents to one open stream; holds one block and the document table."""

    def __init__(self, out, bits: int) -> None:
        self.out, self.bits = out, bits
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_null = 0
        self.docs: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.offsets: list[int] = []
        out.write(_HEADER.pack(_MAGIC, bits, BLOCK_IDS))
        self.at = _HEADER.size

    def add(self, docs: np.ndarray, n_null: int, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.n_null += n_null
        self.docs.append(docs)
        self.sizes.append(sizes)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= BLOCK_IDS:
            self._blocks(self.n_held // BLOCK_IDS * BLOCK_IDS)

    def _blocks(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for k in range(0, n, BLOCK_IDS):
            data = pack(ids[k : min(k + BLOCK_IDS, n)], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._blocks(self.n_held)
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, np.int64)
        for part in (np.array(self.offsets), docs, np.concatenate(self.sizes) if self.sizes else docs):
            self.out.write(part.astype("<i8").tobytes())
        self.out.write(_TAIL.pack(len(self.offsets), len(docs), self.n_null, self.n_ids, self.at, _MAGIC))


class TokenFile:
    """Reads one file: the document table at once, ids block by block as they are asked for."""

    def __init__(self, path: str) -> None:
        system, inner = file_system(path)
        self.file = system.open_input_file(inner)
        magic, self.bits, self.block_ids = _HEADER.unpack(self._at(0, _HEADER.size))
        tail = _TAIL.unpack(self._at(self.file.size() - _TAIL.size, _TAIL.size))
        n_blocks, self.n_docs, self.n_null, self.n_ids, footer, magic_at_end = tail
        if magic != _MAGIC or magic_at_end != _MAGIC:
            raise ValueError(f"{path} is no token file")
        table = np.frombuffer(self._at(footer, 8 * (n_blocks + 2 * self.n_docs)), "<i8")
        self.offsets, self.docs, self.sizes = np.split(table, [n_blocks, n_blocks + self.n_docs])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _at(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start + n of the file; only the blocks they lie in are read."""
        if not n:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (start + n - 1) // self.block_ids
        parts = []
        for block in range(first, last + 1):
            held = min(self.block_ids, self.n_ids - block * self.block_ids)
            parts.append(unpack(self._at(int(self.offsets[block]), -(-held // 64) * self.bits * 8), self.bits, held))
        return np.concatenate(parts)[start - first * self.block_ids :][:n]

    def documents(self, ids_at_once: int = 1 << 22) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, start, ids) of every document, read in stretches of about ``ids_at_once`` ids; a longer document is read whole."""
        d = 0
        while d < self.n_docs:
            end = max(d + 1, int(np.searchsorted(self.starts, self.starts[d] + ids_at_once)))
            base = int(self.starts[d])
            ids = self.ids(base, int(self.sizes[d:end].sum()))
            for k in range(d, end):
                start = int(self.starts[k])
                yield (None if k < self.n_null else int(self.docs[k])), start, ids[start - base : start - base + int(self.sizes[k])]
            d = end


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """Writes the corpus and returns the manifest: shard, file, n_docs, n_ids and start (ids of all shards before).

    Texts are dealt to ranges of document ids and encoded where their file is written, so each text moves once and ids move never.
    """
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = dealt_by_range(rows, "doc_id", docs_per_shard, "text").select("shard", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        bits = bits_for(own.vocabulary_size)
        parts = (part for batch in batches for part in slices(batch, limit=BYTES_AT_ONCE, keep=True))
        part, row = next(parts, None), 0
        while part is not None:
            shard = part.column(0)[row].as_py()
            name = f"ids-{shard:06d}.bits"
            with committed(f"{path}/{name}") as out:
                writer = TokenWriter(out, bits)
                while part is not None and part.column(0)[row].as_py() == shard:
                    end = int(np.searchsorted(part.column(0).to_numpy(), shard, "right"))
                    own_rows = part.slice(row, end - row)
                    ids, first = own.encode(own_rows.column(2))
                    ids = np.insert(ids, first[1:], END_ID)
                    keys = own_rows.column(1)
                    writer.add(keys.fill_null(0).to_numpy(), keys.null_count, np.diff(first) + 1, ids)
                    row = end
                    if row == part.num_rows:
                        part, row = next(parts, None), 0
                writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "file": name, "n_docs": sum(map(len, writer.docs)), "n_ids": writer.n_ids}],
                schema=pa.schema([("shard", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    written = rows.mapInArrow(run, "shard long, file string, n_docs long, n_ids long")
    with small_batches(docs.sparkSession, BYTES_AT_ONCE):
        written.write.parquet(f"{path}/manifest")
    return read_manifest(docs.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, with the number of ids before it. A few bytes per file go through one task, no ids or documents."""
    manifest = spark.read.schema("shard long, file string, n_docs long, n_ids long").parquet(f"{path}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over little-endian 32-bit ids) of every document of the files, read back."""
    manifest = read_manifest(spark, path)
    files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # the files are written, and reading needs no encoder
        release_memory()
        for batch in batches:
            for row in batch.to_pylist():
                found = [
                    (doc, row["start"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc, start, ids in TokenFile(f"{path}/{row['file']}").documents()
                ]
                columns = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.repartition(min(files, 2000), "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
