"""Exact deduplication by an index of live digests, kept in buckets with a cuckoo filter each.

The digest of a text is the SHA-256 of the text with every run of white space as one space. It belongs to a bucket by hash. A bucket has a cuckoo filter over its live
digests and content files with the digests themselves, the row that stays and the number of rows. Documents come in batches: every task first puts
together the equal digests of its own rows, so a text that a third of all rows have arrives as one row per task, and sends them to their buckets. There a digest
the filter does not know is new and costs no look at the content. A digest it knows is looked up in the content, for filters err in this direction, and counts as new
if it isn't there. Content is appended: a batch adds one file with what is new or more in the bucket, and many files are put together into one. A filter without room is built
anew, twice as large, from the stored digests. Texts can be deleted from the index: their digests leave filter and content, and the same text inserted later is new.

Every insertion or deletion is a version with a manifest of its buckets' files. Files get their names when they are whole, and names follow from version and bucket, so
repeated or doubled tasks replace files by equal ones. A version counts once its manifest is complete; a version that did not get there is done again.

Defined cases: null texts are empty, and equal to texts without any character but not to blank ones, which are one space; of equal texts the row with the smallest id stays, rows without id come
after all others, and of rows that share id and text the one inserted first stays, exactly one in any case; ``keep_id`` is null where only rows without id have the text.
A row inserted later with a smaller id takes over: ``decided`` gives the state of the index when it is called. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.cuckoo import CuckooFilter
from millrace.llm.shards import committed, file_system
from millrace.llm.tables import stored

KEYS_PER_BUCKET = 1 << 17
LEAST_BUCKETS = 64
_COMBINED_AT_ONCE = 100_000
FILES_AT_MOST = 8
_CHUNK = 4096
_SPACES = r"[\x20\x09-\x0D]+"

_MANIFEST = "bucket long, filter string, files array<string>, n_keys long, n_hits long, n_false_hits long, n_resizes long"
_CONTENT = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("since", pa.int64()), ("row", pa.int64()), ("n", pa.int64())])

#: The row that stays, in the order of which comes first, and the number of rows.
Entry = tuple[tuple[bool, int, int, int], int]


def text_digest(text: Column) -> Column:
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _SPACES, " ")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def digest_of(text: str) -> bytes:
    """The same for one text that is plain already."""
    return hashlib.sha256(text.encode()).digest()


def _merged(into: dict[bytes, Entry], digest: bytes, entry: Entry) -> None:
    held = into.get(digest)
    into[digest] = entry if held is None else (min(held[0], entry[0]), held[1] + entry[1])


def _entries(columns: Iterable[pa.Array]) -> Iterator[tuple[bytes, Entry]]:
    """Digests and entries from the columns of ``_CONTENT``."""
    for digest, doc, since, row, n in zip(*(c.to_pylist() for c in columns), strict=True):
        yield digest, ((doc is None, doc or 0, since, row), n)


def _table(entries: dict[bytes, Entry]) -> pa.Table:
    """In the order of the digests."""
    rows = [(d, None if first[0] else first[1], first[2], first[3], n) for d, (first, n) in sorted(entries.items())]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, _CONTENT, strict=True)], schema=_CONTENT)


def _combined(rows: DataFrame) -> DataFrame:
    """Equal digests of a task's rows put together, as far as they fit in memory at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Entry] = {}
        for batch in batches:
            for digest, entry in _entries(batch.columns):
                _merged(held, digest, entry)
            if len(held) >= _COMBINED_AT_ONCE:
                yield from _table(held).to_batches()
                held = {}
        yield from _table(held).to_batches()

    one = rows.select("digest", "doc_id", "since", "row", F.lit(1).cast("long").alias("n"))
    return one.mapInArrow(run, "digest binary, doc_id long, since long, row long, n long")


def _keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:16] for d in digests), np.uint64).reshape(-1, 2)


class _Bucket:
    """One bucket's filter and content, as a task holds it."""

    def __init__(self, path: str, state: dict, version: int, files_at_most: int = FILES_AT_MOST) -> None:
        self.path, self.state, self.version, self.files_at_most = path, state, version, files_at_most
        if state["filter"]:
            system, inner = file_system(f"{path}/{state['filter']}")
            with system.open_input_stream(inner) as stream:
                self.filter = CuckooFilter.from_bytes(stream.read())
        else:
            self.filter = CuckooFilter.for_keys(0)
        self._content: dict[bytes, Entry] | None = None

    @property
    def content(self) -> dict[bytes, Entry]:
        """What the content files hold, read at the first need."""
        if self._content is None:
            self._content = {}
            for name in self.state["files"]:
                system, inner = file_system(f"{self.path}/{name}")
                with system.open_input_file(inner) as stream:
                    for digest, entry in _entries(pq.read_table(stream, schema=_CONTENT).columns):
                        _merged(self._content, digest, entry)
        return self._content

    def _enter(self, fresh: list[bytes], known: Iterable[bytes]) -> None:
        """New digests into the filter; without room a larger one is built from the stored digests."""
        if not fresh or self.filter.insert(_keys(fresh)):
            return
        live = list({*self.content, *known, *fresh})
        buckets = 2 * len(self.filter.slots)
        while True:
            self.filter = CuckooFilter(max(buckets, len(CuckooFilter.for_keys(len(live)).slots)))
            self.state["n_resizes"] += 1
            if self.filter.insert(_keys(live)):
                return
            buckets = 2 * len(self.filter.slots)

    def insert(self, arrived: Iterator[tuple[bytes, Entry]]) -> None:
        added: dict[bytes, Entry] = {}
        rows = list(arrived)
        for k in range(0, len(rows), _CHUNK):
            chunk: dict[bytes, Entry] = {}
            for digest, entry in rows[k : k + _CHUNK]:
                _merged(chunk, digest, entry)
            digests = list(chunk)
            met = self.filter.contains(_keys(digests))
            hits = [d for d, hit in zip(digests, met, strict=True) if hit]
            there = {d for d in hits if d in added or d in self.content}
            self._enter([d for d in digests if d not in there], added)
            self.state["n_hits"] += len(there)
            self.state["n_false_hits"] += len(hits) - len(there)
            self.state["n_keys"] += len(digests) - len(there)
            for digest, entry in chunk.items():
                _merged(added, digest, entry)
        if len(self.state["files"]) >= self.files_at_most:
            for digest, entry in self.content.items():
                _merged(added, digest, entry)
            self.state["files"] = []
        self._write(added)

    def delete(self, digests: list[bytes]) -> None:
        met = self.filter.contains(_keys(digests)) if digests else []
        gone = [d for d, hit in zip(digests, met, strict=True) if hit and d in self.content]
        if not gone:
            return
        self.filter.delete(_keys(gone))
        self.state["n_keys"] -= len(gone)
        self.state["files"] = []
        self._write({d: e for d, e in self.content.items() if d not in set(gone)})

    def _write(self, entries: dict[bytes, Entry]) -> None:
        name = f"{self.state['bucket']:07d}-{self.version:06d}"
        with committed(f"{self.path}/content/{name}.parquet") as out:
            pq.write_table(_table(entries), out)
        with committed(f"{self.path}/filters/{name}.bin") as out:
            out.write(self.filter.to_bytes())
        self.state["files"] = [*self.state["files"], f"content/{name}.parquet"]
        self.state["filter"] = f"filters/{name}.bin"


class DedupIndex:
    """An index under a folder that driver and executors share."""

    #: a bucket with so many content files puts them together at the next insertion
    files_at_most = FILES_AT_MOST

    def __init__(self, spark: SparkSession, path: str, buckets: int, version: int) -> None:
        self.spark, self.path, self.buckets, self.version = spark, path, buckets, version

    @classmethod
    def create(cls, spark: SparkSession, path: str, expected_keys: int) -> DedupIndex:
        """An empty index, in buckets of about ``KEYS_PER_BUCKET`` of the digests expected; there may be more of them."""
        index = cls(spark, path, max(LEAST_BUCKETS, -(-expected_keys // KEYS_PER_BUCKET)), 0)
        empty = [F.col("id").alias("bucket"), F.lit(None).cast("string").alias("filter"), F.array().cast("array<string>").alias("files")]
        counts = [F.lit(0).cast("long").alias(c) for c in ("n_keys", "n_hits", "n_false_hits", "n_resizes")]
        spark.range(index.buckets).select(*empty, *counts).write.mode("overwrite").parquet(index._manifest_path(0))
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DedupIndex:
        """The last complete version."""
        from pyarrow import fs

        system, inner = file_system(f"{path}/versions")
        found = system.get_file_info(fs.FileSelector(inner, recursive=True))
        version = max(int(f.path.rsplit("/", 2)[1]) for f in found if f.base_name == "_SUCCESS")
        index = cls(spark, path, 0, version)
        index.buckets = index.manifest().count()
        return index

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/versions/{version:06d}"

    def manifest(self) -> DataFrame:
        """A row for each bucket: its files, live digests, and how often the filter was right, wrong and rebuilt."""
        return self.spark.read.schema(_MANIFEST).parquet(self._manifest_path(self.version))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).alias("bucket")

    def _next_version(self, arrived: DataFrame, change) -> None:
        """Applies ``change(bucket, rows)`` to every bucket with rows and commits the manifest of all."""
        path, version, most = self.path, self.version + 1, self.files_at_most

        def run(rows: pa.Table, manifest: pa.Table) -> pa.Table:
            state = manifest.to_pylist()[0]
            if rows.num_rows:
                change(_Bucket(path, state, version, most), rows)
            return pa.Table.from_pylist([state], schema=manifest.schema)

        held = self.manifest()
        changed = arrived.select("*", self._bucket()).groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(run, _MANIFEST)
        changed.write.mode("overwrite").parquet(self._manifest_path(version))
        self.version = version

    def rows_of(self, docs: DataFrame) -> DataFrame:
        """doc_id, digest and place of every row, written once."""
        place = [F.lit(self.version + 1).cast("long").alias("since"), F.monotonically_increasing_id().alias("row")]
        return stored(docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_digest(docs["text"]).alias("digest"), *place), "dedup-rows")

    def insert(self, docs: DataFrame) -> DataFrame:
        """Inserts all rows; returns them as ``decided`` wants them."""
        rows = self.rows_of(docs)
        names = _CONTENT.names
        self._next_version(_combined(rows), lambda bucket, found: bucket.insert(_entries(found.select(names).columns)))
        return rows

    def delete(self, docs: DataFrame) -> None:
        """The texts of the rows leave the index, whatever their ids."""
        digests = docs.select(text_digest(docs["text"]).alias("digest")).distinct()
        self._next_version(digests, lambda bucket, found: bucket.delete(found.column("digest").to_pylist()))

    def content(self, least_rows: int = 1) -> DataFrame:
        """digest, the row that stays (doc_id, since, row) and n, the number of rows, of every live digest with ``least_rows`` or more."""
        path = self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for state in batch.to_pylist():
                    if state["files"]:
                        held = _Bucket(path, state, 0).content
                        yield from _table({d: e for d, e in held.items() if e[1] >= least_rows}).to_batches()

        readers = min(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return self.manifest().repartition(readers, "bucket").mapInArrow(run, "digest binary, doc_id long, since long, row long, n long")

    def decided(self, rows: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size, kept and text_sha256 of inserted rows. Only texts that several rows have are joined to them."""
        several = self.content(least_rows=2)
        several = several.select("digest", F.col("doc_id").alias("first_id"), F.col("since").alias("first_since"), F.col("row").alias("first_row"), "n")
        placed = rows.join(several, "digest", "left")
        alone = F.col("n").isNull()
        return placed.select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("first_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
            (alone | ((F.col("since") == F.col("first_since")) & (F.col("row") == F.col("first_row")))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def deduplicate(docs: DataFrame, path: str) -> DataFrame:
    """Decisions on all documents by a new index under ``path``."""
    index = DedupIndex.create(docs.sparkSession, path, docs.count())
    return index.decided(index.insert(docs))
