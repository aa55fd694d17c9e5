"""WARC archives of web pages: a deterministic sharded writer, and the reader.

Records are dealt to ranges of page ids and sorted; each range writes files that are closed at a compressed size. Headers and digests are
made anew from the payload, every record is a gzip member of its own without time stamps, and a file gets its name
when it is complete. The manifest, written last, lists the files; readers open no others. The same table gives the same files, byte for byte.

Records with equal payloads: the one with the smallest page id is a response, the others are revisits that refer to it. Which they are is
found from digests alone; the few rows that say so join the pages in the sort, so a payload is shuffled once.

Defined cases: null html is an empty payload; a null url is written as ``urn:page:`` and the id; page ids may repeat: of equal records with one id the
first is the response, the others revisit it; rows without ``page_id`` come first and refer to no id; line ends in urls become spaces; an empty table
gives a manifest without files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shards import committed, dealt_by_range, file_system

ROLL_BYTES = 32 << 20
PAGES_PER_SHARD = 5_000
_LEVEL = 6
#: Record ids are made from page ids in this name space.
_NAMES = uuid.UUID("6d1c2a52-4d0e-5a6f-8f39-0d6f5f3f9a01")
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}/{copy}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, copy: int, url: str | None, payload: bytes, refers: tuple[int | None] | None, date: str) -> bytes:
    """One gzip member: a response, or a revisit of the first equal record of page ``refers``, with HTTP headers and without payload."""
    digest = digest32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if refers else payload)
    target = " ".join((url if url is not None else f"urn:page:{page_id}").split())
    headers = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", record_id(page_id, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest32(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Page-ID", "" if page_id is None else str(page_id)),
    ]
    if refers:
        headers += [
            ("WARC-Refers-To", record_id(refers[0], digest)),
            ("WARC-Profile", _REVISIT_PROFILE),
            ("Refers-To-Page-ID", "" if refers[0] is None else str(refers[0])),
        ]
    return _member(headers, block)


def file_header(name: str, date: str) -> bytes:
    block = b"software: millrace\r\nformat: WARC File Format 1.1\r\n"
    return _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, name)}>"), ("WARC-Date", date),
         ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
        block,
    )


def _marked(pages: DataFrame, least_bytes: int) -> DataFrame:
    """The pages, and before each page whose payload others share a row with the smallest page id of that payload."""
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = rows.where(F.octet_length("html") >= least_bytes)
    shared = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marks = large.select("page_id", "digest").distinct().join(shared, "digest")
    marks = marks.select("page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "first_id")
    return marks.unionByName(rows.select("page_id", "digest", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("long").alias("first_id")))


_MANIFEST = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES, pages_per_shard: int = PAGES_PER_SHARD,
    date: str = "2020-01-01T00:00:00Z",
) -> DataFrame:
    """Writes all pages and returns the manifest. Payloads of ``least_bytes`` or more are written once."""
    rows = dealt_by_range(_marked(pages, least_bytes), "page_id", pages_per_shard, "digest", "kind", "url")
    rows = rows.select("shard", "page_id", "digest", "kind", "url", "html", "first_id")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
        """(shard, record) in order. A mark stands right before the pages it is for."""
        held, marked, first_id, copies = None, False, None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                shard, page, digest, kind, url, html, first = (column[k].as_py() for column in batch.columns)
                if held != (page, digest):
                    held, marked, copies = (page, digest), False, 0
                if kind == 0:
                    marked, first_id = True, first
                    continue
                revisit = marked and (copies > 0 or page != first_id)
                yield shard, page_record(page, copies, url, html.encode(), (first_id,) if revisit else None, date)
                copies += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = records(batches)
        item, shard, file = next(source, None), None, 0
        while item is not None:
            shard, file = item[0], file + 1 if item[0] == shard else 0
            name = f"pages-{shard:06d}-{file:04d}.warc.gz"
            size, n = 0, 0
            with committed(f"{path}/{name}") as out:
                out.write(header := file_header(name, date))
                size += len(header)
                while item is not None and item[0] == shard and (not n or size < roll_bytes):
                    out.write(item[1])
                    size, n = size + len(item[1]), n + 1
                    item = next(source, None)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "file": name, "n_records": n, "n_bytes": size}], schema=_MANIFEST)

    rows.mapInArrow(run, "shard long, file string, n_records long, n_bytes long").write.parquet(f"{path}/manifest")
    return read_manifest(pages.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shard long, file string, n_records long, n_bytes long").parquet(f"{path}/manifest")


def members(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed gzip members of a stream, one at a time."""
    rest, unpacker, parts = b"", zlib.decompressobj(31), []
    while data := rest or stream.read(piece):
        parts.append(unpacker.decompress(data))
        rest = b""
        if unpacker.eof:
            rest = unpacker.unused_data
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends within a record")


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; the length must be right."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("no record of an archive, or a wrong length")
    return headers, rest[:size]


_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every page record of the archives in the manifest, with length and digest of its full payload (of revisits without the payload).

    Block digests, and payload digests of responses, are computed again and must agree.
    """
    manifest = read_manifest(spark, path)

    def rows_of(name: str) -> Iterator[dict]:
        system, inner = file_system(f"{path}/{name}")
        with system.open_input_stream(inner, compression=None) as stream:
            for member in members(stream):
                headers, block = parse_record(member)
                if headers["WARC-Type"] == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
                digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
                wrong = headers["WARC-Block-Digest"] != f"sha1:{digest32(block)}"
                if wrong or not revisit and (len(payload) != length or digest32(payload) != digest):
                    raise ValueError(f"{name}: {headers['WARC-Record-ID']} does not have its digests")
                number = lambda key: int(headers[key]) if headers.get(key) else None
                yield {
                    "page_id": number("Page-ID"), "url": headers["WARC-Target-URI"], "record_type": headers["WARC-Type"],
                    "payload_bytes": length, "payload_digest": digest, "refers_to": number("Refers-To-Page-ID"),
                    "payload": payload if payloads and not revisit else None,
                }

    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                some, size = [], 0
                for row in rows_of(name):
                    some.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(some, schema=schema)
                        some, size = [], 0
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema=schema)

    return manifest.select("file").repartition(min(max(1, manifest.count()), 2000), "file").mapInArrow(run, _READ)
