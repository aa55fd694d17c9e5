"""Ranges of an integer key with about equal numbers of rows, the same on every run, and files written under temporary names.

Spark's own range partitioning draws its bounds from a sample that differs from run to run; files cut by it would differ too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 64


def _counts(df: DataFrame, key: str, bounds: np.ndarray) -> np.ndarray:
    """Rows with bounds[i] <= key < bounds[i + 1]; one number per range comes to the driver, whatever the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(bounds, batch.column(0).to_numpy(zero_copy_only=False), "right")
            total += np.bincount(at, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    found = df.where(df[key].isNotNull()).select(df[key].cast("long")).mapInArrow(run, "at long, n long")
    out = np.zeros(len(bounds) + 1, np.int64)
    for row in found.groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["at"]] = row["n"]
    return out


def range_bounds(df: DataFrame, key: str, rows_per_range: int) -> np.ndarray:
    """Inner bounds of ranges of at most about ``rows_per_range`` rows. A range holds more only if one key has more rows.

    A grid over the keys is counted, and cells with too many rows are cut again; then neighbours are put together.
    """
    ends = df.agg(F.min(key).cast("long").alias("low"), F.max(key).cast("long").alias("high"), F.count(key).alias("n")).first()
    if not ends["n"]:
        return np.zeros(0, np.int64)
    cells = min(max(_PARTS, 8 * -(-ends["n"] // rows_per_range)), ends["high"] - ends["low"] + 1)
    width = ends["high"] - ends["low"] + 1
    bounds = sorted({ends["low"] + width * k // cells for k in range(cells)})
    while True:
        counts = _counts(df, key, np.array(bounds, np.int64))[1:]
        after = [*bounds[1:], ends["high"] + 1]
        full = [k for k, n in enumerate(counts) if n > rows_per_range and after[k] - bounds[k] > 1]
        if not full:
            break
        finer = {bounds[k] + (after[k] - bounds[k]) * j // _PARTS for k in full for j in range(1, _PARTS)}
        bounds = sorted({*bounds, *finer})
    inner, held = [], 0
    for bound, n in zip(bounds, counts.tolist(), strict=True):
        if held and held + n > rows_per_range:
            inner.append(bound)
            held = 0
        held += n
    return np.array(inner, np.int64)


def shard_of(key: Column, bounds: np.ndarray) -> Column:
    """Number of the range a key lies in; null keys lie in the first."""

    @F.pandas_udf("long")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), "right"))

    lowest = int(bounds[0]) - 1 if len(bounds) else 0
    return number(F.coalesce(key.cast("long"), F.lit(lowest)))


def dealt_by_range(df: DataFrame, key: str, rows_per_range: int, *order: str) -> DataFrame:
    """Rows with ``shard``, each shard whole in a partition of its own and in the order of the key and ``order``."""
    bounds = range_bounds(df, key, rows_per_range)
    placed = df.withColumn("shard", shard_of(F.col(key), bounds))
    return placed.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", key, *order)


def file_system(path: str):
    """The Arrow file system of a path or URI, and the path within it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@contextmanager
def committed(path: str):
    """A stream into a temporary file beside ``path`` that gets its name when all is written.

    The name depends on the content's place alone: a repeated or doubled task replaces the file by an equal one.
    """
    system, inner = file_system(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    temporary = f"{inner}.{uuid.uuid4().hex}.tmp"
    try:
        with system.open_output_stream(temporary, compression=None) as out:
            yield out
    except BaseException:
        system.delete_file(temporary)
        raise
    system.move(temporary, inner)
