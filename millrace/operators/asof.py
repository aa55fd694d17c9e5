"""Lookups as of a row's time: of all versions of a key, the last one that is not later than the row.

Two plans give the same rows. ``as_of_ranges`` numbers a key's versions and keeps them in pages, with pages of the pages' first times above them: a row finds
its page from level to level by equality of key and page number, so it meets one page of each level and not all versions of its key. Small levels are
broadcast, and rows of a key with very many versions are spread over its pages. ``as_of_chunks`` cuts time into chunks: rows and versions of a key and chunk are put
in order together, after one version that is carried in from the chunks before, so a key with a third of all rows, or with very many
versions, is spread over its chunks, and a version that holds for years is copied to chunks with rows only.

A version at the row's own time counts. Of versions at one time the last by ``order`` counts. A version marked as deleted ends the one before it, and no entry is in force
until the next. Rows without key or time have no entry.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.tables import broadcast_if_small

DAY_MILLIS = 24 * 3600 * 1000

#: Versions in a page, and pages in a page of the level above.
PAGE = 64
#: Up to so many entries a level is broadcast.
BROADCAST_ENTRIES = 100_000


@dataclass(frozen=True)
class Versions:
    """Versions of a keyed table.

    ``keys`` are compared with the columns of the rows, ``time`` is an instant, ``values`` are added to the rows, ``order`` settles equal times, and where the column
    ``deleted`` is true the key has no entry from then on.
    """

    rows: DataFrame
    keys: Sequence[str]
    time: str
    values: Sequence[str]
    order: Sequence[str] = ()
    deleted: str | None = None

    def key_names(self) -> list[str]:
        return [f"_asof_key_{k}" for k in range(len(self.keys))]

    def packed(self) -> DataFrame:
        """Keys, ``_asof_time`` in microseconds, ``_asof_order`` and ``_asof_entry``: a struct with ``gone`` and the values."""
        gone = F.coalesce(F.col(self.deleted), F.lit(False)) if self.deleted else F.lit(False)
        order = F.struct(*self.order) if self.order else F.lit(0)
        return self.rows.where(F.col(self.time).isNotNull()).select(
            *[F.col(k).alias(n) for k, n in zip(self.keys, self.key_names(), strict=True)],
            F.unix_micros(self.time).alias("_asof_time"),
            order.alias("_asof_order"),
            F.struct(gone.alias("gone"), *[F.col(v).alias(f"v{k}") for k, v in enumerate(self.values)]).alias("_asof_entry"),
        )

    def unpacked(self, rows: DataFrame, columns: Sequence[str], inner: bool) -> DataFrame:
        """The columns and the values of ``_asof_entry``."""
        held = F.col("_asof_entry").isNotNull() & ~F.coalesce(F.col("_asof_entry.gone"), F.lit(False))
        if inner:
            rows = rows.where(held)
        values = [F.when(held, F.col(f"_asof_entry.v{k}")).alias(v) for k, v in enumerate(self.values)]
        return rows.select(*columns, *values)


def as_of_ranges(
    rows: DataFrame, versions: Versions, on: Sequence[str], time: str, inner: bool = False, page: int = PAGE
) -> DataFrame:
    """By pages of versions. ``rows`` may be a stream; ``versions`` is a table."""
    keys = versions.key_names()
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    single = versions.packed().where(known).groupBy(*keys, "_asof_time").agg(F.max_by("_asof_entry", "_asof_order").alias("_asof_entry"))
    numbered = single.withColumn("_asof_place", F.row_number().over(Window.partitionBy(*keys).orderBy("_asof_time")) - 1)
    most, total, n_keys = single.groupBy(*keys).count().agg(F.max("count"), F.sum("count"), F.count(F.lit(1))).first()
    step = 1  # versions from one entry of a level to the next
    while step * page < (most or 0):
        step *= page
    at = F.unix_micros(time)
    found = rows.withColumn("_asof_page", F.lit(0).cast("long"))
    while step:
        pages = _pages(numbered, keys, step, page)
        if (total or 0) // step + n_keys <= BROADCAST_ENTRIES:
            pages = F.broadcast(pages) if step > 1 else broadcast_if_small(pages)
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(k) for c, k in zip(on, keys, strict=True)], F.col("_asof_page") == F.col("_asof_number"))
        met = F.try_element_at(F.filter("_asof_held", lambda entry: entry["time"] <= at), F.lit(-1))
        found = found.join(pages, same, "inner" if inner else "left")
        found = found.select(*rows.columns, met["entry"].alias("_asof_page" if step > 1 else "_asof_entry"))
        step //= page
    return versions.unpacked(found, rows.columns, inner)


def _pages(numbered: DataFrame, keys: Sequence[str], step: int, page: int) -> DataFrame:
    """Pages of a level as keys, ``_asof_number`` and ``_asof_held``: every ``step``-th version's time, with the version itself or the number of the page that begins with it."""
    number = F.floor(F.col("_asof_place") / (step * page)).cast("long")
    entry = F.col("_asof_entry") if step == 1 else F.floor(F.col("_asof_place") / step).cast("long")
    held = F.collect_list(F.struct(F.col("_asof_time").alias("time"), entry.alias("entry")))
    in_order = F.array_sort(held, lambda a, b: F.when(a["time"] < b["time"], -1).when(a["time"] > b["time"], 1).otherwise(0))
    return numbered.where(F.col("_asof_place") % step == 0).groupBy(*keys, number.alias("_asof_number")).agg(in_order.alias("_asof_held"))


def as_of_chunks(
    rows: DataFrame, versions: Versions, on: Sequence[str], time: str, inner: bool = False, chunk_millis: int = DAY_MILLIS
) -> DataFrame:
    """By order within a key's chunks of time; ``rows`` are read twice, so they must be the same each time."""
    keys = versions.key_names()
    place = [*keys, "_asof_chunk"]

    def chunk() -> Column:
        return F.floor(F.col("_asof_time") / (chunk_millis * 1000)).cast("long").alias("_asof_chunk")

    known = reduce(lambda a, b: a & b, [rows[c].isNotNull() for c in [*on, time]])
    timed = rows.where(known).select(
        *[rows[c].alias(k) for c, k in zip(on, keys, strict=True)], F.unix_micros(rows[time]).alias("_asof_time"), F.struct(*rows.columns).alias("_asof_row")
    )
    timed = timed.select("*", chunk())
    changes = versions.packed()
    changes = changes.select("*", chunk())
    # the version that a chunk with rows begins with: the last of the chunks before
    last = changes.groupBy(*place).agg(F.max_by("_asof_entry", F.struct("_asof_time", "_asof_order")).alias("_asof_entry"))
    spots = timed.select(*place).distinct().withColumn("_asof_wanted", F.lit(True))
    spots = last.join(spots, place, "full")
    before = Window.partitionBy(*keys).orderBy("_asof_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = spots.withColumn("_asof_entry", F.last("_asof_entry", True).over(before)).where("_asof_wanted AND _asof_entry IS NOT NULL")

    def part(df: DataFrame, kind: int, **given: Column) -> DataFrame:
        columns = {"_asof_time": F.lit(None).cast("long"), "_asof_order": _null_of(changes, "_asof_order"), "_asof_entry": _null_of(changes, "_asof_entry"), "_asof_row": _null_of(timed, "_asof_row")}
        return df.select(*place, F.lit(kind).alias("_asof_kind"), *[given.get(name, empty).alias(name) for name, empty in columns.items()])

    carried = part(carried, 0, _asof_entry=F.col("_asof_entry"))
    changed = part(changes, 1, _asof_time=F.col("_asof_time"), _asof_order=F.col("_asof_order"), _asof_entry=F.col("_asof_entry"))
    asked = part(timed, 2, _asof_time=F.col("_asof_time"), _asof_row=F.col("_asof_row"))
    # nulls come first: the carried version before all others
    in_order = Window.partitionBy(*place).orderBy("_asof_time", "_asof_kind", "_asof_order").rowsBetween(Window.unboundedPreceding, 0)
    found = carried.unionByName(changed).unionByName(asked).withColumn("_asof_entry", F.last("_asof_entry", True).over(in_order))
    found = versions.unpacked(found.where("_asof_kind = 2").select("_asof_row.*", "_asof_entry"), rows.columns, inner)
    if inner:
        return found
    nowhere = rows.where(~known).select("*", _null_of(changes, "_asof_entry").alias("_asof_entry"))
    return found.unionByName(versions.unpacked(nowhere, rows.columns, inner))


def _null_of(df: DataFrame, column: str) -> Column:
    return F.lit(None).cast(df.schema[column].dataType)
