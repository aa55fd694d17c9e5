"""Change-log rules: control records, table selection, changed columns, latest version per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.codes import BOOTSTRAP_TYPES
from millrace.functions import times


def drop_control_records(changes: DataFrame) -> DataFrame:
    """Keep data records: a type that is no bootstrap marker, and a row image."""
    return changes.where(
        F.col("type").isNotNull() & ~F.col("type").isin(*BOOTSTRAP_TYPES) & F.col("data").isNotNull()
    )


def select_changes(
    changes: DataFrame,
    table: str,
    fields: Mapping[str, str] | Sequence[str],
    types: Sequence[str] = (),
    where: Column | None = None,
    **extra: Column,
) -> DataFrame:
    """Changes of one table (and of the given types) with ``fields`` of the row image as columns.

    ``fields`` maps output name to field name, or lists names kept as they are; ``extra`` adds columns, such as
    the change time. Both the table test and the type test are plain column filters, so a log partitioned by
    ``table`` is pruned.
    """
    if not isinstance(fields, Mapping):
        fields = {name: name for name in fields}
    rows = changes.where(F.col("table") == table)
    if types:
        rows = rows.where(F.col("type").isin(*types))
    if where is not None:
        rows = rows.where(where)
    return rows.select(
        *[F.col("data")[field].alias(name) for name, field in fields.items()],
        *[column.alias(name) for name, column in extra.items()],
    )


def changed(field: str) -> Column:
    """True where this update changed ``field``: its old value is recorded."""
    return F.col("old")[field].isNotNull()


def became(field: str, value: str) -> Column:
    """True where this update set ``field`` to ``value``."""
    return (F.col("data")[field] == value) & changed(field)


def change_time() -> Column:
    """Event time of a change record."""
    return times.from_second_text("ts")


def _pick(df: DataFrame, keys: Sequence[Column | str], pick) -> DataFrame:
    """One row per key, packed and picked by an aggregate.

    Not a ranked window: copies of one key are reduced where they are read, before the exchange. Named keys stay
    grouping columns of the result, so a later step on them needs no exchange.
    """
    named = [k for k in keys if isinstance(k, str)]
    rest = [c for c in df.columns if c not in named]
    made = [k.alias(f"_key_{i}") for i, k in enumerate(keys) if not isinstance(k, str)]
    picked = df.groupBy(*named, *made).agg(pick(F.struct(*rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in named else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The last version of each key by ``order`` (later columns break ties)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    return _pick(df, keys, lambda row: F.max_by(row, F.struct(*order)))


def first_by_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``."""
    return _pick(df, keys, lambda row: F.min_by(row, F.struct(*order)))


def current_config(changes: DataFrame, seq: str | Sequence[str] = "ts_ms") -> DataFrame:
    """Configuration in force: the last change of each source table, deleted ones left out."""
    order = [seq] if isinstance(seq, str) else list(seq)
    entry = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    keyed = changes.select("op", *order, entry.alias("entry")).withColumn("source_table", F.col("entry.source_table"))
    return latest_by_key(keyed, "source_table", order).where("op <> 'd'").select("entry.*")
