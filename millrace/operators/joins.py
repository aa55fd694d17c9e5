"""Joins: regular, bounded in time, dictionary and dimension lookups.

No side carries a broadcast hint. Spark broadcasts a dictionary or dimension while its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise, and splits hot keys of a shuffle join at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.changelog import first_by_key

On = Sequence[tuple[str, str]]


def regular_join(left: DataFrame, right: DataFrame, on: On, how: str = "inner", split: bool = False) -> DataFrame:
    """Equi join of frames with distinct column names. ``how``: inner, left, right or full.

    Hot keys of a full join can't be split at run time. With ``split`` it is made as a left join plus the right rows without a
    partner, found against the distinct left keys: both sides are read twice, so they must give the same rows each time.
    """
    condition = reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in on])
    if how != "full" or not split:
        return left.join(right, condition, how)
    keys = left.select(*[F.col(l).alias(f"_k{i}") for i, (l, _) in enumerate(on)]).distinct()
    absent = reduce(lambda a, b: a & b, [right[r] == keys[f"_k{i}"] for i, (_, r) in enumerate(on)])
    lonely = right.join(keys, absent, "left_anti")
    return left.join(right, condition, "left").unionByName(lonely, allowMissingColumns=True)


def join_within(
    left: DataFrame,
    right: DataFrame,
    on: On,
    left_time: str,
    right_time: str,
    before_millis: int,
    after_millis: int,
    how: str = "inner",
) -> DataFrame:
    """Rows with equal keys whose right time lies in ``[left time - before, left time + after]``, both ends included.

    Time is cut into slots at least as wide as that range. A left row has one slot, a right row the one or two slots
    it can match in, and the slot joins key equality: rows of one hot key meet only their neighbours in time, on many
    tasks. Streams need watermarks on both times; the range then also tells when state can be dropped.

    ``how``: inner, left, left_semi, left_anti, right, full. A full join of streams is made without slots, as only
    one pass over both sides can tell which right rows found no partner.
    """
    flipped = [(r, l) for l, r in on]
    if how == "right":
        rows = join_within(right, left, flipped, right_time, left_time, after_millis, before_millis, "left")
        return rows.select(*left.columns, *right.columns)
    if how == "full" and not left.isStreaming:
        lonely = join_within(right, left, flipped, right_time, left_time, after_millis, before_millis, "left_anti")
        rows = join_within(left, right, on, left_time, right_time, before_millis, after_millis, "left")
        return rows.unionByName(lonely, allowMissingColumns=True)

    def in_range() -> Column:
        low, high = (F.expr(f"INTERVAL '{m / 1000:.3f}' SECONDS") for m in (-before_millis, after_millis))
        return (right[right_time] >= left[left_time] + low) & (right[right_time] <= left[left_time] + high)

    if how == "full":
        return left.join(right, reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in on]) & in_range(), how)
    width = max(before_millis + after_millis, 1000)
    first = F.floor((F.unix_millis(right_time) - after_millis) / width)
    last = F.floor((F.unix_millis(right_time) + before_millis) / width)
    left = left.withColumn("_slot_l", F.floor(F.unix_millis(left_time) / width))
    right = right.withColumn("_slot_r", F.explode(F.sequence(first, last)))
    equal = reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in [*on, ("_slot_l", "_slot_r")]])

    return left.join(right, equal & in_range(), how).drop("_slot_l", "_slot_r")


def interval_join(
    left: DataFrame, right: DataFrame, on: On, left_time: str, right_time: str, bound_millis: int, how: str = "inner"
) -> DataFrame:
    """``join_within`` the same bound on both sides."""
    return join_within(left, right, on, left_time, right_time, bound_millis, bound_millis, how)


def lookup_name(df: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Add the dictionary name of ``code``. Inner: rows with a code the dictionary lacks are dropped."""
    entries = dictionary.select(F.col("dic_code").alias("_dic_code"), F.col("dic_name").alias(name))
    return df.join(entries, F.col(code) == F.col("_dic_code"), "inner").drop("_dic_code")


@dataclass(frozen=True)
class Link:
    """One step along a dimension chain: where ``column`` equals ``key`` of ``table``, add ``fields``.

    ``fields`` maps new column to table column; later links may start from a column added here.
    """

    table: DataFrame
    column: str
    key: str
    fields: Mapping[str, str] = field(default_factory=dict)


def enrich(df: DataFrame, *links: Link) -> DataFrame:
    """Follow the links with left joins, so rows without a dimension entry stay, with nulls.

    Each table must hold one row per key, as an upserted dimension does.
    """
    for link in links:
        side = link.table.select(
            F.col(link.key).alias("_link_key"), *[F.col(src).alias(new) for new, src in link.fields.items()]
        )
        df = df.join(side, F.col(link.column) == F.col("_link_key"), "left")
        df = df.drop("_link_key")
    return df


def lookup_rows(wanted: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """One table row for each of many requests at once; requests without a row give nulls.

    ``on`` names the columns compared, all of them by equality. Of several rows for one request the first in column
    order is taken.
    """
    rest = [c for c in table.columns if c not in on]
    return wanted.join(first_by_key(table, list(on), rest), list(on), "left")
