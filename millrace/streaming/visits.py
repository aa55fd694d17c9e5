"""Streaming forms of the visit rules.

The keyed-state forms serve live topics and follow arrival: rows of earlier micro-batches are not revisited, so a row that arrives after
later ones is judged against the state it finds. Those that feed a window report work on logs whose ``ts`` carries a watermark and chain into it.

``first_visits`` and ``anchors`` don't follow arrival: they are minima that only fall, give a new version when an earlier row
comes, and end in the rows of the table form however the log is cut into micro-batches. A replay uses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from millrace.operators import trade, visits
from millrace.streaming.pages import GROUP, with_groups
from millrace.streaming.processors import MILLIS, Bounces, FirstInWindow, FirstOfDay, LatestAfterDelay, NewFlagRepair

# Watermark delay of the reports, wait of the version filter, life of a day's state.
WATERMARK = "3 seconds"
VERSION_WAIT_MILLIS = 5000
DAY_MILLIS = 24 * 3600 * 1000


def with_watermark(log: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return log.withWatermark("ts", delay)


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MILLIS, F.unix_millis("ts"))


def _added(rows: DataFrame) -> StructType:
    return StructType(list(rows.schema.fields)).add("previous_day", StringType()).add("is_first", LongType())


def _marked(rows: DataFrame, keys: list[str], order, keep_all=False, expire=True) -> DataFrame:
    """First rows per date, in event time: late rows are dropped, and a window report may follow."""
    rows = _timed(rows)
    return with_groups(rows, keys).groupBy(GROUP).transformWithStateInPandas(
        FirstOfDay(order, keep_all, expire),
        outputStructType=_added(rows),
        outputMode="append",
        timeMode="eventTime",
        eventTimeColumnName="ts",
    )


def repair_new_flag(log: DataFrame) -> DataFrame:
    """No row is late here and the state is kept for good; ``log`` needs no watermark."""
    return log.groupBy("mid").transformWithStateInPandas(
        NewFlagRepair(visits.ORDER), outputStructType=log.schema, outputMode="append", timeMode="none"
    )


def anchors(log: DataFrame) -> DataFrame:
    """``mid, anchor`` by ``visits.first_visit_dates``, in update mode: the last version of a device holds for all rows seen."""
    return visits.first_visit_dates(log)


def first_visits(log: DataFrame) -> DataFrame:
    """The first visit start of each device and date as ``mid, day`` and the row, in update mode: the last version holds."""
    return visits.first_entries(log)


def unique_visitors(log: DataFrame, ttl_millis: int | None = None) -> DataFrame:
    """No row is late here; ``log`` needs no watermark.

    With ``ttl_millis`` idle devices are forgotten after that long. Such a stream has to be started with an interval:
    it runs on processing time and so never counts as worked off.
    """
    rows = _timed(log.where(visits.is_entry()))
    marked = with_groups(rows, ["mid"]).groupBy(GROUP).transformWithStateInPandas(
        FirstOfDay(visits.ORDER, ttl_millis=ttl_millis),
        outputStructType=_added(rows),
        outputMode="append",
        timeMode="none" if ttl_millis is None else "processingTime",
    )
    return marked.select(*log.columns)


def bounces(log: DataFrame, timeout_millis: int = 10_000) -> DataFrame:
    """Bounces come out behind the watermark, by the time that had to pass first.

    They therefore end a query; a report reads them as an input of its own, with its own watermark.
    """
    rows = _timed(log)
    return rows.groupBy("mid").transformWithStateInPandas(
        Bounces(rows.schema, visits.ORDER, timeout_millis),
        outputStructType=rows.schema,
        outputMode="append",
        timeMode="eventTime",
    ).drop(MILLIS)


def home_detail_visits(log: DataFrame) -> DataFrame:
    pages = log.where(F.col("page_id").isin("home", "good_detail")).select("mid", "page_id", "ts", "log_id")
    return _marked(pages, ["mid", "page_id"], visits.ORDER).select(
        "mid",
        "ts",
        (F.col("page_id") == "home").cast("bigint").alias("home_uv_ct"),
        (F.col("page_id") == "good_detail").cast("bigint").alias("good_detail_uv_ct"),
    )


def login_days(log: DataFrame, back_after_days: int = 8) -> DataFrame:
    """The state of this rule never expires: a user may return after any time."""
    rows = visits.logins(log).select("uid", "ts", "log_id")
    gap = F.datediff(F.to_date("ts"), F.col("previous_day").cast("date"))
    return _marked(rows, ["uid"], visits.ORDER, expire=False).select(
        "uid",
        "ts",
        F.lit(1).cast("bigint").alias("uu_ct"),
        F.when(gap >= back_after_days, 1).otherwise(0).cast("bigint").alias("back_ct"),
    )


def cart_add_users(facts: DataFrame) -> DataFrame:
    """First addition of each user and date; ``facts`` are cart additions with ``ts`` as a watermarked timestamp."""
    return _marked(facts, ["user_id"], ("ts", "id")).select(*facts.columns)


def flag_order_users(lines: DataFrame) -> DataFrame:
    """All measure rows, with ``order_uu_count`` 1 on the first of each user and date."""
    return _marked(lines, ["user_id"], ("ts", "id"), keep_all=True).select(
        *lines.columns, F.col("is_first").alias("order_uu_count")
    )


#: How many keys the products of a window are dealt over, so that many tasks share a full window and a thin one is not a key per product.
PRODUCT_BUCKETS = 16


def mark_new_orders(lines: DataFrame, size: str, buckets: int = PRODUCT_BUCKETS) -> DataFrame:
    """All rows, with ``new_order`` 1 on the first row of each order of a product and window, so that distinct orders are a sum."""
    ends = F.unix_millis(F.window("ts", size)["end"])
    member = F.to_json(F.struct("sku_id", "order_id"))
    rows = lines.withColumns({
        "window_ends": ends, "product_bucket": F.pmod(F.xxhash64("sku_id"), F.lit(buckets)), "member": F.when(F.col("order_id").isNotNull(), member),
    })
    marked = rows.groupBy("window_ends", "product_bucket").transformWithStateInPandas(
        FirstInWindow("member", "window_ends"),
        outputStructType=StructType(list(rows.schema.fields)).add("is_first", LongType()),
        outputMode="append",
        timeMode="eventTime",
        eventTimeColumnName="ts",
    )
    return marked.select(*lines.columns, F.col("is_first").alias("new_order"))


def sku_order_window(flagged: DataFrame, size: str = trade.SIZE, buckets: int = PRODUCT_BUCKETS) -> DataFrame:
    """Users, distinct orders and amounts per product and window, the distinct orders from keyed state."""
    return trade.sku_order_window(mark_new_orders(flagged, size, buckets), size, F.sum("new_order").cast("bigint"))


def latest_versions(rows: DataFrame, key: str, version: str, wait_millis: int = VERSION_WAIT_MILLIS) -> DataFrame:
    """One row per key and wait: the version with the greatest ``version`` time, emitted by a processing-time timer."""
    return rows.groupBy(key).transformWithStateInPandas(
        LatestAfterDelay(rows.schema, version, wait_millis),
        outputStructType=rows.schema,
        outputMode="append",
        timeMode="processingTime",
    )
