"""Tumbling-window reports. Each is one partial and one final aggregate around a single exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.codes import KEYWORD_SEARCH
from millrace.functions import times
from millrace.functions.keywords import WORD_PATTERN, explode_words
from millrace.operators import visits

SIZE = "10 seconds"


def window_report(df: DataFrame, keys: Sequence[str], measures: Sequence[Column], size: str = SIZE) -> DataFrame:
    """``measures`` per tumbling window of ``ts`` and ``keys``, with the window ends as text columns.

    On a stream ``ts`` must carry a watermark; rows behind it are dropped.
    """
    grouped = df.groupBy(F.window("ts", size), *keys).agg(*measures)
    values = [c for c in grouped.columns if c not in ("window", *keys)]
    return grouped.select(
        times.date_time_text("window.start").alias("stt"),
        times.date_time_text("window.end").alias("edt"),
        *keys,
        *values,
    )


def stamped(report: DataFrame) -> DataFrame:
    """Add the wall-clock column ``ts`` the stored reports carry."""
    return report.withColumn("ts", times.now_millis())


def _total(column: str) -> Column:
    return F.sum(column).cast("bigint").alias(column)


# --- traffic ------------------------------------------------------------------------------------------------

TRAFFIC_KEYS = ("vc", "ch", "ar", "is_new")
TRAFFIC_MEASURES = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")


def _traffic_rows(df: DataFrame, **measures: Column) -> DataFrame:
    zero = F.lit(0)
    return df.select(
        "ts", *TRAFFIC_KEYS, *[measures.get(m, zero).cast("bigint").alias(m) for m in TRAFFIC_MEASURES]
    )


def page_measures(pages: DataFrame) -> DataFrame:
    return _traffic_rows(
        pages, pv_ct=F.lit(1), sv_ct=F.when(visits.is_entry(), 1).otherwise(0), dur_sum=F.col("during_time")
    )


def union_measures(pages: DataFrame, unique: DataFrame, bounced: DataFrame) -> DataFrame:
    """Page, unique-visitor and bounce rows as one set of measure rows."""
    return (
        page_measures(pages)
        .unionByName(_traffic_rows(unique, uv_ct=F.lit(1)))
        .unionByName(_traffic_rows(bounced, uj_ct=F.lit(1)))
    )


def flagged_measures(flagged: DataFrame) -> DataFrame:
    """The rows of ``union_measures`` from ``visits.flag_visits``: up to three rows for each page, without reading it three times."""
    columns = ("ts", *TRAFFIC_KEYS)
    zero = F.lit(0).cast("bigint")

    def row(**measures: Column) -> Column:
        return F.struct(*columns, *[measures.get(m, zero).cast("bigint").alias(m) for m in TRAFFIC_MEASURES])

    page = row(pv_ct=F.lit(1), sv_ct=F.col("is_visit_start").cast("int"), dur_sum=F.col("during_time"))
    rows = F.array(
        page,
        F.when(F.col("is_unique_visit"), row(uv_ct=F.lit(1))),
        F.when(F.col("is_bounce"), row(uj_ct=F.lit(1))),
    )
    return flagged.select(F.inline(F.array_compact(rows)))


def traffic_window(measures: DataFrame, size: str = SIZE) -> DataFrame:
    """Views, visits, view time, unique visitors and bounces per window, version, channel, area and visitor kind."""
    return window_report(measures, TRAFFIC_KEYS, [_total(m) for m in TRAFFIC_MEASURES], size)


def traffic_window_of_log(log: DataFrame, timeout: str = "10 seconds", size: str = SIZE) -> DataFrame:
    """The same report straight from the page log.

    The flags of a row replace the three inputs: the log is shuffled once by device and once, reduced, by window.
    """
    flagged = visits.flag_visits(log, timeout)
    rows = _traffic_rows(
        flagged,
        pv_ct=F.lit(1),
        sv_ct=F.col("is_visit_start").cast("int"),
        dur_sum=F.col("during_time"),
        uv_ct=F.col("is_unique_visit").cast("int"),
        uj_ct=F.col("is_bounce").cast("int"),
    )
    return traffic_window(rows, size)


def home_detail_window(first_visits: DataFrame, size: str = SIZE) -> DataFrame:
    return window_report(first_visits, [], [_total("home_uv_ct"), _total("good_detail_uv_ct")], size)


# --- users and keywords -------------------------------------------------------------------------------------


def login_window(days: DataFrame, size: str = SIZE) -> DataFrame:
    return window_report(days, [], [_total("back_ct"), _total("uu_ct")], size)


def cart_add_window(first_adds: DataFrame, size: str = SIZE) -> DataFrame:
    return window_report(first_adds, [], [F.count(F.lit(1)).alias("cart_add_uu_ct")], size)


def searches(log: DataFrame) -> DataFrame:
    """Pages reached by a keyword search."""
    return log.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & F.col("item").isNotNull())


def keyword_window(log: DataFrame, size: str = SIZE, pattern: str = WORD_PATTERN) -> DataFrame:
    """How often each word was searched for, per window."""
    words = explode_words(searches(log).select("ts", F.col("item").alias("full_word")), "full_word", pattern=pattern)
    counts = window_report(words, ["keyword"], [F.count(F.lit(1)).alias("keyword_count")], size)
    return counts.select("stt", "edt", F.lit(KEYWORD_SEARCH).alias("source"), "keyword", "keyword_count")


def keyword_count(texts: DataFrame, text: str, pattern: str = WORD_PATTERN) -> DataFrame:
    """How often each word occurs in a text column."""
    words = explode_words(texts.select(text), text, pattern=pattern)
    return words.groupBy("keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
