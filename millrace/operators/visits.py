"""Rules that look at one device's or user's visits in time order.

Most of them need no ordering of all rows. With rows taken in ``(ts, log_id)`` order the calendar date never falls,
so "the date differs from the last one kept" picks the first row of each key and date: an aggregate that is reduced
where the rows are read, whatever share of them one key holds. Only the bounce rule looks at the very next row; it
runs in windows, and keys too large for one task are cut into time chunks there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.scalars import is_blank
from millrace.operators.changelog import first_by_key
from millrace.sources.click_log import clean_records, parse_log

ORDER = ("ts", "log_id")

# A key is cut up when it has at least this many rows and at least 1/HOT_SHARE of all rows. The second test keeps
# the list of such keys at HOT_SHARE entries or fewer, which is what makes it safe to broadcast.
HOT_ROWS = 1_000_000
HOT_SHARE = 65_536
CHUNK_SECONDS = 10


def is_entry() -> Column:
    """True on a page nobody came to from another page: the start of a visit."""
    return is_blank("last_page_id")


def _day() -> Column:
    return F.to_date("ts")


def _anchor_of_row() -> Column:
    """First-visit date a device's first row stands for: its own day if marked new, else the day before."""
    return F.when(F.col("is_new") == "1", _day()).otherwise(F.date_sub(_day(), 1))


def _repaired(anchor: Column) -> Column:
    return F.when((F.col("is_new") == "1") & (anchor != _day()), F.lit("0")).otherwise(F.col("is_new"))


def first_visit_dates(log: DataFrame) -> DataFrame:
    """``mid, anchor``: the date each device counts as first seen."""
    visit = log.select("mid", F.struct(*ORDER).alias("_at"), _anchor_of_row().alias("_anchor"))
    return visit.groupBy("mid").agg(F.min_by("_anchor", "_at").alias("_anchor"))


def repair_new_flag(log: DataFrame) -> DataFrame:
    """Correct ``is_new``: a row marked new after the device's first-visit date becomes '0'.

    One aggregate row per device is joined back; a hot device is one row there and its log rows are split at run time.
    """
    return repaired_with(log, first_visit_dates(log))


def repair_new_flag_records(records: DataFrame) -> DataFrame:
    """``repair_new_flag`` on nested click-log records (``common.mid``, ``common.is_new``, ``ts`` in milliseconds)."""
    flat = records.select(
        F.col("common.mid").alias("mid"),
        F.col("common.is_new").alias("is_new"),
        F.timestamp_millis("ts").alias("ts"),
        "log_id",
    )
    rows = records.withColumn("_mid", F.col("common.mid")).join(
        first_visit_dates(flat).withColumnRenamed("mid", "_mid"), "_mid", "left"
    )
    return rows.withColumn("common", _repaired_common()).select(*records.columns)


def _repaired_common() -> Column:
    wrong = (F.col("common.is_new") == "1") & (F.col("_anchor") != F.to_date(F.timestamp_millis("ts")))
    # only this field depends on the join, so it is planned away where the flag is not used
    return F.col("common").withField("is_new", F.when(wrong, F.lit("0")).otherwise(F.col("common.is_new")))


def repaired_records_of_lines(lines: DataFrame) -> DataFrame:
    """The readable lines (``log_id, value``) as records with ``is_new`` repaired.

    First-visit dates come from a first pass; the join then moves the lines as they are, and they are parsed behind it, so no nested record
    is shuffled.
    """
    records = clean_records(parse_log(lines))
    flat = records.select("common.mid", "common.is_new", F.timestamp_millis("ts").alias("ts"), "log_id")
    dated = lines.withColumn("_mid", F.get_json_object("value", "$.common.mid")).join(
        first_visit_dates(flat).withColumnRenamed("mid", "_mid"), "_mid", "left"
    )
    return clean_records(parse_log(dated)).withColumn("common", _repaired_common()).select(*records.columns)


def repaired_with(log: DataFrame, anchors: DataFrame) -> DataFrame:
    """``repair_new_flag`` with first-visit dates that are known already."""
    rows = log.join(anchors, "mid", "left")
    return rows.withColumn("is_new", _repaired(F.col("_anchor"))).select(*log.columns)


def first_entries(log: DataFrame) -> DataFrame:
    """``mid, day, row``: the first visit start of each device and date, packed."""
    entries = log.where(is_entry())
    first = F.min_by(F.struct(*log.columns), F.struct(*ORDER)).alias("row")
    return entries.groupBy("mid", _day().alias("day")).agg(first)


def unique_visitors(log: DataFrame) -> DataFrame:
    """The first visit start of each device and date, as whole rows."""
    return first_by_key(log.where(is_entry()), ["mid", _day()], ORDER)


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys holding at least ``min_rows`` rows and 1/HOT_SHARE of all rows: at most HOT_SHARE of them."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = df.agg(F.count(F.lit(1)) / HOT_SHARE).scalar()
    return sizes.where((F.col("_n") >= min_rows) & (F.col("_n") >= share)).select(key)


def flag_visits(log: DataFrame, timeout: str = "10 seconds", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Repair ``is_new`` and add ``is_unique_visit`` and ``is_bounce``, reading and shuffling the log once.

    The rows of a device go to one task, except for hot devices, whose rows are keyed by device and time chunk. What
    a chunk must know of the others travels as two extra rows per chunk: one before its rows (first-visit date and
    date of the last visit start so far) and one after (the row that follows). They come from an aggregate per chunk.

    Bounce: a visit start whose next row is another visit start, or comes ``timeout`` or more later, or never.
    """
    hot = hot_keys(log, "mid", hot_rows).select(F.col("mid").alias("_hot_mid"), F.lit(True).alias("_hot"))
    is_hot = F.col("mid").eqNullSafe(F.col("_hot_mid"))
    chunk = F.when(F.col("_hot"), F.floor(F.unix_seconds("ts") / CHUNK_SECONDS))

    def marked(how: str) -> DataFrame:
        return (
            log.join(F.broadcast(hot), is_hot, how)
            .withColumn("_chunk", chunk)
            .drop("_hot_mid", "_hot")
            .withColumn("_entry", is_entry())
            .withColumn("_anchor", _anchor_of_row())
            .withColumn("_entry_day", F.when(is_entry(), _day()))
        )

    # an inner join: without hot devices this branch is found empty at run time and its scan is skipped
    heads = (
        marked("inner")
        .groupBy("mid", "_chunk")
        .agg(
            F.min(F.struct(*ORDER, "_entry", "_anchor")).alias("_head"),
            F.max("_entry_day").alias("_entry_day"),
        )
    )
    chunks = W.partitionBy("mid").orderBy("_chunk")
    carried = heads.select(
        "mid",
        "_chunk",
        F.first("_head._anchor").over(chunks).alias("_anchor"),
        F.max("_entry_day").over(chunks.rowsBetween(W.unboundedPreceding, -1)).alias("_entry_day"),
        F.lead("_head").over(chunks).alias("_next"),
    )
    edges = carried.select(
        "mid",
        "_chunk",
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias("_place"),
                    F.lit(None).cast("timestamp").alias("ts"),
                    F.lit(None).cast("boolean").alias("_entry"),
                    "_anchor",
                    "_entry_day",
                ),
                F.struct(
                    F.lit(2).alias("_place"),
                    F.col("_next.ts").alias("ts"),
                    F.col("_next._entry").alias("_entry"),
                    F.lit(None).cast("date").alias("_anchor"),
                    F.lit(None).cast("date").alias("_entry_day"),
                ),
            )
        ),
    )

    visits = W.partitionBy("mid", "_chunk").orderBy("_place", *ORDER)
    before = visits.rowsBetween(W.unboundedPreceding, -1)
    upto = visits.rowsBetween(W.unboundedPreceding, 0)
    seen = (
        marked("left")
        .withColumn("_place", F.lit(1))
        .unionByName(edges, allowMissingColumns=True)
        .withColumn("_first_anchor", F.first("_anchor").over(upto))
        .withColumn("_last_entry_day", F.max("_entry_day").over(before))
        .withColumn("_next_ts", F.lead("ts").over(visits))
        .withColumn("_next_entry", F.lead("_entry").over(visits))
        .where("_place = 1")
    )
    new_day = F.col("_last_entry_day").isNull() | (F.col("_last_entry_day") != _day())
    alone = (
        F.col("_next_ts").isNull()
        | F.col("_next_entry")
        | (F.col("_next_ts") >= F.col("ts") + F.expr(f"INTERVAL {timeout}"))
    )
    return seen.select(
        *[c for c in log.columns if c != "is_new"],
        _repaired(F.col("_first_anchor")).alias("is_new"),
        F.col("_entry").alias("is_visit_start"),
        (F.col("_entry") & new_day).alias("is_unique_visit"),
        (F.col("_entry") & alone).alias("is_bounce"),
    )


def bounces(log: DataFrame, timeout: str = "10 seconds", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Visit starts that nothing followed within ``timeout``, as whole rows."""
    flagged = flag_visits(log.withColumn("_is_new", F.col("is_new")), timeout, hot_rows).where("is_bounce")
    return flagged.select(*[F.col("_is_new").alias("is_new") if c == "is_new" else F.col(c) for c in log.columns])


def first_times(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys, day, ts``: the earliest time of each key and date."""
    return rows.groupBy(*keys, _day().alias("day")).agg(F.min("ts").alias("ts"))


def logins(log: DataFrame) -> DataFrame:
    """Rows that show a signed-in user at a visit start or right after the login page."""
    return log.where(~is_blank("uid") & (is_entry() | (F.col("last_page_id") == "login")))


def login_days(rows: DataFrame, key: str = "uid", back_after_days: int = 8) -> DataFrame:
    """One row per user and date at the user's first time, with ``uu_ct`` 1 and ``back_ct`` 1 for returning users.

    Returning: the date before lies ``back_after_days`` or more back. The window sees one row per user and date.
    """
    return marked_days(first_times(rows, key), key, back_after_days)


def marked_days(days: DataFrame, key: str = "uid", back_after_days: int = 8) -> DataFrame:
    """``login_days`` from one row per user and date (``key, day, ts``)."""
    previous = F.lag("day").over(W.partitionBy(key).orderBy("day"))
    gap = F.datediff("day", previous)
    return days.select(
        key,
        "day",
        "ts",
        F.lit(1).cast("bigint").alias("uu_ct"),
        F.when(gap >= back_after_days, 1).otherwise(0).cast("bigint").alias("back_ct"),
    )


def home_detail_visits(log: DataFrame) -> DataFrame:
    """First visit of the home page and of the product page per device and date."""
    pages = log.where(F.col("page_id").isin("home", "good_detail")).select("mid", "page_id", "ts")
    return home_detail_measures(first_times(pages, "mid", "page_id"))


def home_detail_measures(first: DataFrame) -> DataFrame:
    """First visits (``mid, page_id, ts``) as measure rows."""
    return first.select(
        "mid",
        "ts",
        (F.col("page_id") == "home").cast("bigint").alias("home_uv_ct"),
        (F.col("page_id") == "good_detail").cast("bigint").alias("good_detail_uv_ct"),
    )
