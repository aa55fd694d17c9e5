"""Registered queries that run as streams over a given table, work off what is there, and return the result table.

A replay has no arrival order worth following: its micro-batches are cut by size. Each of these streams ends in the rows of the table form, however it is
cut: reports and minima are kept without a watermark that drops rows, every micro-batch adds the versions that changed to a
keyed table, and the last version of each key is read. Rules that need the very next row (bounces) get the
devices' rows from a stored log. The ``keyed_`` queries follow arrival instead: rows come in order of time, and the processors of ``streaming`` hold what
a key must remember.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators import joins, trade, visits, windows
from millrace.plans import feeds
from millrace.plans.catalog import AMOUNTS, QUERIES, _rounded, _sku, _wide
from millrace.session import shared_dir
from millrace.sinks import changelog, delivery, keyed
from millrace.sinks.reports import start_stream
from millrace.streaming import joins as stream_joins
from millrace.streaming import visits as streams

# How much input one micro-batch takes at most. A rate limit: no row of a result depends on it.
BATCH_BYTES = 16 * 1024**3


def _stream(spark, folder: str, name: str) -> DataFrame:
    schema = feeds.table(spark, folder, name).schema
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES)
    # a pattern, as a stream takes a plain path for a folder; the table may be one file or a folder of many
    return stream.parquet(f"{folder}/{name[:-1]}[{name[-1]}].parquet")


def _pages(spark, folder: str) -> DataFrame:
    """The page log as a stream of the events table."""
    return feeds.page_log_of(_stream(spark, folder, "events"))


def _stored(spark, df: DataFrame) -> DataFrame:
    """The rows of the stream, each written once."""
    out = shared_dir(spark, "stream-out")
    start_stream(df, shared_dir(spark, "stream-state"), path=out, interval=None).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def _last_versions(spark, df: DataFrame, keys: list[str]) -> DataFrame:
    """The changing rows of the stream as they are when all is worked off."""
    out = shared_dir(spark, "stream-out")
    query = (
        df.writeStream.outputMode("update")
        .option("checkpointLocation", shared_dir(spark, "stream-state"))
        .trigger(availableNow=True)
        .foreachBatch(changelog.append_changes(out))
        .start()
    )
    query.awaitTermination()
    return changelog.read_latest(spark, out, df.schema, keys)


def stream_page_window(spark, folder):
    report = windows.traffic_window(windows.page_measures(_pages(spark, folder)))
    return _last_versions(spark, report, ["stt", *windows.TRAFFIC_KEYS]).drop("uv_ct", "uj_ct")


def stream_keyword_window(spark, folder):
    return _last_versions(spark, windows.keyword_window(_pages(spark, folder)), ["stt", "keyword"])


def stream_new_visitor_repair(spark, folder):
    """First-visit dates from the stream, applied to the stored log."""
    anchors = _last_versions(spark, streams.anchors(_pages(spark, folder)), ["mid"])
    log = _stored(spark, _pages(spark, folder).select("log_id", "mid", "is_new", "ts"))
    return visits.repaired_with(log, anchors).select("log_id", "mid", "is_new")


def stream_unique_visitor(spark, folder):
    first = _last_versions(spark, streams.first_visits(_pages(spark, folder)), ["mid", "day"]).select("row.*")
    return first.select("log_id", "mid", "page_id", F.unix_millis("ts").alias("ts_ms"))


def stream_user_jump(spark, folder):
    """The log comes in as a stream; the rule looks at neighbours in time, wherever they arrived."""
    log = _stored(spark, _pages(spark, folder))
    return visits.bounces(log).select("log_id", "mid", "page_id", F.unix_millis("ts").alias("ts_ms"))


def stream_home_detail(spark, folder):
    """First visits from the stream, counted per window."""
    pages = _pages(spark, folder).where(F.col("page_id").isin("home", "good_detail"))
    first = _last_versions(spark, visits.first_times(pages, "mid", "page_id"), ["mid", "page_id", "day"])
    return windows.home_detail_window(visits.home_detail_measures(first))


def stream_login_back(spark, folder):
    """Users' days from the stream; a gap to the day before needs all of them."""
    days = _last_versions(spark, visits.first_times(visits.logins(_pages(spark, folder)), "uid"), ["uid", "day"])
    return windows.login_window(visits.marked_days(days))


def stream_cart_add_window(spark, folder):
    """Change log to cart facts as a stream; each user's first addition of a date falls as earlier ones come."""
    changes = feeds.cart_changes_of(feeds.events_of(_stream(spark, folder, "events")))
    times = trade.cart_add_user_times(trade.cart_add(changes, feeds.dictionary(spark)))
    return windows.cart_add_window(_last_versions(spark, times, ["user_id", "day"]))


def stream_join_interval(spark, folder):
    """Both sides as streams; the bounds in time tell when a row's partners have all come."""
    rows = _pages(spark, folder)
    left = rows.where("page_id = 'home'").select(F.col("mid").alias("l_mid"), F.col("log_id").alias("l_id"), F.col("ts").alias("l_ts"))
    right = rows.where("page_id = 'good_detail'").select(F.col("mid").alias("r_mid"), F.col("log_id").alias("r_id"), F.col("ts").alias("r_ts"))
    pairs = joins.interval_join(left, right, [("l_mid", "r_mid")], "l_ts", "r_ts", 3_600_000)
    return _stored(spark, pairs.select("l_mid", "l_id", "r_id"))


# --- keyed state ------------------------------------------------------------------------------------------------

SLICES = 3
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _fed_in_time_order(spark, rows: DataFrame, end: DataFrame, build, slices: int = SLICES) -> DataFrame:
    """What ``build(stream)`` gives when the rows come in order of ``ts``, slice by slice, and ``end`` after them.

    A slice is one micro-batch, and after each the stream is stopped and started again from its checkpoint. Where slices are cut comes from the times alone.
    """
    source, out, state = (shared_dir(spark, f"keyed-{name}") for name in ("in", "out", "state"))
    at = F.unix_millis("ts")
    cuts = rows.agg(F.percentile_approx(at, [k / slices for k in range(1, slices)])).first()[0] or []
    bounds = [None, *cuts, None]
    with _without_empty_batches(spark):
        for low, high in zip(bounds, bounds[1:], strict=False):
            part = rows if low is None else rows.where(at >= low)
            part = part if high is None else part.where(at < high)
            _one_step(spark, part, source, out, state, build)
    result = _one_step(spark, end, source, out, state, build)
    return spark.read.schema(result.schema).parquet(out)


@contextmanager
def _without_empty_batches(spark):
    """Streams that are started in this block don't run a micro-batch without rows for what the watermark has passed: the next one with rows does its work too."""
    before = spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(EMPTY_BATCHES, "false")
    try:
        yield
    finally:
        spark.conf.set(EMPTY_BATCHES, before)


def _one_step(spark, part: DataFrame, source: str, out: str, state: str, build) -> DataFrame:
    part.write.mode("append").parquet(source)
    result = build(spark.readStream.schema(part.schema).parquet(source))
    start_stream(result, state, path=out, interval=None).awaitTermination()
    return result


def _after(rows: DataFrame, **values) -> DataFrame:
    """A row three days after all others, which moves the watermark beyond them; its other columns are null."""
    last = rows.agg((F.max("ts") + F.expr("INTERVAL '3' DAY")).alias("ts"))
    given = {name: F.lit(value) for name, value in values.items()} | {"ts": F.col("ts")}
    return last.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])


#: The device of the row after all others.
END = "after all"


def _page_rows(spark, folder: str, *more: str) -> DataFrame:
    return feeds.page_log(spark, folder).select("log_id", "mid", "is_new", "ts", "page_id", "last_page_id", *more)


def keyed_new_visitor_repair(spark, folder):
    rows = _page_rows(spark, folder)
    repaired = _fed_in_time_order(spark, rows, _after(rows, mid=END), streams.repair_new_flag)
    return repaired.where(F.col("mid") != END).select("log_id", "mid", "is_new")


def keyed_unique_visitor(spark, folder):
    rows = _page_rows(spark, folder)
    found = _fed_in_time_order(spark, rows, _after(rows, mid=END), streams.unique_visitors)
    return found.where(F.col("mid") != END).select("log_id", "mid", "page_id", F.unix_millis("ts").alias("ts_ms"))


def keyed_user_jump(spark, folder):
    rows = _page_rows(spark, folder)
    found = _fed_in_time_order(spark, rows, _after(rows, mid=END, last_page_id=END), lambda log: streams.bounces(streams.with_watermark(log)))
    return found.where(F.col("mid") != END).select("log_id", "mid", "page_id", F.unix_millis("ts").alias("ts_ms"))


def keyed_home_detail(spark, folder):
    rows = _page_rows(spark, folder)
    end = _after(rows, mid=END, page_id="home")

    def report(log: DataFrame) -> DataFrame:
        return windows.home_detail_window(streams.home_detail_visits(streams.with_watermark(log)))

    return _fed_in_time_order(spark, rows, end, report)


def keyed_login_back(spark, folder):
    rows = _page_rows(spark, folder, "uid")
    end = _after(rows, mid=END, uid=END, last_page_id="login")
    return _fed_in_time_order(spark, rows, end, lambda log: windows.login_window(streams.login_days(streams.with_watermark(log))))


def keyed_sku_order_window(spark, folder):
    """First lines of users by day and distinct orders by window, both from keyed state, before the window report."""
    ties = ("split_total_amount", "sku_id", "source_id", "sku_num")
    kept = shared_dir(spark, "keyed-lines")
    lines = trade.latest_measures(trade.order_detail(_wide(spark, folder)), *ties)
    lines.write.parquet(kept)
    lines = spark.read.schema(lines.schema).parquet(kept)

    def report(rows: DataFrame) -> DataFrame:
        return streams.sku_order_window(streams.flag_order_users(streams.with_watermark(rows)), buckets=1)  # a day's orders have one time here

    found = _fed_in_time_order(spark, lines, _after(lines, id=END, sku_id=END, order_id=END, user_id=END), report)
    return _rounded(trade.with_sku_names(found, _sku(spark, folder)), *AMOUNTS)


# --- joins ------------------------------------------------------------------------------------------------------


def stream_join_left(spark, folder):
    """Orders and customers as streams. Orders come out at once, and again with their customer; what holds at the end is read."""
    orders = _stream(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customers = _stream(spark, folder, "customer").select((F.col("c_custkey") * 2).alias("c_key"), "c_name")
    versions = stream_joins.left_join_versions(orders, customers, [("o_custkey", "c_key")])
    out = shared_dir(spark, "stream-out")
    start_stream(versions, shared_dir(spark, "stream-state"), changelog.append_changes(out), interval=None).awaitTermination()
    changes = changelog.read_changes(spark, out, versions.schema)
    return stream_joins.in_force(changes, ["o_orderkey", "c_key"], ["batch_id"]).drop("batch_id")


def stream_upsert(spark, folder):
    """Line versions as a stream into a table in buckets, read without an exchange."""
    names = ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]
    lines = _stream(spark, folder, "lineitem").select(names)
    kept = keyed.KeyedTable(spark, shared_dir(spark, "keyed-table"), lines.schema, names[:2], names[2:], buckets=16)
    start_stream(lines, shared_dir(spark, "stream-state"), kept.write, interval=None).awaitTermination()
    return kept.read().withColumn("l_shipdate", times.date_text("l_shipdate"))


def stream_delivery(spark, folder):
    """The page log in slices, delivered exactly once; the stream is stopped after each and started again."""
    rows = _page_rows(spark, folder)
    source, out, state = (shared_dir(spark, f"delivery-{name}") for name in ("in", "out", "state"))
    for k in range(SLICES):
        rows.where(F.pmod("log_id", F.lit(SLICES)) == k).write.mode("append").parquet(source)
        delivery.start_delivery(spark.readStream.schema(rows.schema).parquet(source), out, state).awaitTermination()
    delivered = delivery.read_delivered(spark, out, rows.schema)
    return delivered.select("log_id", "mid", "page_id", F.unix_millis("ts").alias("ts_ms"), F.col("batch_id").cast("int").alias("batch_id"))


QUERIES.update(
    {
        function.__name__: function
        for function in (
            stream_page_window, stream_keyword_window, stream_new_visitor_repair, stream_unique_visitor, stream_user_jump,
            stream_home_detail, stream_login_back, stream_cart_add_window, stream_join_interval, stream_join_left, stream_upsert, stream_delivery,
            keyed_new_visitor_repair, keyed_unique_visitor, keyed_user_jump, keyed_home_detail, keyed_login_back, keyed_sku_order_window,
        )
    }
)
