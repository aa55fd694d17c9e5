"""Streams over several micro-batches against the table forms of the same rules.

A sentinel row far in the future moves the watermark past the last rows and is filtered out of the results.
"""

import os
import time
import uuid
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace import codes, schemas
from millrace.operators import joins, trade, visits, windows
from millrace.plans import feeds, programs
from millrace.session import shared_dir
from millrace.sinks.reports import start_stream
from millrace.streaming import visits as streams

FAR = timedelta(days=3)


def write_parts(frames, path):
    """Each frame as one file, in order of time."""
    for i, frame in enumerate(frames):
        part = f"{path}-part{i}"
        frame.coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.makedirs(path, exist_ok=True)
        target = f"{path}/{i}.parquet"
        with open(f"{part}/{name}", "rb") as src, open(target, "wb") as dst:
            dst.write(src.read())
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, df, tmp_path):
    out = str(tmp_path / uuid.uuid4().hex)
    query = start_stream(df, shared_dir(spark, "test"), path=out, interval=None)
    assert query.awaitTermination(300)
    assert query.exception() is None
    return spark.read.schema(df.schema).parquet(out)


def rows(df, *columns):
    return sorted(str(tuple(r)) for r in df.select(*(columns or sorted(df.columns))).collect())


@pytest.fixture(scope="module")
def log(spark, folder):
    return feeds.page_log(spark, folder).cache()


def parts_of(spark, df, n=3):
    data = df.toPandas().sort_values(["ts"], kind="stable")
    size = -(-len(data) // n)
    return [spark.createDataFrame(data.iloc[i : i + size], df.schema) for i in range(0, len(data), size)]


def sentinel_after(df, **values):
    row = df.limit(1)
    last = df.agg(F.max("ts").alias("m")).first().m + FAR
    for name, value in {"ts": last, **values}.items():
        row = row.withColumn(name, F.lit(value).cast(df.schema[name].dataType))
    return row.select(*df.columns)


def search_after(log):
    """A search without words: filters are applied before the watermark, so the keyword report needs its own sentinel."""
    return sentinel_after(log, mid="sentinel", last_page_id="search", item_type="keyword", item="!")


@pytest.fixture(scope="module")
def log_path(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "pages")
    end = sentinel_after(log, log_id=-1, mid="sentinel", uid="sentinel")
    write_parts([*parts_of(spark, log), end.unionByName(search_after(log))], path)
    return path


@pytest.fixture()
def pages(spark, log, log_path):
    return streams.with_watermark(stream_of(spark, log_path, log.schema))


def known(df):
    return df.where("mid <> 'sentinel'")


def test_repair(spark, log, log_path, tmp_path):
    got = run(spark, known(streams.repair_new_flag(stream_of(spark, log_path, log.schema))), tmp_path)
    assert rows(got, "log_id", "is_new") == rows(visits.repair_new_flag(log), "log_id", "is_new")


def test_unique_visitors(spark, log, log_path, tmp_path):
    got = run(spark, known(programs.unique_visitor_detail(stream_of(spark, log_path, log.schema))), tmp_path)
    assert rows(got, "log_id", "mid", "is_new") == rows(programs.unique_visitor_detail(log), "log_id", "mid", "is_new")


def test_rules_without_event_time_keep_late_rows(spark, log, tmp_path):
    """A micro-batch of older rows is judged against the state the newer ones left."""
    path = str(tmp_path / "late")
    first, second, third = parts_of(spark, log)
    write_parts([first, third, second], path)
    days, anchors, unique, flags = {}, {}, set(), {}
    for part in (first, third, second):
        for r in sorted(part.collect(), key=lambda r: (r.ts, r.log_id)):
            day = r.ts.date()
            anchors.setdefault(r.mid, day if r.is_new == "1" else day - timedelta(days=1))
            flags[r.log_id] = "0" if r.is_new == "1" and anchors[r.mid] != day else r.is_new
            if not r.last_page_id and days.get(r.mid) != day:
                days[r.mid] = day
                unique.add(r.log_id)
    got = run(spark, programs.unique_visitor_detail(stream_of(spark, path, log.schema)), tmp_path)
    assert {r.log_id for r in got.collect()} == unique
    got = run(spark, streams.repair_new_flag(stream_of(spark, path, log.schema)), tmp_path)
    assert {r.log_id: r.is_new for r in got.collect()} == flags


def wait_for_rows(spark, df, tmp_path, n):
    """Run a processing-time stream until ``n`` rows are out; it would never end by itself."""
    out = str(tmp_path / uuid.uuid4().hex)
    query = start_stream(df, shared_dir(spark, "test"), path=out, interval="1 second")
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            time.sleep(1)
            got = spark.read.schema(df.schema).parquet(out) if os.path.isdir(out) else None
            if got is not None and got.count() >= n:
                break
    finally:
        query.stop()
    return got


def test_unique_visitors_with_expiring_state(spark, log, log_path, tmp_path):
    expected = visits.unique_visitors(log)
    rules = programs.unique_visitor_detail(stream_of(spark, log_path, log.schema), streams.DAY_MILLIS)
    got = wait_for_rows(spark, known(rules), tmp_path, expected.count())
    assert rows(got, "log_id") == rows(expected, "log_id")


@pytest.mark.parametrize("timeout", [10_000, 6 * 3_600_000])
def test_bounces(spark, log, pages, tmp_path, timeout):
    got = run(spark, known(streams.bounces(pages, timeout)), tmp_path)
    assert rows(got, *log.columns) == rows(visits.bounces(log, f"{timeout} milliseconds"), *log.columns)


@pytest.mark.parametrize("report", [programs.keyword_window, programs.home_detail_window, programs.login_window])
def test_reports(spark, log, log_path, tmp_path, report):
    got = run(spark, report(stream_of(spark, log_path, log.schema)), tmp_path)
    assert rows(got) == rows(report(log))


def test_traffic_report_of_three_topics(spark, log, log_path, tmp_path):
    def published(detail, name):
        path = str(tmp_path / name)
        write_parts([*parts_of(spark, detail(log)), sentinel_after(log, mid="sentinel")], path)
        return stream_of(spark, path, log.schema)

    got = run(
        spark,
        programs.traffic_window(
            stream_of(spark, log_path, log.schema),
            published(programs.unique_visitor_detail, "uv"),
            published(programs.user_jump_detail, "uj"),
        ),
        tmp_path,
    )
    expected = windows.traffic_window(
        windows.union_measures(log, visits.unique_visitors(log), visits.bounces(log))
    )
    assert rows(got) == rows(expected)


def test_late_rows_are_dropped(spark, log, tmp_path):
    path = str(tmp_path / "late")
    first, second, third = parts_of(spark, log)
    # rows are judged late by the watermark of the micro-batch before, hence one in between
    write_parts([first, third, search_after(third), second, search_after(log)], path)
    got = run(spark, programs.keyword_window(stream_of(spark, path, log.schema)), tmp_path)
    expected = windows.keyword_window(first.unionByName(third))
    assert rows(got) == rows(expected)


def test_click_log_topics(spark, folder, tmp_path):
    text = feeds.click_log_text(spark, folder).cache()
    half = text.count() // 2
    path = str(tmp_path / "text")
    write_parts([text.where(F.col("log_id") < half), text.where(F.col("log_id") >= half)], path)
    got = run(spark, programs.click_log_topics(stream_of(spark, path, text.schema)), tmp_path)
    assert rows(got, "topic", "value") == rows(programs.click_log_topics(text), "topic", "value")


# --- trade ------------------------------------------------------------------------------------------------------


def change(table, kind, seconds, data, old=None):
    return ("shop", table, kind, str(seconds), {k: str(v) for k, v in data.items()}, old)


def line(id, order, seconds, source="2401"):
    return change(
        "order_detail", "insert", seconds,
        {"id": id, "order_id": order, "sku_id": 1, "create_time": "2024-01-01 00:00:00", "source_type": source,
         "sku_num": 2, "order_price": "3.50", "split_total_amount": "7.00"},
    )


def order(id, kind, seconds, status, old=None):
    return change(
        "order_info", kind, seconds,
        {"id": id, "user_id": 5, "province_id": 6, "operate_time": "2024-01-02 00:00:00", "order_status": status},
        old,
    )


CHANGES = [
    [line("d1", "o1", 1000), line("d2", "o1", 1000), order("o1", "insert", 1001, "1001"), line("d3", "o2", 1002, "2405")],
    [
        change("order_detail_activity", "insert", 1100, {"order_detail_id": "d1", "activity_id": "a1", "activity_rule_id": "r1"}),
        order("o2", "insert", 1003, "1001"),
        change("payment_info", "update", 1500, {"order_id": "o1", "payment_type": "1101", "callback_time": "x"}),
    ],
    [
        change("order_detail_coupon", "insert", 1200, {"order_detail_id": "d2", "coupon_id": "c1"}),
        order("o1", "update", 1300, "1003", {"order_status": "1001"}),
    ],
]
END = [
    [line("sentinel", "sentinel", 90_000), order("sentinel", "insert", 90_000, "1001"),
     change("order_detail_activity", "insert", 90_000, {"order_detail_id": "none"}),
     change("order_detail_coupon", "insert", 90_000, {"order_detail_id": "none"}),
     change("payment_info", "insert", 90_000, {"order_id": "none", "payment_type": "1101"})],
]


def change_frames(spark, groups):
    return [spark.createDataFrame(group, schemas.CHANGE_LOG) for group in groups]


def test_order_facts(spark, tmp_path):
    dictionary = codes.code_dictionary(spark)
    path = str(tmp_path / "changes")
    write_parts(change_frames(spark, CHANGES + END), path)
    log = stream_of(spark, path, schemas.CHANGE_LOG)
    wide = run(spark, programs.order_pre_process(log, dictionary).where("id <> 'sentinel'"), tmp_path)
    table = spark.createDataFrame([c for group in CHANGES for c in group], schemas.CHANGE_LOG)
    expected = programs.order_pre_process(table, dictionary)
    columns = [c for c in schemas.ORDER_PRE_PROCESS if c != "row_op_ts"]
    assert rows(wide, *columns) == rows(expected, *columns)
    assert wide.count() == 4
    assert {(r.id, r.activity_id, r.coupon_id) for r in programs.order_detail(wide).collect()} == {
        ("d1", "a1", None),
        ("d2", None, "c1"),
    }
    assert {r.id for r in programs.cancel_detail(wide).collect()} == {"d1", "d2"}


def test_payments(spark, tmp_path):
    dictionary = codes.code_dictionary(spark)
    table = spark.createDataFrame([c for group in CHANGES for c in group], schemas.CHANGE_LOG)
    orders = programs.order_detail(programs.order_pre_process(table, dictionary)).cache()
    path, orders_path = str(tmp_path / "changes"), str(tmp_path / "orders")
    write_parts(change_frames(spark, CHANGES + END), path)
    write_parts([orders], orders_path)
    got = run(
        spark,
        programs.pay_detail(
            stream_of(spark, path, schemas.CHANGE_LOG), stream_of(spark, orders_path, orders.schema), dictionary
        ),
        tmp_path,
    )
    columns = [c for c in schemas.PAY_DETAIL if c != "row_op_ts"]
    assert rows(got, *columns) == rows(programs.pay_detail(table, orders, dictionary), *columns)
    assert got.count() == 2


def refund_changes():
    request = {"id": "r1", "user_id": 5, "order_id": "o1", "sku_id": 1, "refund_type": "1501", "refund_reason_type": "1301",
               "refund_num": 1, "refund_amount": "3.50", "create_time": "2024-01-01 00:00:00"}
    return [
        [change("order_refund_info", "insert", 1000, request), order("o1", "update", 1003, "1005", {"order_status": "1002"}),
         change("order_refund_info", "insert", 1000, {**request, "id": "r2", "refund_type": "1599"})],
        [change("refund_payment", "insert", 1100, {"id": "p1", "order_id": "o1", "sku_id": 1, "payment_type": "1101",
                "total_amount": "3.50", "callback_time": "2024-01-01 01:00:00", "refund_status": "0701"}),
         order("o1", "update", 1101, "1006", {"order_status": "1005"})],
        [change("order_refund_info", "update", 1102, {**request, "refund_status": "0705"}, {"refund_status": "0702"})],
    ]


@pytest.mark.parametrize("job", [programs.order_refund, programs.refund_pay])
def test_refunds(spark, tmp_path, job):
    dictionary = codes.code_dictionary(spark)
    path = str(tmp_path / "changes")
    write_parts(change_frames(spark, refund_changes()), path)
    got = run(spark, job(stream_of(spark, path, schemas.CHANGE_LOG), dictionary), tmp_path)
    table = spark.createDataFrame([c for group in refund_changes() for c in group], schemas.CHANGE_LOG)
    columns = [c for c in got.columns if c != "row_op_ts"]
    assert rows(got, *columns) == rows(job(table, dictionary), *columns)
    assert got.count() == 1


def test_cart_report(spark, folder, tmp_path):
    facts = programs.cart_add(feeds.cart_changes(spark, folder), codes.code_dictionary(spark)).cache()
    path = str(tmp_path / "cart")
    ordered = facts.withColumn("n", F.col("ts").cast("long")).toPandas().sort_values("n").drop(columns="n")
    half = len(ordered) // 2
    end = ordered.tail(1).assign(ts="1800000000", user_id="sentinel")
    write_parts([spark.createDataFrame(p, facts.schema) for p in (ordered[:half], ordered[half:], end)], path)
    got = run(spark, programs.cart_add_window(stream_of(spark, path, facts.schema)), tmp_path)
    assert rows(got) == rows(programs.cart_add_window(facts))


def test_sku_report(spark, tmp_path):
    schema = schemas.ORDER_DETAIL_RECORD
    base = {f: None for f in schema.fieldNames()}

    def detail(id, order_id, user, sku, ts):
        return {**base, "id": id, "order_id": order_id, "user_id": user, "sku_id": sku, "ts": str(ts),
                "split_original_amount": "2.5000", "split_total_amount": "2.5"}

    groups = [
        [detail("1", "o1", "u1", "s1", 1000), detail("2", "o1", "u1", "s1", 1000), detail("3", "o2", "u2", "s2", 1005)],
        [detail("4", "o3", "u1", "s1", 1007), detail("5", "o4", "u3", "s1", 90_000)],
    ]
    end = [detail("9", "o9", "u9", "s9", 900_000)]
    path = str(tmp_path / "orders")
    write_parts([spark.createDataFrame(g, schema) for g in [*groups, end]], path)
    sku = spark.createDataFrame([("s1", "pen", "p", "t", "c")], "id string, sku_name string, spu_id string, tm_id string, category3_id string")
    got = run(spark, programs.sku_order_window(stream_of(spark, path, schema), sku), tmp_path)
    table = spark.createDataFrame([r for g in groups for r in g], schema)
    assert rows(got) == rows(programs.sku_order_window(table, sku))
    assert got.where("sku_id = 's1' AND order_count = 2 AND order_uu_count = 1").count() == 1


def test_newest_version_after_the_wait(spark, tmp_path):
    schema = "id string, v int, row_op_ts timestamp"
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 3, None)], "id string, v int, row_op_ts string")
    frame = frame.withColumn("row_op_ts", F.timestamp_seconds(F.lit(100) - F.col("v")))
    path = str(tmp_path / "in")
    write_parts([frame], path)
    df = streams.latest_versions(spark.readStream.schema(schema).parquet(path), "id", "row_op_ts", 1000)
    assert rows(wait_for_rows(spark, df, tmp_path, 2), "id", "v") == ["('a', 1)", "('b', 3)"]


def test_interval_join_on_streams(spark, folder, tmp_path):
    events = feeds.events(spark, folder).select("event_id", "user_id", "event_type", "ts")
    path = str(tmp_path / "events")
    end = [sentinel_after(events, event_id=-1, user_id=-1, event_type=t) for t in ("click", "purchase")]
    write_parts([*parts_of(spark, events), end[0].unionByName(end[1])], path)

    def pairs(df, how):
        if df.isStreaming:
            df = streams.with_watermark(df)
        clicks = df.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("cu"), F.col("ts").alias("c_ts"))
        bought = df.where("event_type = 'purchase'").select(F.col("event_id").alias("buy_id"), F.col("user_id").alias("bu"), F.col("ts").alias("b_ts"))
        joined = joins.interval_join(clicks, bought, [("cu", "bu")], "c_ts", "b_ts", 3_600_000, how)
        return joined.where("coalesce(click_id, buy_id) >= 0").select("click_id", "buy_id")

    for how in ("inner", "left", "right", "full"):
        got = run(spark, pairs(stream_of(spark, path, events.schema), how), tmp_path)
        assert rows(got) == rows(pairs(events, how)), how
