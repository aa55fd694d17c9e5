"""Small cases with results worked out by hand."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import codes, schemas
from millrace.functions import keywords, scalars, times
from millrace.operators import changelog, dims, log_split, trade, visits
from millrace.sources import click_log, kafka, tables


def change(table, kind, data, old=None, ts="100", database="shop"):
    return (database, table, kind, ts, data, old)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.CHANGE_LOG)


BOUNCE_LINES = [
    {"common": {"mid": "tablet"}, "page": {"page_id": "cart"}, "ts": 3_000},
    {"common": {"mid": "phone"}, "page": {"page_id": "cart"}, "ts": 4_500},
    {"common": {"mid": "phone"}, "page": {"page_id": "search", "last_page_id": "cart"}, "ts": 11_000},
    {"common": {"mid": "phone"}, "page": {"page_id": "mine", "last_page_id": "search"}, "ts": 52_000},
]


def test_bounce_of_a_device_nothing_follows(spark):
    text = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(BOUNCE_LINES)], "log_id long, value string")
    pages = click_log.page_columns(log_split.page_records(click_log.clean_records(click_log.parse_log(text))))
    for hot_rows in (visits.HOT_ROWS, 0):
        assert [r.mid for r in visits.bounces(pages, hot_rows=hot_rows).collect()] == ["tablet"]


def test_dirty_lines_are_kept_verbatim(spark):
    good = '{"common":{"mid":"1","is_new":"1"},"page":{"page_id":"home"},"ts":1}'
    bad = ['{"common":{"mid":"1"', "", "[1,2]", "plain", '{"page":{},"ts":1}', '{"common":{"mid":"1"}}', '{"ts":"x","common":{"mid":"1"}}']
    text = spark.createDataFrame([(i, v) for i, v in enumerate([good, *bad])], "log_id long, value string")
    parsed = click_log.parse_log(text)
    assert sorted(r.value for r in click_log.dirty_lines(parsed).collect()) == sorted(bad)
    assert click_log.clean_records(parsed).count() == 1


def test_log_split_rules(spark):
    both = {
        "common": {"mid": "1", "is_new": "1"},
        "page": {"page_id": "home"},
        "displays": [{"item": "a"}, {"item": "b"}],
        "actions": [{"action_id": "x", "ts": 5}],
        "err": {"error_code": 7},
        "ts": 1,
    }
    start = {"common": {"mid": "2", "is_new": "1"}, "start": {"entry": "icon"}, "err": {"error_code": 8}, "ts": 2}
    text = spark.createDataFrame([(0, json.dumps(both)), (1, json.dumps(start))], "log_id long, value string")
    records = click_log.clean_records(click_log.parse_log(text))
    rows = {}
    for row in log_split.topic_rows(records).collect():
        rows.setdefault(row.topic, []).append(json.loads(row.value))
    topics = log_split.TOPICS
    assert len(rows[topics["err"]]) == 2 and all("err" in r for r in rows[topics["err"]])
    assert rows[topics["start"]] == [{"common": {"mid": "2", "is_new": "1"}, "start": {"entry": "icon"}, "ts": 2}]
    assert rows[topics["page"]] == [{"common": {"mid": "1", "is_new": "1"}, "page": {"page_id": "home"}, "ts": 1}]
    assert [r["display"]["item"] for r in rows[topics["display"]]] == ["a", "b"]
    assert all(set(r) == {"common", "page", "display", "ts"} for r in rows[topics["display"]])
    assert [set(r) for r in rows[topics["action"]]] == [{"common", "page", "action"}]


def test_cart_quantities(spark):
    line = {"id": "1", "user_id": "9", "sku_id": "8", "source_type": "2401"}
    log = changes(
        spark,
        change("cart_info", "insert", {**line, "sku_num": "5"}),
        change("cart_info", "update", {**line, "id": "2", "sku_num": "7"}, {"sku_num": "3"}),
        change("cart_info", "update", {**line, "id": "3", "sku_num": "2"}, {"sku_num": "3"}),
        change("cart_info", "update", {**line, "id": "4", "sku_num": "2"}, {"is_checked": "1"}),
        change("cart_info", "update", {**line, "id": "5", "sku_num": "x"}, {"sku_num": "1"}),
        change("cart_info", "insert", {**line, "id": "6", "sku_num": "1", "source_type": "9999"}),
        change("cart_info", "delete", {**line, "id": "7", "sku_num": "1"}),
    )
    rows = trade.cart_add(log, codes.code_dictionary(spark)).orderBy("id").collect()
    assert [(r.id, r.sku_num, r.source_type_name) for r in rows] == [("1", "5", "query"), ("2", "4", "query")]


def test_control_records(spark):
    log = changes(
        spark,
        change("t", "bootstrap-start", {}),
        change("t", "bootstrap-insert", {"id": "1"}),
        change("t", "bootstrap-complete", {}),
        change("t", None, {"id": "2"}),
        change("t", "update", None),
    )
    assert [r.data["id"] for r in changelog.drop_control_records(log).collect()] == ["1"]


def test_config_feed_and_routing(spark):
    def record(op, table, columns, ts):
        entry = {"source_table": table, "sink_table": f"dim_{table}", "sink_columns": columns, "sink_pk": None, "sink_extend": None}
        side = {"before": entry, "after": None} if op == "d" else {"before": None, "after": entry}
        return (json.dumps({**side, "op": op, "ts_ms": ts}),)

    feed = tables.config_changes(
        spark.createDataFrame(
            [
                record("r", "base_trademark", "id", 1),
                record("u", "base_trademark", "id,tm_name", 2),
                record("c", "base_region", "id", 3),
                record("d", "base_region", "id", 4),
            ],
            "value string",
        )
    )
    config = changelog.current_config(feed)
    assert [(r.source_table, r.sink_columns) for r in config.collect()] == [("base_trademark", "id,tm_name")]
    log = changes(
        spark,
        change("base_trademark", "insert", {"tm_name": "north", "logo_url": "n.png", "id": "11"}),
        change("base_region", "insert", {"id": "1"}),
        change("base_trademark", "delete", {"tm_name": "old", "id": "13"}),
    )
    routed = dims.route_dimensions(log, config).orderBy("data.id").collect()
    assert [(r.sink_table, r.sink_pk, r.data, r.op) for r in routed] == [
        ("dim_base_trademark", "id", {"tm_name": "north", "id": "11"}, "u"),
        ("dim_base_trademark", "id", {"tm_name": "old", "id": "13"}, "u"),
    ]
    assert dims.route_dimensions(log, config, apply_deletes=True).where("op = 'd'").count() == 1


def test_config_snapshot_comes_before_changes(spark):
    table = spark.createDataFrame([("a", "dim_a", "id", None, None)], schemas.CONFIG_ROW)
    later = tables.config_changes(
        spark.createDataFrame([(json.dumps({"before": {"source_table": "a"}, "op": "d", "ts_ms": 5}),)], "value string")
    )
    assert changelog.current_config(tables.config_snapshot(table)).count() == 1
    assert changelog.current_config(tables.config_snapshot(table).unionByName(later)).count() == 0


def test_time_rules(spark):
    row = (
        spark.range(1)
        .select(
            (times.operation_time(F.lit("2022-04-01 11:10:55.049Z")) > times.operation_time(F.lit("2022-04-01 11:10:55.04Z"))).alias("after"),
            times.text_to_millis(F.lit("2022-08-27")).alias("east8"),
            times.text_to_millis(F.lit("2022-08-27 08:00:00"), "Asia/Shanghai", full=True).alias("full"),
            times.text_to_millis(F.lit("nonsense")).alias("bad"),
            times.date_of_text(F.lit("2022-08-13 09:39:22")).alias("day"),
            times.date_of_text(F.lit("x")).alias("no_day"),
            times.from_second_text(F.lit("1661564362")).alias("second"),
            times.from_second_text(F.lit("x")).alias("no_second"),
            times.date_time_text(times.from_millis(F.lit(1661564362999))).alias("text"),
            times.from_millis_to_second(F.lit(1661564362999)).alias("cut"),
            scalars.money_product_text(F.lit("1"), F.lit("5499.00")).alias("money"),
        )
        .first()
    )
    assert row.after and row.bad is None and row.no_day is None and row.no_second is None
    assert row.east8 == 1661529600000 and row.full == 1661558400000
    assert row.day == "2022-08-13" and row.text == "2022-08-27 01:39:22"
    assert row.second == row.cut == datetime(2022, 8, 27, 1, 39, 22)
    assert row.money == "5499.0000"


def test_words(spark):
    text = "Zeta CamPro (ZX9) 64MB 银色外壳 双镜头5G相机 便携"
    df = spark.createDataFrame([(1, text)], "id long, full_word string")
    words = [r.keyword for r in keywords.explode_words(df, "full_word").collect()]
    assert words == ["zeta", "campro", "zx9", "64mb", "银色外壳", "双镜头", "5g", "相机", "便携"]
    keywords.register_tokenizer(spark, str.split)
    df.createOrReplaceTempView("texts")
    own = spark.sql("SELECT word FROM texts, LATERAL split_words(texts.full_word)").collect()
    assert [r.word for r in own] == text.split()


def test_sku_window_record(spark):
    schema = schemas.ORDER_DETAIL_RECORD
    base = {f: None for f in schema.fieldNames()}

    def line(id, order, user, total, version, ts="1661585141"):
        return {
            **base, "id": id, "order_id": order, "user_id": user, "sku_id": "1", "split_original_amount": "17997.0000",
            "split_total_amount": total, "ts": ts, "row_op_ts": datetime(2022, 8, 27, 1, 0, version),
        }

    orders = spark.createDataFrame(
        [line("1", "183", "47", "1.0", 1), line("1", "183", "47", "17997.0", 2), line("2", "183", "47", "3.0", 1, "1661585142")],
        schema,
    )
    sku = spark.createDataFrame([("1", "phone", "s1", "t1", "c1")], "id string, sku_name string, spu_id string, tm_id string, category3_id string")
    report = trade.with_sku_names(trade.sku_order_window(trade.flag_order_users(trade.latest_measures(orders))), sku)
    row = report.first()
    assert (row.stt, row.edt) == ("2022-08-27 07:25:40", "2022-08-27 07:25:50")
    assert (row.order_uu_count, row.order_count) == (1, 1)
    assert (row.original_amount, row.activity_amount, row.coupon_amount, row.order_amount) == (35994.0, 0.0, 0.0, 18000.0)
    assert (row.sku_name, row.trademark_id) == ("phone", "t1")


def test_topic_text_skips_tombstones(spark):
    raw = spark.createDataFrame([(b"a", 0, 1), (None, 0, 2)], "value binary, partition int, offset long")
    rows = kafka.topic_text(raw).collect()
    assert [(r.value, r.log_id) for r in rows] == [("a", "0000000000-00000000000000000001")]


def test_records_of_text(spark):
    text = spark.createDataFrame([("k", '{"id":"1","sku_num":"2"}')], "log_id string, value string")
    assert kafka.as_records(text, schemas.CART_ADD_RECORD).select("log_id", "id", "sku_num").first() == ("k", "1", "2")


def test_delimited_lines(spark, tmp_path):
    schema = "empno int, ename string, deptno int, ts long"
    (tmp_path / "emp.csv").write_text("1,smith,10,1000\n2,jones,20,2000\n")
    read = tables.read_lines(spark, str(tmp_path), spark.createDataFrame([], schema).schema)
    assert [(r.empno, r.ename, r.ts) for r in read.orderBy("empno").collect()] == [(1, "smith", 1000), (2, "jones", 2000)]
    text = spark.createDataFrame([("3,king,x,3000",), ("4,short",)], "value string")
    split = tables.split_lines(text, spark.createDataFrame([], schema).schema).orderBy("empno").collect()
    assert [tuple(r) for r in split] == [(3, "king", None, 3000), (4, "short", None, None)]


@pytest.mark.parametrize("name", ["order_uu_flag", "sku_order_window"])
def test_product_reports_do_not_move_activities_and_coupons(spark, folder, name):
    """One version of a line is kept and none of their columns is read, so lines are not shuffled to meet them."""
    from millrace.plans.catalog import QUERIES

    plan = QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "act_od_id" not in plan and "cou_od_id" not in plan


def test_latest_measures_do_not_depend_on_repeats(spark):
    """Lines repeated for activities, and versions of one line that differ in one place of the order."""
    columns = "id order_id user_id sku_id split_original_amount split_activity_amount split_coupon_amount split_total_amount ts row_op_ts source_id".split()
    line = lambda i, sku, op, source: (i, "o", "u", sku, "3", None, "1", "2", "1704067200", op, source)
    rows = [line("a", "1", "1", None), line("a", "2", "1", "x"), line("a", "2", "1", "x"), line("b", "9", None, None), line("b", "3", "0", None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    once, twice = (trade.latest_measures(d, "sku_id", "source_id").orderBy("id").collect() for d in (df, df.union(df)))
    assert once == twice and [(r.id, r.sku_id, r.order_amount) for r in once] == [("a", "2", 2), ("b", "3", 2)]
    assert list(once[0].asDict()) == "id order_id user_id sku_id original_amount activity_amount coupon_amount order_amount ts".split()
