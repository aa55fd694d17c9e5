"""Join kinds and bounds on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins, trade


@pytest.fixture(scope="module")
def sides(spark):
    emp = spark.createDataFrame([(1, "smith", 10), (2, "jones", 20), (3, "king", 99), (4, "nobody", None)], "empno int, ename string, deptno int")
    dept = spark.createDataFrame([(10, "sales"), (20, "research"), (30, "empty"), (None, "null")], "dno int, dname string")
    return emp, dept


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_regular_joins(sides, how):
    emp, dept = sides
    got = joins.regular_join(emp, dept, [("deptno", "dno")], how).select("ename", "dname").collect()
    both = {("smith", "sales"), ("jones", "research")}
    left = {("king", None), ("nobody", None)} if how in ("left", "full") else set()
    right = {(None, "empty"), (None, "null")} if how in ("right", "full") else set()
    assert len(got) == len(both | left | right) and set(map(tuple, got)) == both | left | right


def test_interval_bounds_are_inclusive(spark):
    left = spark.createDataFrame([(10, 1000)], "k int, ms long").select("k", F.timestamp_millis("ms").alias("l_ts"))
    right = spark.createDataFrame([(10, m) for m in (994, 995, 1000, 1005, 1006)] + [(11, 1000)], "rk int, r_ms long")
    right = right.withColumn("r_ts", F.timestamp_millis("r_ms"))
    got = joins.interval_join(left, right, [("k", "rk")], "l_ts", "r_ts", 5)
    assert sorted(r.r_ms for r in got.collect()) == [995, 1000, 1005]


@pytest.mark.parametrize("bound", [5, 700, 100_000])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_interval_join_against_all_pairs(spark, bound, how):
    rng = random.Random(bound)
    a = [(i, rng.randrange(2), rng.randrange(-3_000_000, 3_000_000)) for i in range(300)]
    b = [(i, rng.randrange(2), x[2] + rng.choice([-bound - 1, -bound, 0, bound, bound + 1])) for i, x in enumerate(a)]
    left = spark.createDataFrame(a, "a int, ak int, a_ms long").withColumn("a_ts", F.timestamp_millis("a_ms"))
    right = spark.createDataFrame(b, "b int, bk int, b_ms long").withColumn("b_ts", F.timestamp_millis("b_ms"))
    got = joins.interval_join(left, right, [("ak", "bk")], "a_ts", "b_ts", bound, how).select("a", "b").collect()
    expected = [(x[0], y[0]) for x in a for y in b if x[1] == y[1] and abs(x[2] - y[2]) <= bound]
    pairs = list(expected)
    if how in ("left", "full"):
        expected += [(x[0], None) for x in a if x[0] not in {p[0] for p in pairs}]
    if how in ("right", "full"):
        expected += [(None, y[0]) for y in b if y[0] not in {p[1] for p in pairs}]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_lookup_drops_unknown_codes(spark):
    dic = spark.createDataFrame([("2401", "query")], "dic_code string, dic_name string")
    rows = spark.createDataFrame([(1, "2401"), (2, "2405"), (3, None)], "id int, code string")
    assert [tuple(r) for r in joins.lookup_name(rows, dic, "code", "name").collect()] == [(1, "2401", "query")]


def test_enrich_keeps_rows_without_entry(spark):
    facts = spark.createDataFrame([("1",), ("2",), (None,)], "sku string")
    sku = spark.createDataFrame([("1", "c3")], "id string, cat string")
    cat = spark.createDataFrame([("c3", "shoes")], "id string, name string")
    out = joins.enrich(
        facts, joins.Link(sku, "sku", "id", {"category_id": "cat"}), joins.Link(cat, "category_id", "id", {"category": "name"})
    )
    assert sorted(map(str, out.collect())) == sorted(
        ["Row(sku='1', category_id='c3', category='shoes')", "Row(sku='2', category_id=None, category=None)", "Row(sku=None, category_id=None, category=None)"]
    )


def test_lookup_rows(spark):
    table = spark.createDataFrame([("1", "a", 5), ("1", "b", 7), ("1", "b", 6)], "id string, kind string, v int")
    wanted = spark.createDataFrame([("1", "b"), ("9", "a")], "id string, kind string")
    assert sorted(map(tuple, joins.lookup_rows(wanted, table, ["id", "kind"]).collect())) == [("1", "b", 6), ("9", "a", None)]


def test_unequal_bounds(spark):
    left = spark.createDataFrame([(1, 50_000)], "k int, l_ms long").withColumn("l_ts", F.timestamp_millis("l_ms"))
    times = [39_999, 40_000, 50_000, 52_000, 52_001]
    right = spark.createDataFrame([(1, t) for t in times], "rk int, r_ms long").withColumn("r_ts", F.timestamp_millis("r_ms"))
    got = joins.join_within(left, right, [("k", "rk")], "l_ts", "r_ts", 10_000, 2_000)
    assert sorted(r.r_ms for r in got.collect()) == [40_000, 50_000, 52_000]


def _changes(spark, table, rows):
    data = [("shop", table, "insert", str(1700000000 + n), row, None) for n, row in enumerate(rows)]
    return spark.createDataFrame(data, "database string, table string, type string, ts string, data map<string,string>, old map<string,string>")


def test_wide_lines_move_once(spark):
    """Copies of a line, ids in two orders, several activities of a line, no ids; and lines cross one exchange, not one by line id and one by order id."""
    line = lambda i, o, n: {"id": i, "order_id": o, "sku_num": n, "sku_name": "x", "source_type": "2401", "order_price": "1"}
    lines = [line("a", "1", "1"), line("a", "1", "1"), line("a", "2", "2"), line("b", "1", "3"), line(None, "2", "4"), line("c", None, "5"), line("d", "9", "6")]
    extras = [{"order_detail_id": i, "activity_id": a} for i, a in (("a", "p"), ("a", "q"), ("d", "r"), (None, "s"), ("z", "t"))]
    coupons = [{"order_detail_id": i, "coupon_id": c} for i, c in (("a", "u"), ("b", "v"), ("b", None))]
    changes = _changes(spark, "order_detail", lines).union(_changes(spark, "order_info", [{"id": "1"}, {"id": "2"}, {"id": "1"}]))
    changes = changes.union(_changes(spark, "order_detail_activity", extras)).union(_changes(spark, "order_detail_coupon", coupons))
    names = spark.createDataFrame([("2401", "n")], "dic_code string, dic_name string")
    got = trade.order_pre_process(changes, names, F.lit(None))
    found = [(x["order_detail_id"], a) for x in extras for a in [x["activity_id"]]]
    expected = sorted(
        repr((x["id"], x["order_id"], x["sku_num"], a, c))
        for x in lines
        for _ in range({"1": 2, "2": 1}.get(x["order_id"], 0))
        for a in ([v for k, v in found if k is not None and k == x["id"]] or [None])
        for c in ([y["coupon_id"] for y in coupons if y["order_detail_id"] == x["id"]] or [None])
    )
    assert sorted(repr(tuple(r)) for r in got.select("id", "order_id", "sku_num", "activity_id", "coupon_id").collect()) == expected
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = trade.order_pre_process(changes, spark.createDataFrame([], names.schema).hint("broadcast"), F.lit(None))
        text = plan._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    moves = [part for part in text.split("\n\n") if "Exchange" in part.split("\n")[0] and "Broadcast" not in part.split("\n")[0] and "sku_name" in part]
    assert len(moves) == 1


def test_order_amount_moves_as_text_alone(spark):
    """The amount that is one of the columns that settle equal times is made again behind the exchange, with the same value."""
    names = ("id", "order_id", "user_id", "sku_id", "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts", "row_op_ts")
    rows = [("a", "1", "u", "s", "4", None, "1", total, "1700000000", "t") for total in ("3.5", "12", None)] + [("b", "2", "u", "s", "4", None, None, "x", "1700000000", "t")]
    orders = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    last = trade.latest_measures(orders, "split_total_amount")
    got = {r.id: r.order_amount for r in last.collect()}
    assert got["b"] is None and float(got["a"]) == 3.5  # the greatest text
    whole = [r for r in trade.order_measures(orders, "split_total_amount").collect() if r.id == "a" and r.split_total_amount == "3.5"]
    assert got["a"] == whole[0].order_amount and last.columns == [c for c in trade.order_measures(orders).columns]
    picked = [x for x in last._jdf.queryExecution().optimizedPlan().toString().split("\n") if "max(struct(" in x]
    assert picked and not any("order_amount, order_amount" in x for x in picked)
