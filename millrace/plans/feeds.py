"""The two input logs, derived by Spark from the given tables: a click log and a database change log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.codes import CODE_NAMES, local_rows
from millrace.schemas import CONFIG_ROW


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events_of(raw: DataFrame) -> DataFrame:
    """Events with the number in their property text as ``k`` and the time as an instant."""
    return raw.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return events_of(table(spark, folder, "events"))


PAGE_FIELDS = (
    "CAST(user_id AS STRING) AS mid",
    "CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS uid",
    "CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login' "
    "WHEN 'purchase' THEN 'payment' ELSE 'good_list' END AS page_id",
    "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN 'login' ELSE 'search' END AS last_page_id",
    "CASE WHEN k % 2 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type",
    "CASE WHEN k % 7 = 0 THEN NULL WHEN k % 4 = 0 THEN 'red widget' WHEN k % 4 = 2 THEN 'Blue BOLT 256' "
    "ELSE 'ring' END AS item",
    "CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new",
    "concat('v', k % 4) AS vc",
    "concat('ch', user_id % 3) AS ch",
    "CAST(user_id % 25 AS STRING) AS ar",
    "CAST(round(value * 1000) AS BIGINT) AS during_time",
)


def page_log_of(raw: DataFrame) -> DataFrame:
    """The flat page log: one row per event."""
    return events_of(raw).selectExpr("event_id AS log_id", "ts", *PAGE_FIELDS)


def page_log(spark: SparkSession, folder: str) -> DataFrame:
    return page_log_of(table(spark, folder, "events"))


def click_log_text(spark: SparkSession, folder: str) -> DataFrame:
    """The raw click log as JSON lines (``log_id, value``), some of them cut short."""
    rows = events(spark, folder).selectExpr("event_id AS log_id", "k", "event_type", "ts", *PAGE_FIELDS)
    on_page = F.expr("k % 11 <> 3")
    line = F.to_json(
        F.struct(
            F.struct("mid", "uid", "is_new", "vc", "ch", "ar").alias("common"),
            F.when(on_page, F.struct("page_id", "last_page_id", "item", "item_type", "during_time")).alias("page"),
            F.expr("CASE WHEN k % 11 = 3 THEN named_struct('entry', 'icon', 'loading_time', k * 10L) END").alias("start"),
            F.expr(
                "CASE WHEN k % 11 <> 3 AND k % 4 > 0 THEN transform(sequence(1, k % 4), i -> named_struct("
                "'display_type', if(i % 2 = 0, 'query', 'promotion'), 'item', CAST(log_id * 10 + i AS STRING),"
                "'item_type', 'sku_id', 'order', i, 'pos_id', i % 3)) END"
            ).alias("displays"),
            F.expr(
                "CASE WHEN k % 11 <> 3 AND k % 3 = 1 THEN array(named_struct('action_id', 'favor_add', 'item',"
                "CAST(k AS STRING), 'item_type', 'sku_id', 'ts', unix_millis(ts) + 500)) END"
            ).alias("actions"),
            F.expr(
                "CASE WHEN event_type = 'error' THEN named_struct('error_code', 1000L + k, 'msg', 'failed') END"
            ).alias("err"),
            F.expr("unix_millis(ts)").alias("ts"),
        )
    )
    return rows.select("log_id", "k", line.alias("line")).selectExpr(
        "log_id", "CASE WHEN k % 17 = 5 THEN left(line, length(line) - 5) ELSE line END AS value"
    )


# Payment type, refund reason, refund type and source type. Codes 1104, 1308 and 2405 occur in the logs but not here.
DIC = {code: name for code, name in CODE_NAMES.items() if code[:2] in ("11", "13", "15", "24")}


def dictionary(spark: SparkSession) -> DataFrame:
    return local_rows(spark, DIC)


def _change(
    rows: DataFrame, name: str, kind: str, time: str, data: dict[str, str], old: dict[str, str] | None = None
) -> DataFrame:
    def image(fields: dict[str, str]) -> str:
        pairs = ", ".join(f"'{field}', CAST({expr} AS STRING)" for field, expr in fields.items())
        return f"map({pairs})"

    return rows.selectExpr(
        "'shop' AS database",
        f"'{name}' AS table",
        f"{kind} AS type",
        f"CAST(unix_timestamp({time}) AS STRING) AS ts",
        f"{image(data)} AS data",
        f"{image(old)} AS old" if old else "CAST(NULL AS MAP<STRING, STRING>) AS old",
    )


def _text(time: str) -> str:
    return f"date_format({time}, 'yyyy-MM-dd HH:mm:ss')"


def cart_changes(spark: SparkSession, folder: str) -> DataFrame:
    return cart_changes_of(events(spark, folder))


def cart_changes_of(rows: DataFrame) -> DataFrame:
    rows = rows.where("event_type IN ('click', 'view')")
    return _change(
        rows,
        "cart_info",
        "CASE WHEN event_type = 'click' THEN 'insert' ELSE 'update' END",
        "ts",
        {
            "id": "event_id",
            "user_id": "user_id",
            "sku_id": "event_id % 2000",
            "source_type": "2401 + k % 5",
            "sku_num": "k % 20",
        },
        {"sku_num": "CASE WHEN event_type = 'click' OR k % 3 = 0 THEN NULL ELSE (k + 7) % 20 END"},
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Each order's creation, its first status change, and the end of some refunds."""
    orders = _orders(spark, folder)

    def data(status: str, time: str) -> dict[str, str]:
        return {
            "id": "o_orderkey",
            "user_id": "o_custkey",
            "province_id": "o_custkey % 25",
            "order_status": status,
            "operate_time": _text(time),
        }

    later, last = "o_orderdate + INTERVAL '1' DAY", "o_orderdate + INTERVAL '2' DAY"
    second = "CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1002' END"
    refunded = orders.where("o_orderstatus = 'P' AND o_orderkey % 2 = 0")
    return (
        _change(orders, "order_info", "'insert'", "o_orderdate", data("'1001'", "o_orderdate"))
        .union(_change(orders, "order_info", "'update'", later, data(second, later), {"order_status": "'1001'"}))
        .union(_change(refunded, "order_info", "'update'", last, data("'1006'", last), {"order_status": "'1005'"}))
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .withColumn("ts", F.col("l_shipdate").cast("timestamp"))
        .withColumn("id", F.expr("concat(l_orderkey, '-', l_linenumber)"))
        .withColumn("price", F.expr("CAST(l_extendedprice AS DECIMAL(16,2))"))
    )


def line_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _change(
        _lines(spark, folder),
        "order_detail",
        "'insert'",
        "ts",
        {
            "id": "id",
            "order_id": "l_orderkey",
            "sku_id": "l_partkey",
            "sku_name": "concat('part ', l_partkey)",
            "create_time": _text("ts"),
            "source_id": "l_suppkey",
            "source_type": "2401 + l_linenumber % 5",
            "sku_num": "CAST(l_quantity AS INT)",
            "order_price": "price",
            "split_total_amount": "price",
            "split_activity_amount": "CASE WHEN l_discount > 0.05 THEN price * CAST(l_discount AS DECIMAL(4,2)) END",
            "split_coupon_amount": "CASE WHEN l_tax > 0.05 THEN price * CAST(l_tax AS DECIMAL(4,2)) END",
        },
    )


def activity_changes(spark: SparkSession, folder: str) -> DataFrame:
    """One activity row per line id that has a discount."""
    rows = _lines(spark, folder).where("l_discount > 0.05").groupBy("id", "l_orderkey", "l_linenumber")
    return _change(
        rows.agg(F.min("ts").alias("ts")),
        "order_detail_activity",
        "'insert'",
        "ts",
        {
            "order_detail_id": "id",
            "activity_id": "l_orderkey % 7",
            "activity_rule_id": "l_linenumber",
        },
    )


def coupon_changes(spark: SparkSession, folder: str) -> DataFrame:
    """One coupon row per line id that has a coupon amount."""
    rows = _lines(spark, folder).where("l_tax > 0.05").groupBy("id", "l_orderkey").agg(F.min("ts").alias("ts"))
    return _change(
        rows, "order_detail_coupon", "'insert'", "ts", {"order_detail_id": "id", "coupon_id": "l_orderkey % 11"}
    )


def payment_changes(spark: SparkSession, folder: str) -> DataFrame:
    time = "o_orderdate + INTERVAL '2' HOUR"
    return _change(
        _orders(spark, folder).where("o_orderstatus = 'O'"),
        "payment_info",
        "'update'",
        time,
        {
            "order_id": "o_orderkey",
            "user_id": "o_custkey",
            "payment_type": "1101 + o_orderkey % 4",
            "payment_status": "CASE WHEN o_orderkey % 3 = 0 THEN '1601' ELSE '1602' END",
            "callback_time": _text(time),
        },
        {"payment_status": "'1601'"},
    )


def refund_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Refund requests, their finished lines, and the refund payments."""
    rows = _lines(spark, folder).where("l_returnflag = 'R'")
    orders = table(spark, folder, "orders").where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey")
    rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    request = {
        "id": "id",
        "user_id": "o_custkey",
        "order_id": "l_orderkey",
        "sku_id": "l_partkey",
        "refund_type": "1501 + l_linenumber % 2",
        "refund_reason_type": "1301 + l_partkey % 8",
        "refund_reason_txt": "concat('reason ', l_linenumber)",
        "refund_num": "CAST(l_quantity AS INT)",
        "refund_amount": "price",
        "create_time": _text("ts"),
    }
    finished = {**request, "refund_status": "'0705'"}
    payment = {
        "id": "id",
        "order_id": "l_orderkey",
        "sku_id": "l_partkey",
        "payment_type": "1101 + l_orderkey % 4",
        "callback_time": _text("ts"),
        "total_amount": "price",
        "refund_status": "CASE WHEN l_partkey % 3 = 0 THEN '0701' ELSE '0702' END",
    }
    return (
        _change(rows, "order_refund_info", "'insert'", "ts", request)
        .union(
            _change(
                rows.where("l_partkey % 2 = 0"),
                "order_refund_info",
                "'update'",
                "ts",
                finished,
                {"refund_status": "'0702'"},
            )
        )
        .union(_change(rows, "refund_payment", "'insert'", "ts", payment))
    )


CHANGES = {
    "cart": cart_changes,
    "orders": order_changes,
    "lines": line_changes,
    "activities": activity_changes,
    "coupons": coupon_changes,
    "payments": payment_changes,
    "refunds": refund_changes,
}


def change_log(spark: SparkSession, folder: str, *parts: str) -> DataFrame:
    """The change log of the named parts, or of all of them. Parts a query does not ask for are pruned from its plan."""
    return reduce(DataFrame.unionByName, [CHANGES[part](spark, folder) for part in parts or CHANGES])


def dimension_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of region, nation and part as change records."""

    def rows(name: str, *columns: str) -> DataFrame:
        return _change(
            table(spark, folder, name), name, "'bootstrap-insert'", "TIMESTAMP '2024-01-01 00:00:00'", {c: c for c in columns}
        )

    return (
        rows("region", "r_regionkey", "r_name")
        .union(rows("nation", "n_nationkey", "n_name", "n_regionkey"))
        .union(rows("part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"))
        .union(rows("supplier", "s_suppkey", "s_name", "s_nationkey"))
    )


def config_rows(spark: SparkSession) -> DataFrame:
    """Configuration changes of the dimension tables: created, one widened, one deleted."""
    table_rows = spark.sql(
        """SELECT * FROM VALUES
            (1L, 'c', 'region', 'dim_region', 'r_regionkey,r_name', 'r_regionkey'),
            (2L, 'c', 'nation', 'dim_nation', 'n_nationkey,n_name', 'n_nationkey'),
            (3L, 'c', 'part', 'dim_part', 'p_partkey,p_brand', 'p_partkey'),
            (4L, 'c', 'supplier', 'dim_supplier', 's_suppkey,s_name', 's_suppkey'),
            (5L, 'u', 'nation', 'dim_nation', 'n_nationkey,n_name,n_regionkey', 'n_nationkey'),
            (6L, 'd', 'supplier', 'dim_supplier', 's_suppkey,s_name', 's_suppkey')
        AS t(ts_ms, op, source_table, sink_table, sink_columns, sink_pk)"""
    )
    return config_records(table_rows)


def config_records(rows: DataFrame, *keep: str) -> DataFrame:
    """``op, source_table, sink_table, sink_columns, ts_ms`` as change records, with the columns to keep."""
    pk = F.col("sink_pk") if "sink_pk" in rows.columns else F.lit(None).cast("string").alias("sink_pk")
    entry = F.struct(
        "source_table",
        "sink_table",
        "sink_columns",
        pk,
        F.lit(None).cast("string").alias("sink_extend"),
    )
    nothing = F.lit(None).cast(CONFIG_ROW)
    return rows.select(
        F.when(F.col("op") == "d", entry).otherwise(nothing).alias("before"),
        F.when(F.col("op") != "d", entry).otherwise(nothing).alias("after"),
        "op",
        "ts_ms",
        *keep,
    )


def dictionary_log(spark: SparkSession, folder: str) -> DataFrame:
    """Names of source codes over time (``dic_code, dic_name, since, seq, gone``): a registration renames a code, some errors remove one."""
    rows = events(spark, folder).where("event_type IN ('signup', 'error')")
    return rows.selectExpr(
        "CAST(2401 + k % 5 AS STRING) AS dic_code", "concat('source of ', event_id) AS dic_name", "ts AS since", "event_id AS seq",
        "event_type = 'error' AND event_id % 3 = 0 AS gone",
    )


def table_log(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of many small tables, with the place in the log."""
    rows = events(spark, folder).where("event_type IN ('view', 'click')")
    changes = _change(rows.withColumn("name", F.expr("concat('table_', user_id % 40)")), "any", "'insert'", "ts", {"id": "event_id", "k": "k", "user_id": "user_id", "name": "name"})
    return changes.withColumn("table", F.col("data")["name"]).withColumn("log_id", F.col("data")["id"])


def config_log(spark: SparkSession, folder: str) -> DataFrame:
    """Configuration changes of these tables at any time in the log: set by registrations, changed by errors, deleted by purchases."""
    rows = events(spark, folder).where("event_type IN ('signup', 'error', 'purchase')").selectExpr(
        "unix_millis(ts) AS ts_ms", "event_id AS seq", "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'u' ELSE 'd' END AS op",
        "concat('table_', user_id % 40) AS source_table", "concat('dim_', k % 4, '_', user_id % 40) AS sink_table",
        "CASE k % 3 WHEN 0 THEN 'id' WHEN 1 THEN 'id,k' ELSE 'id,user_id,k' END AS sink_columns",
    )
    return config_records(rows, "seq")
