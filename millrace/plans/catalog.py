"""The registered queries: each operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.functions.keywords import explode_words, register_words
from millrace.operators import asof, changelog, dims, joins, log_split, trade, visits, windows
from millrace.operators.segment import longest_words
from millrace.plans import feeds
from millrace.session import shared_dir
from millrace.sinks.dims import route_and_store
from millrace.sources import click_log, snapshot, tables
from millrace.sources.kafka import as_records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _millis(column: str = "ts"):
    return F.unix_millis(column)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


# --- traffic ------------------------------------------------------------------------------------------------


@query
def traffic_full_window(spark, folder):
    return windows.traffic_window_of_log(feeds.page_log(spark, folder))


@query
def traffic_union_window(spark, folder):
    """The three inputs of the report as three kinds of rows, from one pass over the log."""
    return windows.traffic_window(windows.flagged_measures(visits.flag_visits(feeds.page_log(spark, folder))))


@query
def traffic_page_window(spark, folder):
    pages = windows.page_measures(feeds.page_log(spark, folder))
    return windows.traffic_window(pages).drop("uv_ct", "uj_ct")


@query
def union_streams(spark, folder):
    log = feeds.page_log(spark, folder)
    rows = windows.union_measures(log, log.where(visits.is_entry()), log.where("page_id = 'payment'"))
    return rows.groupBy("vc", "is_new").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(m).alias(m) for m in windows.TRAFFIC_MEASURES]
    )


@query
def new_visitor_repair(spark, folder):
    return visits.repair_new_flag(feeds.page_log(spark, folder)).select("log_id", "mid", "is_new")


@query
def unique_visitor_detail(spark, folder):
    return visits.unique_visitors(feeds.page_log(spark, folder)).select("log_id", "mid", "page_id", _millis().alias("ts_ms"))


@query
def user_jump_10s(spark, folder):
    return visits.bounces(feeds.page_log(spark, folder)).select("log_id", "mid", "page_id", _millis().alias("ts_ms"))


@query
def user_jump_6h(spark, folder):
    return visits.bounces(feeds.page_log(spark, folder), "6 hours").select(
        "log_id", "mid", "page_id", _millis().alias("ts_ms")
    )


@query
def user_jump_hot_keys(spark, folder):
    """Every device treated as a hot one, so the chunked path is what gets checked."""
    flagged = visits.flag_visits(feeds.page_log(spark, folder), "6 hours", hot_rows=0)
    flags = [F.col(c).cast("int").alias(c) for c in ("is_visit_start", "is_unique_visit", "is_bounce")]
    return flagged.select("log_id", "mid", "is_new", *flags)


@query
def home_detail_uv_window(spark, folder):
    return windows.home_detail_window(visits.home_detail_visits(feeds.page_log(spark, folder)))


@query
def login_back_window(spark, folder):
    return windows.login_window(visits.login_days(visits.logins(feeds.page_log(spark, folder))))


@query
def login_filter(spark, folder):
    return visits.logins(feeds.page_log(spark, folder)).select("log_id", "uid", "last_page_id")


@query
def returning_customers(spark, folder):
    orders = feeds.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderdate").cast("timestamp").alias("ts")
    )
    days = visits.login_days(orders, "custkey")
    return days.select("custkey", times.date_text("day").alias("day"), "uu_ct", "back_ct")


# --- click log ----------------------------------------------------------------------------------------------


def _clean(spark, folder):
    return visits.repaired_records_of_lines(feeds.click_log_text(spark, folder))


@query
def dirty_split(spark, folder):
    text = feeds.events(spark, folder).selectExpr(
        "event_id", "CASE WHEN k % 17 = 5 THEN left(props, length(props) - 1) ELSE props END AS value"
    )
    return click_log.split_json_text(text).select("event_id", "value", F.col("is_dirty").cast("int").alias("is_dirty"))


@query
def log_split_dirty(spark, folder):
    return click_log.dirty_lines(click_log.parse_log(feeds.click_log_text(spark, folder))).select("log_id")


@query
def log_split_page(spark, folder):
    pages = click_log.page_columns(log_split.page_records(_clean(spark, folder)))
    return pages.select(
        "log_id", "mid", "uid", "is_new", "page_id", "last_page_id", "item", "during_time", _millis().alias("ts_ms")
    )


@query
def log_split_start(spark, folder):
    return log_split.start_records(_clean(spark, folder)).select(
        "log_id", "common.mid", "common.is_new", "start.entry", "start.loading_time", F.col("ts").alias("ts_ms")
    )


@query
def log_split_err(spark, folder):
    return log_split.error_records(_clean(spark, folder)).select(
        "log_id", "common.mid", "err.error_code", "err.msg", "page.page_id", F.size("displays").alias("n_displays")
    )


@query
def log_split_display(spark, folder):
    return log_split.display_records(_clean(spark, folder)).select(
        "log_id", "common.mid", "page.page_id", "display.display_type", "display.item",
        F.col("display.order").alias("display_order"), F.col("ts").alias("ts_ms"),
    )


@query
def log_split_action(spark, folder):
    return log_split.action_records(_clean(spark, folder)).select(
        "log_id", "common.mid", "page.page_id", "action.action_id", "action.item", F.col("action.ts").alias("action_ts")
    )


@query
def log_split_topics(spark, folder):
    """All outputs in one pass, counted per topic after reading their JSON text back."""
    rows = log_split.topic_rows(_clean(spark, folder))
    fields = rows.withColumn("mid", F.get_json_object("value", "$.common.mid"))
    return fields.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("mid").alias("n_devices")
    )


# --- keywords -----------------------------------------------------------------------------------------------


@query
def search_filter(spark, folder):
    return windows.searches(feeds.page_log(spark, folder)).select("log_id", "item")


@query
def keyword_window(spark, folder):
    return windows.keyword_window(feeds.page_log(spark, folder))


@query
def keyword_count_docs(spark, folder):
    return windows.keyword_count(feeds.table(spark, folder, "documents"), "text")


@query
def keyword_count_lateral(spark, folder):
    """The same in SQL, with the words from a table function."""
    register_words(spark)
    feeds.table(spark, folder, "documents").createOrReplaceTempView("keyword_documents")
    return spark.sql(
        "SELECT word AS keyword, count(*) AS keyword_count FROM keyword_documents AS d, LATERAL keyword_words(d.text) GROUP BY word"
    )


@query
def words_by_list(spark, folder):
    """Product names without spaces cut into words of the documents, the longest first."""
    names = feeds.table(spark, folder, "part").selectExpr("p_partkey", "concat(replace(p_name, ' ', ''), p_type) AS name")
    listed = explode_words(feeds.table(spark, folder, "documents").select("text"), "text", "word", "[a-z0-9]+")
    cut = longest_words(names, "name", listed, "word", 12)
    return cut.select("p_partkey", F.array_join("words", "|").alias("words"))


# --- change log ---------------------------------------------------------------------------------------------


@query
def cdc_bootstrap_filter(spark, folder):
    changes = feeds.events(spark, folder).selectExpr(
        "event_id",
        "CASE k % 5 WHEN 0 THEN 'bootstrap-start' WHEN 1 THEN 'bootstrap-complete' WHEN 2 THEN NULL"
        " WHEN 3 THEN 'bootstrap-insert' ELSE 'update' END AS type",
        "CASE WHEN k % 7 = 0 THEN NULL ELSE map('id', CAST(event_id AS STRING)) END AS data",
    )
    return changelog.drop_control_records(changes).select("event_id", "type", F.col("data")["id"].alias("id"))


@query
def cdc_changed_column(spark, folder):
    return changelog.select_changes(
        feeds.change_log(spark, folder),
        "order_info",
        ("id", "order_status"),
        ("update",),
        changelog.changed("order_status"),
        old_status=F.col("old")["order_status"],
        ts=F.col("ts"),
    )


@query
def upsert_latest(spark, folder):
    lines = feeds.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    latest = changelog.latest_by_key(
        lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]
    )
    return latest.withColumn("l_shipdate", times.date_text("l_shipdate"))


@query
def dim_config_apply(spark, folder):
    """Configuration in force, from one change per event."""
    rows = feeds.events(spark, folder).selectExpr(
        "event_id AS ts_ms",
        "CASE WHEN event_type = 'purchase' THEN 'd' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op",
        "concat('table_', user_id) AS source_table",
        "concat('dim_', user_id) AS sink_table",
        "concat('id,c', k) AS sink_columns",
    )
    return changelog.current_config(feeds.config_records(rows)).select("source_table", "sink_table", "sink_columns")


@query
def snapshot_cut_over(spark, folder):
    """A table that every event changes, read in eight chunks at different times and carried on from the change log."""
    log = feeds.events(spark, folder).selectExpr(
        "user_id", "k", "user_id % 8 AS chunk", "CASE WHEN event_type = 'purchase' THEN 'd' ELSE 'u' END AS op", "event_id AS seq"
    )
    last = log.agg(F.max("seq").alias("last"))
    marks = last.selectExpr("explode(sequence(0, 7)) AS chunk", "last").selectExpr(
        "chunk", "last * (chunk + 1) DIV 16 AS low", "last * (chunk + 3) DIV 16 AS high", "last * (chunk + 2) DIV 16 AS seen"
    )
    before = log.join(F.broadcast(marks.select("chunk", "seen")), "chunk").where("seq <= seen").drop("seen")
    rows = snapshot.current_rows(before, ["user_id"])
    return snapshot.current_rows(snapshot.cut_over(rows, log, marks, ["user_id"]), ["user_id"]).select("user_id", "k")


@query
def dim_routing(spark, folder):
    config = changelog.current_config(feeds.config_rows(spark))
    routed = dims.route_dimensions(feeds.dimension_changes(spark, folder), config)
    data = F.col("data")
    return routed.select(
        "sink_table",
        F.size("data").alias("n_fields"),
        F.coalesce(data["r_regionkey"], data["n_nationkey"], data["p_partkey"]).alias("pk"),
        F.coalesce(data["r_name"], data["n_name"], data["p_brand"]).alias("name"),
        data["p_type"].alias("unlisted"),
        data["n_regionkey"].alias("region"),
    )


@query
def dim_tables(spark, folder):
    """Configuration text and change text to dimension tables, each read by its name."""
    config = feeds.config_rows(spark)
    config = config.select(F.to_json(F.struct(*config.columns)).alias("value"))
    changes = feeds.dimension_changes(spark, folder)
    changes = as_records(changes.select(F.to_json(F.struct(*changes.columns)).alias("value")), schemas.CHANGE_LOG)
    write = route_and_store(lambda: tables.config_changes(config), shared_dir(spark, "dims"))
    write(changes, 0)
    named = [("dim_region", "r_regionkey", "r_name"), ("dim_nation", "n_nationkey", "n_name"), ("dim_part", "p_partkey", "p_brand")]
    rows = [
        spark.table(name).select(F.lit(name).alias("sink_table"), F.col(key).alias("pk"), F.col(text).alias("name"))
        for name, key, text in named
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def cart_add_from_json(spark, folder):
    """The cart fact from the text of the change log."""
    changes = feeds.change_log(spark, folder, "cart")
    text = changes.select(F.to_json(F.struct(*changes.columns)).alias("value"))
    return trade.cart_add(as_records(text, schemas.CHANGE_LOG), feeds.dictionary(spark))


# --- trade facts --------------------------------------------------------------------------------------------


def _without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop("row_op_ts", *columns)


@query
def cart_add_fact(spark, folder):
    return trade.cart_add(feeds.change_log(spark, folder), feeds.dictionary(spark))


@query
def cart_add_uu_window(spark, folder):
    facts = trade.cart_add(feeds.change_log(spark, folder), feeds.dictionary(spark))
    return windows.cart_add_window(trade.cart_add_user_times(facts))


@query
def cart_add_users(spark, folder):
    facts = trade.cart_add(feeds.change_log(spark, folder), feeds.dictionary(spark))
    return trade.cart_add_users(facts).select("user_id", "ts")


def _wide(spark, folder, extras=True):
    return trade.order_pre_process(
        feeds.change_log(spark, folder), feeds.dictionary(spark), times.operation_time("create_time"), extras=extras
    )


@query
def order_pre_process(spark, folder):
    rows = _wide(spark, folder)
    return _without(rows.withColumn("old_status", F.col("old")["order_status"]), "old")


@query
def order_state_latest(spark, folder):
    """The keyed table of the wide lines: the last version of each line id."""
    rows = _wide(spark, folder).select(
        "id", "order_id", "user_id", "order_status", "type", "coupon_id", "split_total_amount", "sku_id", "source_id",
        "sku_num", F.col("oi_ts").cast("bigint").alias("changed_at"),
    )
    order = ("changed_at", "order_status", "split_total_amount", "sku_id", "source_id", "sku_num")
    return changelog.latest_by_key(rows, "id", order)


@query
def refund_pay_latest(spark, folder):
    """The keyed table of paid refunds: several finished lines of one payment fall together."""
    rows = trade.refund_pay(feeds.change_log(spark, folder), feeds.dictionary(spark))
    kept = rows.select("id", "order_id", "sku_id", "refund_num", "refund_amount", F.col("ts").cast("bigint").alias("sec"))
    return changelog.latest_by_key(kept, "id", ("sec", "refund_num", "refund_amount", "sku_id"))


@query
def order_detail_fact(spark, folder):
    return _without(trade.order_detail(_wide(spark, folder)))


@query
def order_cancel_fact(spark, folder):
    return _without(trade.cancel_detail(_wide(spark, folder)))


@query
def payment_fact(spark, folder):
    orders = trade.order_detail(_wide(spark, folder))
    return _without(trade.pay_detail(feeds.change_log(spark, folder), orders, feeds.dictionary(spark)))


@query
def payment_success_fact(spark, folder):
    orders = trade.order_detail(_wide(spark, folder))
    paid = trade.pay_detail(feeds.change_log(spark, folder), orders, feeds.dictionary(spark), only_success=True)
    return paid.select("order_detail_id", "order_id", "payment_type_name", "callback_time", "split_payment_amount")


@query
def refund_fact(spark, folder):
    return _without(trade.order_refund(feeds.change_log(spark, folder), feeds.dictionary(spark)))


@query
def refund_pay_fact(spark, folder):
    return _without(trade.refund_pay(feeds.change_log(spark, folder), feeds.dictionary(spark)))


def _measures(spark, folder):
    ties = ("split_total_amount", "sku_id", "source_id", "sku_num")
    return trade.flag_order_users(trade.latest_measures(trade.order_detail(_wide(spark, folder, extras=False)), *ties))


@query
def order_uu_flag(spark, folder):
    return _measures(spark, folder).select("id", "user_id", "sku_id", "order_uu_count")


def _sku(spark, folder):
    return feeds.table(spark, folder, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS id",
        "p_name AS sku_name",
        "p_type AS spu_id",
        "p_brand AS tm_id",
        "CAST(p_partkey % 100 AS STRING) AS category3_id",
    )


AMOUNTS = ("original_amount", "activity_amount", "coupon_amount", "order_amount")


@query
def sku_order_window(spark, folder):
    report = trade.sku_order_window(_measures(spark, folder))
    return _rounded(trade.with_sku_names(report, _sku(spark, folder)), *AMOUNTS)


@query
def sku_order_day(spark, folder):
    return _rounded(trade.sku_order_window(_measures(spark, folder), "1 day"), *AMOUNTS)


def _chain(spark, folder):
    part = feeds.table(spark, folder, "part")
    spu = part.select(F.col("p_type").alias("id"), F.lower("p_type").alias("spu_name")).distinct()
    trademark = part.select(F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name")).distinct()
    category3 = feeds.table(spark, folder, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS id", "s_name AS name", "CAST(s_nationkey AS STRING) AS category2_id"
    )
    category2 = feeds.table(spark, folder, "nation").selectExpr(
        "CAST(n_nationkey AS STRING) AS id", "n_name AS name", "CAST(n_regionkey AS STRING) AS category1_id"
    )
    category1 = feeds.table(spark, folder, "region").selectExpr("CAST(r_regionkey AS STRING) AS id", "r_name AS name")
    return trade.DimensionChain(spu, trademark, category3, category2, category1)


@query
def sku_dim_chain(spark, folder):
    """Ordered amount per product with the names of all dimension levels."""
    lines = feeds.table(spark, folder, "lineitem")
    report = lines.groupBy(F.col("l_partkey").cast("string").alias("sku_id")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(16,2)")).cast("double").alias("order_amount")
    )
    named = trade.with_sku_names(report, _sku(spark, folder))
    return _rounded(trade.with_dimension_chain(named, *_chain(spark, folder)), "order_amount")


@query
def sku_order_full(spark, folder):
    """The product report with all its columns but the wall-clock one."""
    report = trade.with_sku_names(trade.sku_order_window(_measures(spark, folder)), _sku(spark, folder))
    named = trade.with_dimension_chain(report, *_chain(spark, folder))
    return _rounded(named.select(*[c for c in schemas.SKU_ORDER_WINDOW if c != "ts"]), *AMOUNTS)


# --- joins and columns --------------------------------------------------------------------------------------


def _sides(spark, folder):
    orders = feeds.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customers = feeds.table(spark, folder, "customer").select((F.col("c_custkey") * 2).alias("c_key"), "c_name")
    return orders, customers, [("o_custkey", "c_key")]


@query
def join_inner(spark, folder):
    return joins.regular_join(*_sides(spark, folder))


@query
def join_left(spark, folder):
    return joins.regular_join(*_sides(spark, folder), "left")


@query
def join_right(spark, folder):
    return joins.regular_join(*_sides(spark, folder), "right")


@query
def join_full(spark, folder):
    return joins.regular_join(*_sides(spark, folder), "full")


def _clicks_and_purchases(spark, folder):
    rows = feeds.events(spark, folder)
    clicks = rows.where("event_type = 'click'").selectExpr("event_id AS click_id", "user_id AS c_user", "ts AS c_ts")
    bought = rows.where("event_type = 'purchase'").selectExpr("event_id AS buy_id", "user_id AS b_user", "ts AS b_ts")
    return clicks, bought, [("c_user", "b_user")]


@query
def join_interval(spark, folder):
    pairs = joins.interval_join(*_clicks_and_purchases(spark, folder), "c_ts", "b_ts", 3_600_000)
    return pairs.select("click_id", "buy_id", "c_user")


@query
def join_interval_left(spark, folder):
    pairs = joins.interval_join(*_clicks_and_purchases(spark, folder), "c_ts", "b_ts", 3_600_000, "left")
    return pairs.select("click_id", "buy_id", "c_user")


@query
def join_interval_right(spark, folder):
    pairs = joins.interval_join(*_clicks_and_purchases(spark, folder), "c_ts", "b_ts", 3_600_000, "right")
    return pairs.select("click_id", "buy_id", "b_user")


@query
def join_interval_full(spark, folder):
    pairs = joins.interval_join(*_clicks_and_purchases(spark, folder), "c_ts", "b_ts", 3_600_000, "full")
    return pairs.select("click_id", "buy_id")


@query
def join_retention(spark, folder):
    """Orders and their payments, at most 905 seconds plus two hours apart."""
    changes = feeds.change_log(spark, folder)
    orders = changelog.select_changes(
        changes, "order_info", {"oi_id": "id"}, ("insert",), None, oi_time=changelog.change_time()
    )
    paid = changelog.select_changes(
        changes, "payment_info", {"pi_id": "order_id", "payment_type": "payment_type"}, (), None,
        pi_time=changelog.change_time(),
    )
    pairs = joins.join_within(orders, paid, [("oi_id", "pi_id")], "oi_time", "pi_time", 905_000, 8_105_000)
    return pairs.select("oi_id", "payment_type", times.date_time_text("pi_time").alias("paid_at"))


@query
def join_lookup(spark, folder):
    rows = feeds.events(spark, folder).select("event_id", (F.col("k") % 5 + 2401).cast("string").alias("code"))
    return joins.lookup_name(rows, feeds.dictionary(spark), "code", "source_name")


def _cart_codes(spark, folder):
    """Cart changes with the code of their source and their time."""
    rows = feeds.events(spark, folder).where("event_type IN ('click', 'view')")
    return rows.selectExpr("event_id AS log_id", "CASE WHEN k % 13 <> 4 THEN CAST(2401 + k % 5 AS STRING) END AS source_type", "ts")


def _dictionary_versions(spark, folder):
    return asof.Versions(feeds.dictionary_log(spark, folder), ["dic_code"], "since", ["dic_name"], ["seq"], "gone")


@query
def lookup_as_of(spark, folder):
    """The name a code had at the time of the row, for codes that are renamed and removed in mid log."""
    rows = asof.as_of_chunks(_cart_codes(spark, folder), _dictionary_versions(spark, folder), ["source_type"], "ts")
    return rows.select("log_id", "source_type", "dic_name")


@query
def lookup_as_of_ranges(spark, folder):
    """The same without rows that have no name, by ranges of validity."""
    rows = asof.as_of_ranges(_cart_codes(spark, folder), _dictionary_versions(spark, folder), ["source_type"], "ts", inner=True)
    return rows.select("log_id", "source_type", "dic_name")


def _routed_as_of(spark, folder, chunked):
    config = dims.config_versions(feeds.config_log(spark, folder), ["seq"])
    routed = dims.route_dimensions_as_of(feeds.table_log(spark, folder), config, chunked=chunked)
    data = F.col("data")
    return routed.select("log_id", "sink_table", "sink_pk", F.size("data").alias("n_fields"), data["k"].alias("k"), data["user_id"].alias("user_id"))


@query
def dim_routing_as_of(spark, folder):
    """Changes routed by the configuration in force at their time."""
    return _routed_as_of(spark, folder, chunked=False)


@query
def dim_routing_as_of_chunks(spark, folder):
    """The same for configurations of any number of versions."""
    return _routed_as_of(spark, folder, chunked=True)


@query
def dim_lookup(spark, folder):
    """Point lookups by two columns at once, as one join."""
    wanted = feeds.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_linenumber") * 5).cast("int").alias("p_size")
    )
    return joins.lookup_rows(wanted, feeds.table(spark, folder, "part"), ["p_partkey", "p_size"]).select(
        "p_partkey", "p_size", "p_name"
    )


@query
def time_columns(spark, folder):
    """The time rules on orders and events."""
    rows = feeds.events(spark, folder).select("event_id", F.unix_millis("ts").alias("ms"))
    moment = times.from_millis("ms")
    return rows.select(
        "event_id",
        times.date_text(moment).alias("day"),
        times.date_time_text(moment).alias("at"),
        times.date_time_text(times.from_millis_to_second("ms")).alias("at_second"),
        times.date_of_text(times.date_time_text(moment)).alias("day_of_text"),
        times.text_to_millis(times.date_text(moment)).alias("midnight_east8"),
        times.text_to_millis(times.date_time_text(moment), "+08:00", full=True).alias("ms_east8"),
    )


@query
def operation_time_order(spark, folder):
    """Texts with trimmed fractions of a second, compared by value with their neighbour."""
    rows = feeds.events(spark, folder).selectExpr(
        "event_id",
        "concat('2022-04-01 11:10:55', CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN '.04' ELSE '.049' END, 'Z') AS stamp",
        "concat('2022-04-01 11:10:55.0', CAST(k AS STRING), 'Z') AS other",
    )
    return rows.select(
        "event_id", (times.operation_time("stamp") >= times.operation_time("other")).cast("int").alias("not_before")
    )
