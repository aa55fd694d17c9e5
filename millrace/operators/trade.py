"""Trade facts from the change log: cart additions, orders, cancellations, payments, refunds.

On tables the joins are plain equi joins. With ``within`` the same facts run on streams: each side then carries its
change time with a watermark and partners must lie at most that far apart.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import codes, schemas
from millrace.functions import times
from millrace.functions.scalars import added_quantity, money_product_text, zero_if_null
from millrace.operators.changelog import became, change_time, first_by_key, latest_by_key, select_changes
from millrace.operators.joins import Link, enrich, join_within, lookup_name, regular_join
from millrace.operators.windows import SIZE, window_report

# How long the joins of each fact wait for a partner, in milliseconds.
ORDER_WAIT = 905_000
REFUND_WAIT = 5_000


def _timed(side: DataFrame, name: str, within: int | None) -> DataFrame:
    """Keep the change time ``name`` only where a bounded join needs it."""
    return side.withWatermark(name, f"{within} milliseconds") if within else side.drop(name)


def _join(left, right, on, left_time, right_time, within, how="inner") -> DataFrame:
    if within is None:
        return regular_join(left, right, on, how)
    return join_within(left, right, on, left_time, right_time, within, within, how)


def _stamp(row_op_ts: Column | None) -> Column:
    return F.current_timestamp() if row_op_ts is None else row_op_ts


# --- cart -----------------------------------------------------------------------------------------------------


def cart_add(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Items put into the cart: inserted lines, and the growth of enlarged ones."""
    data, old = F.col("data"), F.col("old")
    lines = select_changes(
        changes,
        "cart_info",
        {"id": "id", "user_id": "user_id", "sku_id": "sku_id", "source_type_code": "source_type"},
        ("insert", "update"),
        sku_num=added_quantity(F.col("type"), data["sku_num"], old["sku_num"]),
        _insert=F.col("type") == "insert",
        ts=F.col("ts"),
    ).where("_insert OR sku_num IS NOT NULL")
    return lookup_name(lines, dictionary, "source_type_code", "source_type_name").select(*schemas.CART_ADD)


def cart_add_users(facts: DataFrame) -> DataFrame:
    """The first addition of each user and date, as whole rows."""
    rows = facts.withColumn("_at", times.from_second_text("ts"))
    return first_by_key(rows, ["user_id", F.to_date("_at")], ("_at", "id")).drop("_at")


def cart_add_user_times(facts: DataFrame) -> DataFrame:
    """Only the time of each user's first addition per date; all the window report needs."""
    at = times.from_second_text("ts")
    return facts.groupBy("user_id", F.to_date(at).alias("day")).agg(F.min(at).alias("ts"))


# --- orders ---------------------------------------------------------------------------------------------------


def _with_added(lines: DataFrame, activities: DataFrame, coupons: DataFrame) -> DataFrame:
    """Tables of lines with their activities and coupons, dealt out by order id for a join with orders. Lines without order id are left out.

    Only ids move by line id. What is found there goes by order id to where the lines go too, so a line moves once. A join on both
    ids would move it again, as Spark parts a join by all its keys; a window is content with one of them.
    """
    lines = lines.where("order_id IS NOT NULL")
    ids = lines.select("id", "order_id").repartition("id").distinct()  # each pair once, however many versions a line has
    found = regular_join(ids, activities, [("id", "act_od_id")], "left")
    found = regular_join(found, coupons, [("id", "cou_od_id")], "left").where("act_od_id IS NOT NULL OR cou_od_id IS NOT NULL")
    added = found.select("id", "order_id", F.struct("activity_id", "activity_rule_id", "coupon_id").alias("_added"))
    rows = lines.unionByName(added, allowMissingColumns=True).repartition("order_id")
    own = F.collect_list("_added").over(Window.partitionBy("order_id", "id"))
    rows = rows.withColumn("_own", own).where("_added IS NULL").withColumn("_one", F.explode_outer("_own"))
    return rows.select(*lines.columns, "_one.*")


def order_pre_process(
    changes: DataFrame, dictionary: DataFrame, row_op_ts: Column | None = None, within: int | None = None, extras: bool = True
) -> DataFrame:
    """Wide order lines: line, every state of its order, activity, coupon and source name.

    One row per line and order change, as a change log; the order facts below pick theirs from it. Without ``extras`` the columns of activities and
    coupons are null and rows are not repeated for them: for readers of tables that keep one version of a line id and use none of these columns.
    """
    data = F.col("data")
    lines = select_changes(
        changes,
        "order_detail",
        (
            "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num",
            "split_total_amount", "split_activity_amount", "split_coupon_amount",
        ),
        ("insert",),
        split_original_amount=money_product_text(data["sku_num"], data["order_price"]),
        od_ts=F.col("ts"),
        od_time=change_time(),
    )
    orders = select_changes(
        changes,
        "order_info",
        {
            "oi_id": "id", "user_id": "user_id", "province_id": "province_id",
            "operate_time": "operate_time", "order_status": "order_status",
        },
        ("insert", "update"),
        type=F.col("type"),
        old=F.col("old"),
        oi_ts=F.col("ts"),
        oi_time=change_time(),
    )
    activities = select_changes(
        changes,
        "order_detail_activity",
        {"act_od_id": "order_detail_id", "activity_id": "activity_id", "activity_rule_id": "activity_rule_id"},
        ("insert",),
        act_time=change_time(),
    )
    coupons = select_changes(
        changes,
        "order_detail_coupon",
        {"cou_od_id": "order_detail_id", "coupon_id": "coupon_id"},
        ("insert",),
        cou_time=change_time(),
    )
    lines = _timed(lookup_name(lines, dictionary, "source_type", "source_type_name"), "od_time", within)
    orders = _timed(orders, "oi_time", within)
    activities = _timed(activities, "act_time", within)
    coupons = _timed(coupons, "cou_time", within)

    if not extras:
        wide = _join(lines, orders, [("order_id", "oi_id")], "od_time", "oi_time", within)
        wide = wide.withColumns({c: F.lit(None).cast("string") for c in ("activity_id", "activity_rule_id", "coupon_id")})
    elif within is None:
        wide = regular_join(_with_added(lines, activities, coupons), orders, [("order_id", "oi_id")])
    else:  # the line-level sides share the line id, so they are joined before the order key takes over
        wide = _join(lines, activities, [("id", "act_od_id")], "od_time", "act_time", within, "left")
        wide = _join(wide, coupons, [("id", "cou_od_id")], "od_time", "cou_time", within, "left")
        wide = _join(wide, orders, [("order_id", "oi_id")], "od_time", "oi_time", within)
    return (
        wide.withColumn("date_id", times.date_of_text("create_time"))
        .withColumn("operate_date_id", times.date_of_text("operate_time"))
        .withColumn("row_op_ts", _stamp(row_op_ts))
        .select(*schemas.ORDER_PRE_PROCESS)
    )


def order_detail(wide: DataFrame) -> DataFrame:
    """Ordered lines: the state in which the order was created."""
    rows = wide.where("type = 'insert'")
    renamed = {"source_type_code": "source_type", "ts": "od_ts"}
    return rows.select(*[F.col(renamed.get(c, c)).alias(c) for c in schemas.ORDER_DETAIL])


def cancel_detail(wide: DataFrame) -> DataFrame:
    """Cancelled lines: the order's status changed to cancelled."""
    rows = wide.where(
        (F.col("type") == "update")
        & F.col("old")["order_status"].isNotNull()
        & (F.col("order_status") == codes.ORDER_CANCELLED)
    )
    renamed = {
        "source_type_code": "source_type", "ts": "oi_ts", "date_id": "operate_date_id", "cancel_time": "operate_time",
    }
    return rows.select(*[F.col(renamed.get(c, c)).alias(c) for c in schemas.CANCEL_DETAIL])


# --- payments and refunds -------------------------------------------------------------------------------------


def pay_detail(
    changes: DataFrame,
    orders: DataFrame,
    dictionary: DataFrame,
    only_success: bool = False,
    within: int | None = None,
) -> DataFrame:
    """Paid lines: every payment change joined with the ordered lines of its order.

    ``only_success`` restricts to payments that became successful. On streams the line's own ``ts`` gives its time.
    """
    paid = select_changes(
        changes,
        "payment_info",
        {"pi_order_id": "order_id", "payment_type_code": "payment_type", "callback_time": "callback_time"},
        ("update",) if only_success else (),
        F.col("data")["payment_status"] == codes.PAYMENT_SUCCEEDED if only_success else None,
        pi_ts=F.col("ts"),
        pi_time=change_time(),
    )
    paid = lookup_name(paid, dictionary, "payment_type_code", "payment_type_name")
    paid = _timed(paid, "pi_time", within)
    lines = _timed(orders.withColumn("od_time", times.from_second_text("ts")), "od_time", within)
    rows = _join(lines, paid, [("order_id", "pi_order_id")], "od_time", "pi_time", within)
    renamed = {"order_detail_id": "id", "split_payment_amount": "split_total_amount", "ts": "pi_ts"}
    return rows.select(*[F.col(renamed.get(c, c)).alias(c) for c in schemas.PAY_DETAIL])


def order_refund(
    changes: DataFrame, dictionary: DataFrame, row_op_ts: Column | None = None, within: int | None = None
) -> DataFrame:
    """Refund requests of orders that went into refunding, with the names of refund type and reason."""
    requests = select_changes(
        changes,
        "order_refund_info",
        {
            "id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
            "create_time": "create_time", "refund_type_code": "refund_type",
            "refund_reason_type_code": "refund_reason_type", "refund_reason_txt": "refund_reason_txt",
            "refund_num": "refund_num", "refund_amount": "refund_amount",
        },
        ("insert",),
        ts=F.col("ts"),
        ri_time=change_time(),
    )
    orders = select_changes(
        changes,
        "order_info",
        {"oi_id": "id", "province_id": "province_id"},
        ("update",),
        became("order_status", codes.ORDER_REFUNDING),
        oi_time=change_time(),
    )
    requests = lookup_name(requests, dictionary, "refund_type_code", "refund_type_name")
    requests = lookup_name(requests, dictionary, "refund_reason_type_code", "refund_reason_type_name")
    rows = _join(
        _timed(requests, "ri_time", within),
        _timed(orders, "oi_time", within),
        [("order_id", "oi_id")], "ri_time", "oi_time", within,
    )
    return (
        rows.withColumn("date_id", times.date_of_text("create_time"))
        .withColumn("row_op_ts", _stamp(row_op_ts))
        .select(*schemas.ORDER_REFUND)
    )


def refund_pay(
    changes: DataFrame, dictionary: DataFrame, row_op_ts: Column | None = None, within: int | None = None
) -> DataFrame:
    """Refunds paid out: the payment, its finished refund line and its order that became refunded."""
    payments = select_changes(
        changes,
        "refund_payment",
        {
            "id": "id", "order_id": "order_id", "sku_id": "sku_id", "payment_type_code": "payment_type",
            "callback_time": "callback_time", "refund_amount": "total_amount",
        },
        (),
        F.col("data")["refund_status"] == codes.REFUND_PAID,
        ts=F.col("ts"),
        rp_time=change_time(),
    )
    lines = select_changes(
        changes,
        "order_refund_info",
        {"ri_order_id": "order_id", "ri_sku_id": "sku_id", "refund_num": "refund_num"},
        ("update",),
        became("refund_status", codes.REFUND_LINE_FINISHED),
        ri_time=change_time(),
    )
    orders = select_changes(
        changes,
        "order_info",
        {"oi_id": "id", "user_id": "user_id", "province_id": "province_id"},
        ("update",),
        became("order_status", codes.ORDER_REFUNDED),
        oi_time=change_time(),
    )
    payments = lookup_name(payments, dictionary, "payment_type_code", "payment_type_name")
    payments = _timed(payments, "rp_time", within)
    rows = _join(
        payments,
        _timed(lines, "ri_time", within),
        [("order_id", "ri_order_id"), ("sku_id", "ri_sku_id")], "rp_time", "ri_time", within,
    )
    rows = _join(rows, _timed(orders, "oi_time", within), [("order_id", "oi_id")], "rp_time", "oi_time", within)
    return (
        rows.withColumn("date_id", times.date_of_text("callback_time"))
        .withColumn("row_op_ts", _stamp(row_op_ts))
        .select(*schemas.REFUND_PAY)
    )


# --- orders per product ---------------------------------------------------------------------------------------


# Amounts are summed as decimals, so that a sum doesn't depend on the order of its rows; reports show doubles.
AMOUNT = "decimal(28,4)"


def order_measures(lines: DataFrame, *keep: str) -> DataFrame:
    """Ordered lines as measure rows; a missing activity or coupon amount counts as zero."""

    def amount(column: str) -> Column:
        return F.col(column).try_cast(AMOUNT)

    return lines.select(
        "id",
        "order_id",
        "user_id",
        "sku_id",
        amount("split_original_amount").alias("original_amount"),
        zero_if_null(amount("split_activity_amount")).alias("activity_amount"),
        zero_if_null(amount("split_coupon_amount")).alias("coupon_amount"),
        amount("split_total_amount").alias("order_amount"),
        times.from_second_text("ts").alias("ts"),
        *keep,
    )


def latest_measures(orders: DataFrame, *tie: str) -> DataFrame:
    """Measure rows of the last written version of each line id (``tie`` columns settle equal times).

    The rows are cut down to what the report needs before they are shuffled by id.
    """
    order = ("row_op_ts", *tie)
    extra = [c for c in order if c not in ("order_id", "user_id", "sku_id")]
    rows = order_measures(orders, *extra)
    # what the order's columns give again does not move beside them
    again = {"order_amount": F.col("split_total_amount").try_cast(AMOUNT)} if "split_total_amount" in order else {}
    rest = [c for c in rows.columns if c != "id" and c not in order and c not in again]
    # the greatest row and not the one by the greatest order: the order's columns move once
    last = rows.groupBy("id").agg(F.max(F.struct(*order, *rest)).alias("_row"))
    last = last.select("id", "_row.*").withColumns(again)
    return last.select(*[c for c in rows.columns if c not in extra])


def flag_order_users(lines: DataFrame) -> DataFrame:
    """Add ``order_uu_count``: 1 on the first line of each user and date, 0 on the others. Line ids must be unique.

    The first lines come from an aggregate and are joined back by line id, so no task holds a user's lines.
    """
    keyed = lines.select("user_id", "ts", "id")
    first = keyed.groupBy("user_id", F.to_date("ts").alias("_day")).agg(F.min(F.struct("ts", "id")).alias("_first"))
    marks = first.select(F.col("_first.id").alias("_first_id"), F.lit(1).cast("bigint").alias("_one"))
    return lines.join(marks, F.col("id") == F.col("_first_id"), "left").select(
        *lines.columns, F.coalesce("_one", F.lit(0).cast("bigint")).alias("order_uu_count")
    )


def sku_order_window(flagged: DataFrame, size: str = SIZE, order_count: Column | None = None) -> DataFrame:
    """Users, distinct orders and amounts per product and window. Streams have no distinct aggregates and bring an ``order_count`` of their own."""
    if order_count is None:
        order_count = F.count_distinct("order_id")
    amounts = ("original_amount", "activity_amount", "coupon_amount", "order_amount")
    measures = [
        F.sum("order_uu_count").cast("bigint").alias("order_uu_count"),
        order_count.alias("order_count"),
        *[F.sum(a).cast("double").alias(a) for a in amounts],
    ]
    return window_report(flagged, ["sku_id"], measures, size)


def with_sku_names(report: DataFrame, sku: DataFrame) -> DataFrame:
    """Name, spu, trademark and category of each product; products without an entry keep nulls."""
    fields = {"sku_name": "sku_name", "spu_id": "spu_id", "trademark_id": "tm_id", "category3_id": "category3_id"}
    return enrich(report, Link(sku, "sku_id", "id", fields))


class DimensionChain(NamedTuple):
    """Dimension tables behind a product: spu and trademark, and the category levels 3, 2 and 1."""

    spu: DataFrame
    trademark: DataFrame
    category3: DataFrame
    category2: DataFrame
    category1: DataFrame


def with_dimension_chain(
    report: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame, category2: DataFrame, category1: DataFrame
) -> DataFrame:
    """Names of spu and trademark, and the category levels 3, 2 and 1, after ``with_sku_names``."""
    return enrich(
        report,
        Link(spu, "spu_id", "id", {"spu_name": "spu_name"}),
        Link(trademark, "trademark_id", "id", {"trademark_name": "tm_name"}),
        Link(category3, "category3_id", "id", {"category3_name": "name", "category2_id": "category2_id"}),
        Link(category2, "category2_id", "id", {"category2_name": "name", "category1_id": "category1_id"}),
        Link(category1, "category1_id", "id", {"category1_name": "name"}),
    )
