"""The warehouse jobs: one dimension job, ten detail jobs, six report jobs.

Each takes the frames of its input topics and returns the frame of its output. Given streams it uses the keyed-state
forms and bounded joins, given tables the aggregate forms; the rules are the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.operators import changelog, dims, log_split, trade, visits, windows
from millrace.sources import click_log
from millrace.streaming import visits as streams


def _watermarked(df: DataFrame) -> DataFrame:
    return streams.with_watermark(df) if df.isStreaming else df


# --- dimensions and the click log -----------------------------------------------------------------------------


def dimension_tables(changes: DataFrame, config_changes: DataFrame) -> DataFrame:
    """Routed dimension rows. For a stream see ``sinks.dims.route_and_store``, which reads the configuration anew."""
    return dims.route_dimensions(changes, changelog.current_config(config_changes))


def click_log_topics(text: DataFrame) -> DataFrame:
    """Raw lines (``log_id, value``) as ``topic, value``: dirty, error, start, display, action and page records."""
    parsed = click_log.parse_log(text)
    dirty = click_log.dirty_lines(parsed).select(F.lit(log_split.TOPICS["dirty"]).alias("topic"), "value")
    records = click_log.clean_records(parsed)
    if text.isStreaming:
        flagged = streams.repair_new_flag(
            records.select(
                F.col("common.mid").alias("mid"),
                F.col("common.is_new").alias("is_new"),
                times.from_millis("ts").alias("ts"),
                "log_id",
                F.struct(*records.columns).alias("record"),
            )
        )
        kept = [F.col(f"record.{c}").alias(c) for c in records.columns if c != "common"]
        records = flagged.select(F.col("record.common").withField("is_new", F.col("is_new")).alias("common"), *kept)
    else:
        records = visits.repair_new_flag_records(records)
    return log_split.topic_rows(records).unionByName(dirty)


def unique_visitor_detail(pages: DataFrame, ttl_millis: int | None = None) -> DataFrame:
    return streams.unique_visitors(pages, ttl_millis) if pages.isStreaming else visits.unique_visitors(pages)


def user_jump_detail(pages: DataFrame) -> DataFrame:
    """On streams times are taken to rise within the topic, so the watermark has no delay."""
    if pages.isStreaming:
        return streams.bounces(streams.with_watermark(pages, "0 seconds"))
    return visits.bounces(pages)


# --- trade facts ----------------------------------------------------------------------------------------------


def cart_add(changes: DataFrame, dictionary: DataFrame) -> DataFrame:
    return trade.cart_add(changes, dictionary)


def order_pre_process(changes: DataFrame, dictionary: DataFrame, row_op_ts: Column | None = None) -> DataFrame:
    within = trade.ORDER_WAIT if changes.isStreaming else None
    return trade.order_pre_process(changes, dictionary, row_op_ts, within)


def order_detail(wide: DataFrame) -> DataFrame:
    return trade.order_detail(wide)


def cancel_detail(wide: DataFrame) -> DataFrame:
    return trade.cancel_detail(wide)


def pay_detail(changes: DataFrame, orders: DataFrame, dictionary: DataFrame) -> DataFrame:
    within = trade.ORDER_WAIT if changes.isStreaming else None
    return trade.pay_detail(changes, orders, dictionary, within=within)


def order_refund(changes: DataFrame, dictionary: DataFrame, row_op_ts: Column | None = None) -> DataFrame:
    within = trade.REFUND_WAIT if changes.isStreaming else None
    return trade.order_refund(changes, dictionary, row_op_ts, within)


def refund_pay(changes: DataFrame, dictionary: DataFrame, row_op_ts: Column | None = None) -> DataFrame:
    within = trade.REFUND_WAIT if changes.isStreaming else None
    return trade.refund_pay(changes, dictionary, row_op_ts, within)


# --- reports --------------------------------------------------------------------------------------------------


def keyword_window(pages: DataFrame) -> DataFrame:
    return windows.keyword_window(_watermarked(pages))


def traffic_window(pages: DataFrame, unique: DataFrame, bounced: DataFrame) -> DataFrame:
    """Each input of a stream has its own watermark, and the slowest one counts: bounces come later than their page."""
    return windows.traffic_window(
        windows.union_measures(_watermarked(pages), _watermarked(unique), _watermarked(bounced))
    )


def home_detail_window(pages: DataFrame) -> DataFrame:
    rules = streams if pages.isStreaming else visits
    return windows.home_detail_window(rules.home_detail_visits(_watermarked(pages)))


def login_window(pages: DataFrame) -> DataFrame:
    if pages.isStreaming:
        return windows.login_window(streams.login_days(_watermarked(pages)))
    return windows.login_window(visits.login_days(visits.logins(pages)))


def cart_add_window(facts: DataFrame) -> DataFrame:
    if facts.isStreaming:
        rows = _watermarked(facts.withColumn("ts", times.from_second_text("ts")))
        return windows.cart_add_window(streams.cart_add_users(rows))
    return windows.cart_add_window(trade.cart_add_user_times(facts))


def sku_order_window(orders: DataFrame, sku: DataFrame, chain: trade.DimensionChain | None = None) -> DataFrame:
    """Orders per product, with all names of the report if the dimension ``chain`` is given. ``orders`` hold one row per line id: ``newest_lines`` of the fact, or a table of it."""
    if orders.isStreaming:
        report = streams.sku_order_window(streams.flag_order_users(_watermarked(trade.order_measures(orders))))
    else:
        report = trade.sku_order_window(trade.flag_order_users(trade.latest_measures(orders)))
    named = trade.with_sku_names(report, sku)
    return named if chain is None else trade.with_dimension_chain(named, *chain)


def newest_lines(orders: DataFrame) -> DataFrame:
    """The newest version of each line id; a stream of its own, as it runs on processing time."""
    if orders.isStreaming:
        return streams.latest_versions(orders, "id", "row_op_ts")
    # equal times: the later arrival
    return changelog.latest_by_key(orders, "id", ["row_op_ts", *[c for c in orders.columns if c == "log_id"]])


@dataclass(frozen=True)
class Job:
    """A job: its function, where the result goes, and the key or columns it is stored by."""

    run: Callable[..., DataFrame]
    target: str
    keys: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()


JOBS = {
    "dim": Job(dimension_tables, "dimension tables", ("sink_pk",)),
    "log_split": Job(click_log_topics, "topic per row"),
    "unique_visitor": Job(unique_visitor_detail, "dwd_traffic_unique_visitor_detail"),
    "user_jump": Job(user_jump_detail, "dwd_traffic_user_jump_detail"),
    "cart_add": Job(cart_add, "dwd_trade_cart_add", ("id",), schemas.CART_ADD),
    "order_pre_process": Job(order_pre_process, "dwd_trade_order_pre_process", ("id",), schemas.ORDER_PRE_PROCESS),
    "order_detail": Job(order_detail, "dwd_trade_order_detail", ("id",), schemas.ORDER_DETAIL),
    "cancel_detail": Job(cancel_detail, "dwd_trade_cancel_detail", ("id",), schemas.CANCEL_DETAIL),
    "pay_detail": Job(pay_detail, "dwd_trade_pay_detail_suc", ("order_detail_id",), schemas.PAY_DETAIL),
    "order_refund": Job(order_refund, "dwd_trade_order_refund", ("id",), schemas.ORDER_REFUND),
    "refund_pay": Job(refund_pay, "dwd_trade_refund_pay_suc", ("id",), schemas.REFUND_PAY),
    "keyword_window": Job(
        keyword_window, "dws_traffic_source_keyword_page_view_window", columns=schemas.KEYWORD_WINDOW
    ),
    "traffic_window": Job(
        traffic_window, "dws_traffic_vc_ch_ar_is_new_page_view_window", columns=schemas.TRAFFIC_WINDOW
    ),
    "home_detail_window": Job(
        home_detail_window, "dws_traffic_home_detail_page_view_window", columns=schemas.HOME_DETAIL_WINDOW
    ),
    "login_window": Job(login_window, "dws_user_user_login_window", columns=schemas.LOGIN_WINDOW),
    "cart_add_window": Job(cart_add_window, "dws_trade_cart_add_uu_window", columns=schemas.CART_ADD_WINDOW),
    "sku_order_window": Job(sku_order_window, "dws_trade_sku_order_window", columns=schemas.SKU_ORDER_WINDOW),
}
