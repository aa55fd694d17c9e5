"""Record layouts of the two input logs, the detail facts and the window reports."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# --- click log ------------------------------------------------------------------------------------------------

COMMON = T.StructType(strings("mid", "uid", "is_new", "vc", "ch", "ar", "ba", "md", "os"))
PAGE = T.StructType(
    strings("page_id", "last_page_id", "item", "item_type", "source_type") + [T.StructField("during_time", T.LongType())]
)
START = T.StructType(
    strings("entry")
    + [T.StructField(n, T.LongType()) for n in ("open_ad_id", "loading_time", "open_ad_ms", "open_ad_skip_ms")]
)
DISPLAY = T.StructType(
    strings("display_type", "item", "item_type") + [T.StructField(n, T.IntegerType()) for n in ("order", "pos_id")]
)
ACTION = T.StructType(strings("action_id", "item", "item_type") + [T.StructField("ts", T.LongType())])
ERR = T.StructType([T.StructField("error_code", T.LongType()), T.StructField("msg", T.StringType())])

CLICK_LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("start", START),
        T.StructField("displays", T.ArrayType(DISPLAY)),
        T.StructField("actions", T.ArrayType(ACTION)),
        T.StructField("err", ERR),
        T.StructField("ts", T.LongType()),
    ]
)

# --- change log -----------------------------------------------------------------------------------------------

TEXT_MAP = T.MapType(T.StringType(), T.StringType())

CHANGE_LOG = T.StructType(
    strings("database", "table", "type", "ts") + [T.StructField("data", TEXT_MAP), T.StructField("old", TEXT_MAP)]
)

CONFIG_ROW = T.StructType(strings("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend"))
CONFIG_CHANGE = T.StructType(
    [T.StructField("before", CONFIG_ROW), T.StructField("after", CONFIG_ROW)]
    + strings("op")
    + [T.StructField("ts_ms", T.LongType())]
)

DICTIONARY = T.StructType(strings("dic_code", "dic_name"))

# --- detail facts. Columns in the order of the published record -------------------------------------------

CART_ADD = ("id", "user_id", "sku_id", "source_type_code", "source_type_name", "sku_num", "ts")

ORDER_PRE_PROCESS = (
    "id", "order_id", "sku_id", "sku_name", "date_id", "create_time", "source_id", "source_type", "sku_num",
    "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "od_ts",
    "user_id", "province_id", "operate_date_id", "operate_time", "order_status", "type", "old", "oi_ts",
    "activity_id", "activity_rule_id", "coupon_id", "source_type_name", "row_op_ts",
)

ORDER_DETAIL = (
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id",
    "date_id", "create_time", "source_id", "source_type_code", "source_type_name", "sku_num",
    "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts", "row_op_ts",
)

CANCEL_DETAIL = tuple("cancel_time" if name == "create_time" else name for name in ORDER_DETAIL)

PAY_DETAIL = (
    "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
    "coupon_id", "payment_type_code", "payment_type_name", "callback_time", "source_id", "source_type_code",
    "source_type_name", "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount",
    "split_payment_amount", "ts", "row_op_ts",
)

ORDER_REFUND = (
    "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time", "refund_type_code",
    "refund_type_name", "refund_reason_type_code", "refund_reason_type_name", "refund_reason_txt", "refund_num",
    "refund_amount", "ts", "row_op_ts",
)

REFUND_PAY = (
    "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name", "date_id",
    "callback_time", "refund_num", "refund_amount", "ts", "row_op_ts",
)

# --- window reports -------------------------------------------------------------------------------------------

KEYWORD_WINDOW = ("stt", "edt", "source", "keyword", "keyword_count", "ts")
TRAFFIC_WINDOW = ("stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct", "ts")
HOME_DETAIL_WINDOW = ("stt", "edt", "home_uv_ct", "good_detail_uv_ct", "ts")
LOGIN_WINDOW = ("stt", "edt", "back_ct", "uu_ct", "ts")
CART_ADD_WINDOW = ("stt", "edt", "cart_add_uu_ct", "ts")
SKU_ORDER_WINDOW = (
    "stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id",
    "category2_name", "category3_id", "category3_name", "sku_id", "sku_name", "spu_id", "spu_name",
    "order_uu_count", "order_count", "original_amount", "activity_amount", "coupon_amount", "order_amount", "ts",
)


def text_schema(columns: tuple[str, ...], **typed: T.DataType) -> T.StructType:
    """All-text record of ``columns``, except the ones given another type."""
    return T.StructType([T.StructField(name, typed.get(name, T.StringType())) for name in columns])


ORDER_PRE_PROCESS_RECORD = text_schema(ORDER_PRE_PROCESS, old=TEXT_MAP, row_op_ts=T.TimestampType())
ORDER_DETAIL_RECORD = text_schema(ORDER_DETAIL, row_op_ts=T.TimestampType())
CART_ADD_RECORD = text_schema(CART_ADD)
