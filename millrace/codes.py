"""The code dictionary and the status codes the facts select on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.schemas import DICTIONARY

# Document states.
ORDER_CANCELLED = "1003"
ORDER_REFUNDING = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_SUCCEEDED = "1602"
REFUND_PAID = "0701"
REFUND_LINE_FINISHED = "0705"

# Dictionary codes and names.
CODE_NAMES = {
    "1001": "unpaid",
    "1002": "paid",
    "1003": "cancelled",
    "1004": "finished",
    "1005": "refunding",
    "1006": "refund done",
    "1101": "alipay",
    "1102": "wechat",
    "1103": "union",
    "1201": "good",
    "1202": "so-so",
    "1203": "bad",
    "1204": "automatic",
    "1301": "bad goods",
    "1302": "wrong desc",
    "1303": "sale out",
    "1304": "size issue",
    "1305": "mistake",
    "1306": "no reason",
    "1307": "other",
    "1401": "unused",
    "1402": "in use",
    "1403": "used",
    "1501": "only money",
    "1502": "with goods",
    "2401": "query",
    "2402": "promotion",
    "2403": "recommend",
    "2404": "activity",
    "3101": "activity full reduction",
    "3102": "activity discount by quantity",
    "3103": "activity discount",
    "3201": "coupon full reduction",
    "3202": "coupon discount by quantity",
    "3203": "coupon voucher",
    "3301": "category3",
    "3302": "trademark",
    "3303": "spu",
}

# Fixed value: keyword source.
KEYWORD_SEARCH = "SEARCH"

# Control records of a change-capture bootstrap run.
BOOTSTRAP_TYPES = ("bootstrap-start", "bootstrap-complete")


def local_rows(spark: SparkSession, entries: dict[str, str]) -> DataFrame:
    """Code and name pairs as a literal relation, whose size the planner knows."""
    pairs = ", ".join(f"('{code}', '{name}')" for code, name in entries.items())
    return spark.sql(f"SELECT * FROM VALUES {pairs} AS t({', '.join(DICTIONARY.fieldNames())})")


def code_dictionary(spark: SparkSession) -> DataFrame:
    """The built-in dictionary as ``dic_code, dic_name``; production reads it with ``load_dictionary``."""
    return local_rows(spark, CODE_NAMES)
