"""Click-log records to page, start, display, action and error records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Topics the split records are published to.
TOPICS = {
    "page": "dwd_traffic_page_log",
    "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log",
    "action": "dwd_traffic_action_log",
    "err": "dwd_traffic_err_log",
    "dirty": "dirty_data",
}


def _kept(records: DataFrame) -> list[str]:
    return [c for c in records.columns if c == "log_id"]


def error_records(records: DataFrame) -> DataFrame:
    """Whole records that carry an error; they also go on as start or page records."""
    return records.where("err IS NOT NULL")


def start_records(records: DataFrame) -> DataFrame:
    """Application starts, without their error part."""
    return records.where("start IS NOT NULL").drop("err")


def page_records(records: DataFrame) -> DataFrame:
    """Everything that is no start, without the error, display and action parts."""
    return records.where("start IS NULL").drop("err", "start", "displays", "actions")


def display_records(records: DataFrame) -> DataFrame:
    """One record per displayed item, with the device, page and time it was shown."""
    return records.where("start IS NULL").select(
        *_kept(records), "common", "page", F.explode("displays").alias("display"), "ts"
    )


def action_records(records: DataFrame) -> DataFrame:
    """One record per action, with the device and page; the time is the action's own."""
    return records.where("start IS NULL").select(*_kept(records), "common", "page", F.explode("actions").alias("action"))


def topic_rows(records: DataFrame) -> DataFrame:
    """All outputs at once as ``topic, value`` (JSON text), in one narrow pass and one write.

    A sink that takes the topic per row, such as Kafka, or a write partitioned by ``topic``, needs no second read.
    """
    data = [c for c in records.columns if c != "log_id"]

    def text(*without: str) -> Column:
        return F.to_json(F.struct(*[c for c in data if c not in without]))

    def rows(topic: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(TOPICS[topic]).alias("topic"), v.alias("value")))

    nothing = F.array().cast("array<string>")
    on_page = F.col("start").isNull()
    shown = F.transform(
        "displays", lambda d: F.to_json(F.struct("common", "page", d.alias("display"), "ts"))
    )
    done = F.transform("actions", lambda a: F.to_json(F.struct("common", "page", a.alias("action"))))
    outputs = F.concat(
        rows("err", F.when(F.col("err").isNotNull(), F.array(text())).otherwise(nothing)),
        rows("start", F.when(~on_page, F.array(text("err"))).otherwise(nothing)),
        rows("display", F.when(on_page, F.coalesce(shown, nothing)).otherwise(nothing)),
        rows("action", F.when(on_page, F.coalesce(done, nothing)).otherwise(nothing)),
        rows("page", F.when(on_page, F.array(text("err", "start", "displays", "actions"))).otherwise(nothing)),
    )
    return records.select(F.inline(outputs))
