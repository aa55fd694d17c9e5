"""Jobs on their topics: what each one reads, and how its result is written.

``read`` turns a topic name into a stream of ``log_id, value`` text. With Kafka that is
``lambda topic: read_topic(spark, servers, topic)``; a folder of JSON lines serves as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.operators.trade import DimensionChain
from millrace.operators.windows import stamped
from millrace.plans import programs
from millrace.plans.programs import JOBS
from millrace.sinks.changelog import BatchWriter
from millrace.sinks.reports import COMMIT_INTERVAL, start_stream, topic_frame
from millrace.sources.click_log import page_columns
from millrace.sources.kafka import as_records
from millrace.streaming.visits import DAY_MILLIS

Read = Callable[[str], DataFrame]

# Topics the jobs read.
CLICKS = "topic_log"
CHANGES = "topic_db"
PAGES = "dwd_traffic_page_log"

PAGE_ROW = T.StructType(
    schemas.strings("mid", "uid", "is_new", "vc", "ch", "ar", "page_id", "last_page_id", "item", "item_type")
    + [T.StructField("during_time", T.LongType()), T.StructField("ts", T.TimestampType())]
)


def _pages(read: Read) -> DataFrame:
    return page_columns(as_records(read(PAGES), schemas.CLICK_LOG))


def _changes(read: Read) -> DataFrame:
    return as_records(read(CHANGES), schemas.CHANGE_LOG).drop("log_id")


def _facts(read: Read, job: str, schema: T.StructType) -> DataFrame:
    return as_records(read(JOBS[job].target), schema)


def job_frame(
    name: str,
    read: Read,
    dictionary: DataFrame | None = None,
    sku: DataFrame | None = None,
    continuous: bool = True,
    chain: DimensionChain | None = None,
) -> DataFrame:
    """The result of job ``name`` over its topics. Fact jobs need ``dictionary``, the product report ``sku`` and ``chain``.

    ``continuous``: the stream stays up, so state may expire in processing time.
    """
    if name == "newest_lines":
        return programs.newest_lines(_facts(read, "order_detail", schemas.ORDER_DETAIL_RECORD))
    run = JOBS[name].run
    if name == "log_split":
        return run(read(CLICKS))
    if name == "unique_visitor":
        return run(_pages(read), DAY_MILLIS if continuous else None)
    if name in ("user_jump", "keyword_window", "home_detail_window", "login_window"):
        return run(_pages(read))
    if name in ("cart_add", "order_pre_process", "order_refund", "refund_pay"):
        return run(_changes(read), dictionary)
    if name in ("order_detail", "cancel_detail"):
        return run(_facts(read, "order_pre_process", schemas.ORDER_PRE_PROCESS_RECORD).drop("log_id"))
    if name == "pay_detail":
        orders = _facts(read, "order_detail", schemas.ORDER_DETAIL_RECORD).drop("log_id")
        return run(_changes(read), orders, dictionary)
    if name == "traffic_window":
        return run(_pages(read), _facts(read, "unique_visitor", PAGE_ROW), _facts(read, "user_jump", PAGE_ROW))
    if name == "cart_add_window":
        return run(_facts(read, "cart_add", schemas.CART_ADD_RECORD).drop("log_id"))
    if name == "sku_order_window":
        return run(as_records(read(NEWEST_LINES), schemas.ORDER_DETAIL_RECORD).drop("log_id"), sku, chain)
    if name == "dim":  # routed and stored per micro-batch, see start_job
        return as_records(read(CHANGES), schemas.CHANGE_LOG)
    raise ValueError(f"no job named {name!r}")


# The version filter of the product report runs on processing time, so it is a stream before it.
NEWEST_LINES = "dwd_trade_order_detail_newest"


def output_frame(name: str, result: DataFrame) -> DataFrame:
    """The result in the form it is written: topic rows for details and facts, stamped columns for reports."""
    if name == "log_split":
        return topic_frame(result)
    if name == "newest_lines":
        return topic_frame(result.drop("log_id"), NEWEST_LINES, ["id"])
    if name == "dim":
        return result
    job = JOBS[name]
    if job.target.startswith("dwd_"):
        return topic_frame(result, job.target, job.keys)
    report = stamped(result)
    if absent := [c for c in job.columns if c not in report.columns]:
        raise ValueError(f"the report of {name!r} lacks its columns {absent}")
    return report.select(*job.columns)


def start_job(
    name: str,
    read: Read,
    write: BatchWriter,
    checkpoint_root: str,
    dictionary: DataFrame | None = None,
    sku: DataFrame | None = None,
    interval: str | None = COMMIT_INTERVAL,
    chain: DimensionChain | None = None,
) -> StreamingQuery:
    """Run a job continuously; ``write`` gets each micro-batch of ``output_frame``. Restarts resume from the checkpoint.

    The dimension job's ``write`` is ``sinks.dims.route_and_store``, which gets the change log itself.
    """
    result = output_frame(name, job_frame(name, read, dictionary, sku, interval is not None, chain))
    return start_stream(result, f"{checkpoint_root.rstrip('/')}/{name}", write, interval=interval)
