"""Time columns: epoch numbers, texts and the zone rules of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


def from_millis(ts) -> Column:
    """Epoch milliseconds (click log) as a timestamp."""
    return F.timestamp_millis(F.col(ts) if isinstance(ts, str) else ts)


def from_millis_to_second(ts) -> Column:
    """Epoch milliseconds as a timestamp cut to whole seconds (event time of the keyword report)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_seconds(F.floor(ts / F.lit(1000)).cast("bigint"))


def from_second_text(ts) -> Column:
    """Epoch seconds as text (change log) as a timestamp; unreadable text gives null."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_seconds(ts.try_cast("bigint"))


def date_text(ts) -> Column:
    """Timestamp as ``yyyy-MM-dd`` in the session zone."""
    return F.date_format(ts, DATE)


def date_time_text(ts) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` in the session zone."""
    return F.date_format(ts, DATE_TIME)


def date_of_text(text) -> Column:
    """Date part of a date-time text, null where it cannot be read."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("date").cast("string")


def text_to_millis(text, zone: str = "+08:00", full: bool = False) -> Column:
    """Date text (``full``: date-time text) as epoch milliseconds, read in a fixed zone whatever the session zone is."""
    text = F.col(text) if isinstance(text, str) else text
    stamp = text if full else F.concat(text, F.lit(" 00:00:00"))
    return F.unix_millis(F.try_to_timestamp(F.concat(stamp, F.lit(f" {zone}")), F.lit(f"{DATE_TIME} VV")))


def operation_time(text) -> Column:
    """``2022-08-27 01:39:17.93Z`` as a timestamp; fractions of any length compare by value."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("timestamp")


def now_millis() -> Column:
    """Wall clock of the query or micro-batch in epoch milliseconds."""
    return F.unix_millis(F.current_timestamp())
