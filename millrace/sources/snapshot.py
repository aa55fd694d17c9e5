"""A table read in chunks while it changes, and its change log, put together without a gap.

Each chunk of the table is read between two places of the log: a low mark taken before and a high mark taken after. What was read shows the chunk at some place
in between, not known which. So changes up to the low mark are in the chunk already and fall; a row with a change between the marks falls in favour of that change, which
may be newer or older than what was read; all later changes follow. Nothing is locked, chunks can be read in any order and at the same time, and a chunk that failed is
read again with new marks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.changelog import latest_by_key

READ = "r"


def cut_over(rows: DataFrame, log: DataFrame, marks: DataFrame, keys: Sequence[str], place: str = "seq", op: str = "op", chunk: str = "chunk") -> DataFrame:
    """Change records without gap or overlap: the columns of ``log``.

    ``rows`` are the chunks as read, with the columns of the log but ``op`` and ``place``. ``log`` holds at least all changes since the lowest mark; ``marks`` has ``low`` and ``high`` per ``chunk``. Rows
    and log carry the chunk of their key, also for keys the table did not have when it was read. A row read counts at the low mark of its chunk, with ``READ`` as its op.
    Changes of chunks without marks are those of chunks not yet read and fall: the chunk will show them.
    """
    columns = log.columns
    marked = log.join(marks.select(chunk, F.col("low").alias("_low"), F.col("high").alias("_high")), chunk).where(F.col(place) > F.col("_low"))
    # one row per key that the log has overtaken
    overtaken = marked.where(F.col(place) <= F.col("_high")).select(*keys).distinct()
    read = rows.join(marks.select(chunk, F.col("low").alias(place)), chunk).join(overtaken, list(keys), "left_anti").withColumn(op, F.lit(READ))
    return read.select(columns).unionByName(marked.select(columns))


def current_rows(changes: DataFrame, keys: Sequence[str], place: str = "seq", op: str = "op", deleted: str = "d") -> DataFrame:
    """The table that the change records end in."""
    return latest_by_key(changes, list(keys), place).where(F.col(op) != deleted).drop(op, place)
