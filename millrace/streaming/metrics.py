"""Rows that a stream took in, and rows it left out because they came behind the watermark.

``counted_in`` observes the rows before a keyed-state operator. Spark reports, with every micro-batch, what was observed and how many rows each stateful operator
dropped as late; ``RowCounts`` adds both up per query. Operators that aggregate before their state drop groups, not rows; for rows, put keyed state first (as ``mark_new_orders`` does)
or compare the rows observed with the count column of the report.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

ROWS_IN = "rows_in"


def counted_in(df: DataFrame, name: str = ROWS_IN) -> DataFrame:
    """The same rows, with their number reported under ``name`` for every micro-batch."""
    return df.observe(name, F.count(F.lit(1)).alias("n"))


class RowCounts(StreamingQueryListener):
    """Sums per query id: ``taken[id][name]`` of observed rows, ``late[id]`` of rows dropped behind the watermark.

    A micro-batch that is repeated after a restart is counted once: reports are kept by number of the micro-batch.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._batches: dict[str, dict[int, tuple[dict[str, int], int]]] = defaultdict(dict)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        taken = {name: row["n"] for name, row in progress.observedMetrics.items()}
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        with self._lock:
            batches = self._batches[str(progress.id)]
            before = batches.get(progress.batchId, ({}, 0))
            # idle reports of a micro-batch come without figures
            batches[progress.batchId] = (before[0] | taken, max(before[1], late))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def taken(self, query_id, name: str = ROWS_IN) -> int:
        with self._lock:
            return sum(taken.get(name, 0) for taken, _ in self._batches[str(query_id)].values())

    def late(self, query_id) -> int:
        with self._lock:
            return sum(late for _, late in self._batches[str(query_id)].values())


def watch(spark: SparkSession) -> RowCounts:
    """Starts counting for all queries of the session; ``spark.streams.removeListener`` ends it."""
    counts = RowCounts()
    spark.streams.addListener(counts)
    return counts
