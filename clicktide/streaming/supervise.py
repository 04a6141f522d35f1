"""Running several streaming queries in one application."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def await_all(queries: list[StreamingQuery], poll_seconds: int = 5) -> None:
    """Wait for the queries of one job; when one fails, stop the others and raise its error."""
    waiting = list(queries)
    try:
        while waiting:
            # awaitTermination raises the query's error and returns True once it has ended.
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds)]
    except Exception:
        for query in queries:
            if query.isActive:
                query.stop()
        raise


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows that the query's recent micro-batches dropped behind the watermark; see LateRows for a whole run."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Adds up the rows dropped behind the watermark over whole runs, however many micro-batches they have."""

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._news = threading.Condition()

    @classmethod
    def watching(cls, spark: SparkSession) -> LateRows:
        """Watch the session's queries that start from now on."""
        listener = cls()
        spark.streams.addListener(listener)
        return listener

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        with self._news:
            self._dropped[str(event.progress.runId)] += dropped

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def total(self, query: StreamingQuery, wait_seconds: float = 30) -> int:
        """Rows this run of a query has dropped so far; of an ended run, once its last report has come in."""
        run = str(query.runId)
        with self._news:
            if not query.isActive and not self._news.wait_for(lambda: run in self._ended, wait_seconds):
                raise TimeoutError(f"no end of run {run} was reported in {wait_seconds} seconds")
            return self._dropped[run]
