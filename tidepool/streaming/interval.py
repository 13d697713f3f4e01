"""Long-running streams on an interval trigger, with a stop rule.

Spark's own listener tells what each trigger did; :class:`Watch` adds it up (totals only, so a
stream may run for ever) and waits until the stream has caught up or a time limit is reached::

    with Watch(spark, "raw_to_bronze", every="15 seconds") as seen:
        query = ingest_raw_to_bronze(…, trigger=seen.trigger, await_done=False)
        seen.stop_when_idle(query, triggers=4, seconds=3600)
    print(seen.batches, seen.rows)
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Least time between two reports of an idle stream (Spark's default is 10 seconds).
IDLE_REPORTS = "spark.sql.streaming.noDataProgressEventInterval"


class _Listener(StreamingQueryListener):
    def __init__(self, seen: Watch):
        self.seen = seen

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.seen.query_name:
            self.seen._add(p.batchId, p.numInputRows)

    def onQueryIdle(self, event) -> None:
        self.seen._idle(str(event.runId))

    def onQueryTerminated(self, event) -> None:
        self.seen._changed.set()


class Watch:
    """What one named stream has done so far: ``batches`` with rows, ``rows``, the last ``batch_id``,
    and ``idle`` triggers in a row that found nothing new."""

    def __init__(self, spark: SparkSession, query_name: str, every: str = "15 seconds", idle_report_ms: int = 200):
        self.spark, self.query_name, self.trigger = spark, query_name, {"processingTime": every}
        self.batches = self.rows = self.idle = 0
        self.batch_id: int | None = None
        self.stopped_by: str | None = None
        self._run_id: str | None = None
        self._changed, self._lock, self._listener = threading.Event(), threading.Lock(), _Listener(self)
        self._idle_report_ms, self._before = idle_report_ms, None

    def __enter__(self) -> Watch:
        # A stream takes the setting along when it starts; the session's own value comes back on exit.
        self._before = self.spark.conf.get(IDLE_REPORTS, None)
        self.spark.conf.set(IDLE_REPORTS, str(self._idle_report_ms))
        self.spark.streams.addListener(self._listener)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self._listener)
        if self._before is None:
            self.spark.conf.unset(IDLE_REPORTS)
        else:
            self.spark.conf.set(IDLE_REPORTS, self._before)

    def _add(self, batch_id: int, rows: int) -> None:
        with self._lock:
            if rows and (self.batch_id is None or batch_id > self.batch_id):
                self.batches, self.rows, self.batch_id, self.idle = self.batches + 1, self.rows + rows, batch_id, 0
        self._changed.set()

    def _idle(self, run_id: str) -> None:
        with self._lock:
            if run_id == self._run_id:
                self.idle += 1
        self._changed.set()

    def stop_when_idle(self, query: StreamingQuery, triggers: int = 1, seconds: float | None = None) -> Watch:
        """Wait until ``triggers`` reports in a row find the stream idle, or ``seconds`` are over, then
        stop it. A batch cut off by the time limit is done again by the next run."""
        self._run_id = str(query.runId)
        end = None if seconds is None else time.monotonic() + seconds
        while query.isActive and self.stopped_by is None:
            left = None if end is None else end - time.monotonic()
            if self.idle >= triggers:
                self.stopped_by = "idle"
            elif left is not None and left <= 0:
                self.stopped_by = "time"
            else:
                self._changed.wait(min(1.0, left) if left is not None else 1.0)
                self._changed.clear()
        if query.exception() is not None:
            raise RuntimeError(f"stream {self.query_name} failed: {query.exception()}")
        query.stop()
        return self
