"""Progress of long-running exports as a table.

A ``StreamingQueryListener`` takes down every micro-batch of the watched
queries, and how each query ended. Listener events arrive on Spark's listener
thread, where no job may run; they are kept in memory and written out by the
thread that waits on the queries: every ``flush_seconds``, and at the end. A
row is written once; the rows in memory are bounded by the micro-batches of
that span.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

#: One row for each micro-batch (``progress``) and for each end of a query (``terminated``, with its error if it failed).
PROGRESS_SCHEMA = (
    "event string, query_id string, run_id string, name string, sink string, batch_id bigint, at string, "
    "input_rows bigint, input_rows_per_second double, processed_rows_per_second double, duration_ms bigint, error string"
)


class ProgressLog(StreamingQueryListener):
    """Collects progress events; ``flush`` adds them to the table."""

    def __init__(self, spark: SparkSession, path: str, flush_seconds: float = 30.0):
        self.spark, self.path, self.flush_seconds = spark, path, flush_seconds
        self._lock = threading.Lock()
        self._rows: list[dict] = []
        self._ended: set[str] = set()
        self._flushed = time.monotonic()

    def _add(self, row: dict) -> None:
        with self._lock:
            self._rows.append(row)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        figures = {"input_rows": p.numInputRows, "input_rows_per_second": _number(p.inputRowsPerSecond), "processed_rows_per_second": _number(p.processedRowsPerSecond)}
        self._add({"event": "progress", "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "sink": p.sink.description, "batch_id": p.batchId, "at": p.timestamp, "duration_ms": p.durationMs.get("triggerExecution"), **figures})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add({"event": "terminated", "query_id": str(event.id), "run_id": str(event.runId), "error": event.exception})
        with self._lock:
            self._ended.add(str(event.runId))

    def flush(self) -> int:
        """Add the events so far to the table; returns how many rows."""
        with self._lock:
            rows, self._rows = self._rows, []
        self._flushed = time.monotonic()
        if rows:
            lines = F.array(*[F.lit(json.dumps(r, ensure_ascii=False)) for r in rows])
            parsed = self.spark.range(1, numPartitions=1).select(F.explode(lines).alias("line")).select(F.from_json("line", PROGRESS_SCHEMA).alias("row"))
            try:
                parsed.select("row.*").write.mode("append").parquet(self.path)
            except BaseException:
                with self._lock:
                    self._rows = rows + self._rows  # for the next try
                raise
        return len(rows)

    def watch(self, queries) -> Callable[[], None]:
        """What ``await_queries`` calls while it waits."""
        self._runs = [str(q.runId) for q in queries]

        def step() -> None:
            if time.monotonic() - self._flushed >= self.flush_seconds:
                self.flush()

        return step

    def wait_for_ends(self, seconds: float = 30.0) -> None:
        """Events come late: wait until the end of every watched query was told."""
        deadline = time.monotonic() + seconds
        while time.monotonic() < deadline:
            with self._lock:
                if set(getattr(self, "_runs", [])) <= self._ended:
                    return
            time.sleep(0.1)


class _NoProgress:
    def watch(self, queries) -> None:
        return None


def _number(x) -> float | None:
    return None if x is None or x != x or x in (float("inf"), float("-inf")) else float(x)


@contextmanager
def recorded_progress(spark: SparkSession, path: str | None, flush_seconds: float = 30.0) -> Iterator[ProgressLog | _NoProgress]:
    """Record progress to ``path`` for the time of the block (nothing without a path)."""
    if not path:
        yield _NoProgress()
        return
    log = ProgressLog(spark, path, flush_seconds)
    spark.streams.addListener(log)
    try:
        yield log
        log.wait_for_ends()
    except BaseException:
        log.wait_for_ends()  # a failure is part of the progress
        raise
    finally:
        spark.streams.removeListener(log)
        log.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)


def rows_by_query(progress: DataFrame) -> DataFrame:
    """Batches, input rows and errors of each run of a query."""
    return progress.groupBy("query_id", "run_id").agg(
        F.max("name").alias("name"),
        F.max("sink").alias("sink"),
        F.count_if(F.col("event") == "progress").alias("batches"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.max("error").alias("error"),
    )
