"""Triggers and waiting."""

from __future__ import annotations

import time

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def with_trigger(writer: DataStreamWriter, trigger: str | None = "15 seconds", available_now: bool = False) -> DataStreamWriter:
    """Micro-batch every ``trigger``; or process what is there and stop."""
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def await_queries(queries, run_seconds: float | None = None, poll_seconds: float = 0.5, watch=None) -> bool:
    """T4 + T5: wait on all ``queries``; the failure of any one stops the
    others and is raised.

    With ``run_seconds`` every query is stopped once that time has passed and
    False is returned; True means every query ended by itself (for example an
    ``availableNow`` run that consumed its input). ``watch`` is called at
    every poll while queries run.
    """
    queries = list(queries)
    deadline = None if run_seconds is None else time.monotonic() + run_seconds
    try:
        while True:
            # First who still runs, then who failed: a query that ends between
            # the two lines is seen as running and its failure in this round
            # or the next, never missed.
            running = [q for q in queries if q.isActive]
            _raise_first_failure(queries)
            if not running:
                return True
            if deadline is not None and time.monotonic() >= deadline:
                return False
            if watch is not None:
                watch()
            running[0].awaitTermination(poll_seconds)
    except BaseException:
        stop_all(queries)
        raise
    finally:
        if deadline is not None:
            stop_all(queries)


def stop_all(queries) -> None:
    for q in queries:
        if q.isActive:
            q.stop()


def _raise_first_failure(queries) -> None:
    for q in queries:
        if not q.isActive:
            exc = q.exception()
            if exc is not None:
                raise exc


__all__ = ["StreamingQuery", "await_queries", "stop_all", "with_trigger"]
