"""Replaying a topic from the beginning (J5: S2, P3, K9).

The whole log is read from its start; progress lives in the checkpoint, so a
second run only sees messages added since. Parsing is strict: one malformed
message fails the query (and would again on restart), which is what a replay
for inspection wants; the export job parses permissively instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.transform import parse_messages
from tessera.streaming.control import await_queries, with_trigger


def replay_stream(source: DataFrame, strict: bool = True) -> DataFrame:
    return parse_messages(source, value="value", strict=strict)


def start_replay(
    source: DataFrame,
    checkpoint_path: str,
    sink: str = "parquet",
    path: str | None = None,
    strict: bool = True,
    trigger: str | None = None,
    available_now: bool = True,
    preview_rows: int = 20,
):
    """K9: keep every arriving record in a Parquet folder, or, as a preview,
    print the first ``preview_rows`` of each micro-batch on the console."""
    parsed = replay_stream(source, strict)
    writer = parsed.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path)
    if sink == "console":
        writer = writer.format("console").option("truncate", "false").option("numRows", str(preview_rows))
    elif sink == "parquet":
        if not path:
            raise ValueError("a parquet replay needs a path")
        writer = writer.format("parquet").option("path", path)
    else:
        raise ValueError(f"unknown sink {sink!r}")
    return with_trigger(writer, trigger, available_now).start()


def run_replay(
    source: DataFrame,
    checkpoint_path: str,
    sink: str = "parquet",
    path: str | None = None,
    strict: bool = True,
    run_seconds: float | None = None,
    follow: bool = False,
    trigger: str | None = None,
) -> bool:
    """Replay what the log holds and stop, or with ``follow`` keep showing new
    messages as they arrive (until ``run_seconds``, a failure, or a stop)."""
    query = start_replay(source, checkpoint_path, sink, path, strict, trigger=trigger, available_now=not follow)
    return await_queries([query], run_seconds)
