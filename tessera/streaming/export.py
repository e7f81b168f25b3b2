"""The stream export job (J1): messages -> parsed, routed tickets -> Parquet + JSON.

The transformation is a stateless projection (append mode, no event time), so
each micro-batch is map-only: no shuffle and no state store.

Two fan-out modes (K3):

``dual``           two independent queries, one per format, each with its own
                   checkpoint (the JSON one adds ``_json``); the source is read
                   twice and the two outputs may start at different offsets.
``foreach_batch``  one query reads each micro-batch once and writes both
                   formats. File writes inside ``foreachBatch`` are
                   at-least-once, so every batch goes to a folder of its own,
                   ``query=ID/batch_id=N``, with overwrite: a batch replayed
                   after a failure replaces its own earlier output, never
                   duplicates. The id is the streaming query's, kept in its
                   checkpoint: an export with a new checkpoint, whose batches
                   count from 0 again, adds to the older output.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.transform import enrich_messages
from tessera.session import run_concurrently
from tessera.streaming.control import await_queries, with_trigger
from tessera.streaming.progress import recorded_progress
from tessera.streaming.start import EARLIEST, LATEST, start_at_now, without_messages


def enriched_stream(source: DataFrame, strict: bool = False) -> DataFrame:
    """P1, P2, P4, P5 on a message stream (or a batch table of messages)."""
    return enrich_messages(source, value="value", strict=strict)


def _file_query(df: DataFrame, fmt: str, path: str, checkpoint: str, trigger, available_now: bool, name: str | None):
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return with_trigger(writer, trigger, available_now).start()


def checkpoint_query_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The streaming query's id, which lives in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint_path.rstrip('/')}/metadata").first()[0])["id"]


def write_batch_both(batch: DataFrame, batch_id: int, parquet_path: str, json_path: str, files_per_batch: int | None = None, query_id: str | None = None) -> None:
    """One micro-batch to both formats, idempotently (see module doc). The
    batch is parsed once, at full parallelism, into the cache; the two writes
    read the cached batch and run side by side.

    ``files_per_batch`` bounds the files each format gets per batch (against
    many small files on object stores): only the writes are narrowed.
    """
    folder = f"batch_id={batch_id}" if query_id is None else f"query={query_id}/batch_id={batch_id}"
    batch.persist()
    try:
        batch.count()
        out = batch.coalesce(files_per_batch) if files_per_batch else batch
        run_concurrently(
            batch.sparkSession,
            {
                "parquet": lambda: out.write.mode("overwrite").parquet(f"{parquet_path}/{folder}"),
                "json": lambda: out.write.mode("overwrite").json(f"{json_path}/{folder}"),
            },
        )
    finally:
        batch.unpersist()


def start_export(
    enriched: DataFrame,
    parquet_path: str,
    json_path: str,
    checkpoint_path: str,
    mode: str = "dual",
    trigger: str | None = "15 seconds",
    available_now: bool = False,
    name: str | None = None,
    files_per_batch: int | None = None,
    starting: str = EARLIEST,
    backlog: DataFrame | None = None,
) -> list:
    """Start the export queries (K1, K2, K3, T1-T3); returns them.

    ``starting="latest"`` (S1, for folder-backed logs) exports only messages
    that come after the first start, see ``streaming.start``; ``backlog`` is
    then the same stream ``without_messages``. In ``dual`` mode
    each query takes its own position, as it keeps its own checkpoint.

    ``files_per_batch`` applies to ``foreach_batch`` mode (see
    ``write_batch_both``); in ``dual`` mode each task writes its own file.
    """
    if starting not in (EARLIEST, LATEST):
        raise ValueError(f"unknown start position {starting!r}")
    if starting == LATEST and backlog is None:
        raise ValueError("a start at the latest message needs the stream without messages (see streaming.start)")
    if mode == "dual":
        if starting == LATEST:
            for fmt, path, checkpoint in (("parquet", parquet_path, checkpoint_path), ("json", json_path, checkpoint_path + "_json")):
                # Through the sink itself: its commit log must hold every batch of the checkpoint.
                start_at_now(backlog, checkpoint, lambda rows, to=(fmt, path, checkpoint): await_queries([_file_query(rows, *to, None, True, None)]))
        first = _file_query(enriched, "parquet", parquet_path, checkpoint_path, trigger, available_now, name and f"{name}_parquet")
        try:
            second = _file_query(enriched, "json", json_path, checkpoint_path + "_json", trigger, available_now, name and f"{name}_json")
        except BaseException:
            first.stop()  # never leave half of the fan-out running
            raise
        return [first, second]
    if mode == "foreach_batch":
        if starting == LATEST:
            nothing = lambda rows: rows.writeStream.foreachBatch(lambda batch, batch_id: None).option("checkpointLocation", checkpoint_path)
            start_at_now(backlog, checkpoint_path, lambda rows: await_queries([with_trigger(nothing(rows), None, True).start()]))

        ids: list[str] = []

        def sink(batch: DataFrame, batch_id: int) -> None:
            if not ids:
                ids.append(checkpoint_query_id(batch.sparkSession, checkpoint_path))
            write_batch_both(batch, batch_id, parquet_path, json_path, files_per_batch, ids[0])

        writer = enriched.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path)
        if name:
            writer = writer.queryName(name)
        return [with_trigger(writer, trigger, available_now).start()]
    raise ValueError(f"unknown export mode {mode!r}")


def run_export(
    source: DataFrame,
    parquet_path: str,
    json_path: str,
    checkpoint_path: str,
    mode: str = "dual",
    trigger: str | None = "15 seconds",
    available_now: bool = False,
    run_seconds: float | None = None,
    files_per_batch: int | None = None,
    starting: str = EARLIEST,
    progress_path: str | None = None,
) -> bool:
    """J1 end to end: start, then wait until the queries end, fail or time out.

    Restarting with the same ``checkpoint_path`` continues where the last run
    stopped (T6). With ``progress_path`` every micro-batch's progress is added
    to a table there, while the export runs (see ``streaming.progress``).
    """
    with recorded_progress(source.sparkSession, progress_path) as progress:
        queries = start_export(
            enriched_stream(source),
            parquet_path,
            json_path,
            checkpoint_path,
            mode,
            trigger,
            available_now,
            files_per_batch=files_per_batch,
            starting=starting,
            backlog=enriched_stream(without_messages(source)) if starting == LATEST else None,
        )
        return await_queries(queries, run_seconds, watch=progress.watch(queries))
