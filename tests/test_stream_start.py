"""Where an export begins (S1), and its progress table."""

import glob

import pytest
from pyspark.sql import functions as F

from tessera.plans import fixtures as fx
from tessera.sources import read_json_dir, read_message_log, read_parquet_dir
from tessera.streaming import await_queries, enriched_stream, run_export, start_export, stop_all
from tessera.streaming.progress import read_progress, recorded_progress, rows_by_query
from tessera.streaming.publish import publish_tickets
from tessera.streaming.start import _note, start_at_now, start_position


@pytest.fixture
def log(spark, sf001, scratch):
    path = f"{scratch}/log"
    publish_tickets(fx.tickets(spark, sf001), log_path=path)
    return path


def lot(spark, sf001, log, low, high):
    publish_tickets(fx.tickets(spark, sf001).where(f"ticket_id >= 'T{low:010d}' AND ticket_id < 'T{high:010d}'"), log_path=log)


@pytest.mark.parametrize("mode", ["dual", "foreach_batch"])
def test_only_what_comes_after_the_first_start(spark, sf001, scratch, log, mode):
    args = (f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck")
    run_export(read_message_log(spark, log, max_files_per_trigger=1), *args, mode=mode, available_now=True, starting="latest")
    lot(spark, sf001, log, 100, 130)
    run_export(read_message_log(spark, log), *args, mode=mode, available_now=True, starting="latest")
    lot(spark, sf001, log, 200, 220)
    run_export(read_message_log(spark, log), *args, mode=mode, available_now=True, starting="latest")
    for df in (read_parquet_dir(spark, f"{scratch}/p"), read_json_dir(spark, f"{scratch}/j")):
        assert sorted(int(r.ticket_id[1:]) for r in df.collect()) == [*range(100, 130), *range(200, 220)]


def test_the_backlog_is_not_opened(spark, sf001, scratch, log):
    """A file that no reader could open lies on the log before the first start."""
    with open(f"{log}/part-broken.parquet", "w") as fh:
        fh.write("no parquet at all")
    args = (f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck")
    run_export(read_message_log(spark, log), *args, available_now=True, starting="latest")
    lot(spark, sf001, log, 5, 9)
    run_export(read_message_log(spark, log), *args, available_now=True, starting="latest")
    assert read_parquet_dir(spark, f"{scratch}/p").count() == 4


def test_many_batches_after_the_start(spark, sf001, scratch, log):
    """The sink's commit log holds the batches of the start too, so it can be compacted."""
    args = (f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck")
    run_export(read_message_log(spark, log), *args, available_now=True, starting="latest")
    for i in range(12):
        lot(spark, sf001, log, 10 * i, 10 * i + 1)
    run_export(read_message_log(spark, log, max_files_per_trigger=1), *args, available_now=True, starting="latest")
    assert glob.glob(f"{scratch}/p/_spark_metadata/*.compact")
    assert read_parquet_dir(spark, f"{scratch}/p").count() == 12


def test_a_start_that_failed_half_way_is_taken_again(spark, sf001, scratch, log):
    args = (f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck")
    _note(spark, f"{scratch}/ck", "taking")  # the driver died before or while the position was taken
    assert start_position(spark, f"{scratch}/ck") == "taking"
    run_export(read_message_log(spark, log), *args, mode="foreach_batch", available_now=True, starting="latest")
    assert start_position(spark, f"{scratch}/ck") == "taken"
    lot(spark, sf001, log, 1, 3)
    run_export(read_message_log(spark, log), *args, mode="foreach_batch", available_now=True, starting="latest")
    assert read_json_dir(spark, f"{scratch}/j").count() == 2


def test_a_checkpoint_with_progress_keeps_it(spark, sf001, scratch, log):
    args = (f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck")
    run_export(read_message_log(spark, log), *args, available_now=True)
    lot(spark, sf001, log, 1, 11)
    run_export(read_message_log(spark, log), *args, available_now=True, starting="latest")  # goes on, skips nothing
    assert read_parquet_dir(spark, f"{scratch}/p").count() == 1010
    assert start_position(spark, f"{scratch}/ck") is None
    with pytest.raises(ValueError):
        start_export(enriched_stream(read_message_log(spark, log)), *args, starting="latest")
    assert start_at_now(read_message_log(spark, log), f"{scratch}/ck", lambda rows: pytest.fail("no start")) is False


def test_unknown_start(spark, scratch, log):
    with pytest.raises(ValueError):
        run_export(read_message_log(spark, log), f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck", starting="yesterday")


def test_progress_of_a_long_running_export(spark, sf001, scratch, log):
    with recorded_progress(spark, f"{scratch}/progress", flush_seconds=0.0) as progress:
        queries = start_export(enriched_stream(read_message_log(spark, log)), f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck", trigger="1 second")
        watch = progress.watch(queries)
        for q in queries:
            q.processAllAvailable()
        lot(spark, sf001, log, 0, 50)
        for q in queries:
            q.processAllAvailable()
        watch()
        assert await_queries(queries, run_seconds=1, watch=watch) is False
        stop_all(queries)
    rows = rows_by_query(read_progress(spark, f"{scratch}/progress")).collect()
    assert sorted(r.input_rows for r in rows) == [1050, 1050] and all(r.batches >= 2 and r.error is None for r in rows)
    every = read_progress(spark, f"{scratch}/progress")
    assert every.where("event = 'terminated'").count() == 2
    assert every.where("event = 'progress' AND duration_ms IS NULL").count() == 0


def test_a_failing_sink_is_noticed_and_recorded(spark, scratch, log):
    spark.createDataFrame([(None, bytearray(b"not json"))], "key binary, value binary").write.mode("append").parquet(log)
    with pytest.raises(Exception, match="(?i)malformed"):
        with recorded_progress(spark, f"{scratch}/progress") as progress:
            queries = start_export(enriched_stream(read_message_log(spark, log), strict=True), f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck", trigger="1 second")
            await_queries(queries, watch=progress.watch(queries))
    rows = rows_by_query(read_progress(spark, f"{scratch}/progress")).collect()
    assert any("MALFORMED" in (r.error or "").upper() for r in rows)


def test_export_with_a_progress_path(spark, scratch, log):
    run_export(read_message_log(spark, log), f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck", available_now=True, progress_path=f"{scratch}/progress")
    assert read_progress(spark, f"{scratch}/progress").agg(F.sum("input_rows")).first()[0] == 2000
