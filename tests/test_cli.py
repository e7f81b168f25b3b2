"""The command-line jobs, chained as the original scripts are run."""

from tessera.__main__ import build_parser, run
from tessera.sources import kafka_options, read_parquet_dir


def cli(spark, *argv):
    return run(build_parser().parse_args(list(argv)), spark)


def test_jobs_end_to_end(spark, sf001, scratch):
    assert cli(spark, "publish", "--events", sf001, "--log", f"{scratch}/log") == {"published": True}
    out = cli(spark, "export", "--log", f"{scratch}/log", "--parquet", f"{scratch}/p", "--json", f"{scratch}/j",
              "--checkpoint", f"{scratch}/ck", "--available-now")
    assert out == {"finished": True}
    analysed = cli(spark, "analyse", "--parquet", f"{scratch}/p", "--json", f"{scratch}/j", "--out", f"{scratch}/a")
    assert analysed["audit"] == {"loaded": 1000, "deduplicated": 1000, "complete": 1000}
    assert analysed["null_report"] == {}
    assert cli(spark, "load-relational", "--parquet", f"{scratch}/p", "--path", f"{scratch}/rel")["rows"] == 1000
    assert cli(spark, "load-columnar", "--parquet", f"{scratch}/p", "--path", f"{scratch}/col")["rows"] == 1000
    assert cli(spark, "replay", "--log", f"{scratch}/log", "--checkpoint", f"{scratch}/rck", "--out", f"{scratch}/r") == {"finished": True}
    assert read_parquet_dir(spark, f"{scratch}/r").count() == 1000


def test_kafka_throughput_options():
    opts = kafka_options("b:1", max_offsets_per_trigger=100000, min_partitions=64)
    assert opts["maxOffsetsPerTrigger"] == "100000" and opts["minPartitions"] == "64"


def test_kafka_arguments_parse():
    args = build_parser().parse_args(
        ["export", "--kafka", "b:1", "--parquet", "p", "--json", "j", "--checkpoint", "c", "--max-offsets-per-trigger", "500", "--min-partitions", "32"]
    )
    assert (args.kafka, args.max_offsets_per_trigger, args.min_partitions, args.starting_offsets) == ("b:1", 500, 32, "latest")
    assert build_parser().parse_args(["replay", "--kafka", "b:1", "--checkpoint", "c"]).starting_offsets == "earliest"


def test_module_entry_point(scratch, sf001):
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-m", "tessera", "publish", "--events", sf001, "--log", f"{scratch}/log"],
        cwd=root,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1]) == {"published": True}
    assert any(name.endswith(".parquet") for name in os.listdir(f"{scratch}/log"))


def test_object_store_paths_need_an_endpoint(spark):
    import pytest

    from tessera.sources import configured_endpoint

    if configured_endpoint(spark):
        pytest.skip("an endpoint is configured in this session")
    with pytest.raises(ValueError):
        cli(spark, "analyse", "--parquet", "s3a://bucket/parquet", "--json", "s3a://bucket/json", "--out", "s3a://bucket/out")


def test_replay_follow_runs_until_stopped(spark, sf001, scratch):
    cli(spark, "publish", "--events", sf001, "--log", f"{scratch}/log")
    out = cli(spark, "replay", "--log", f"{scratch}/log", "--checkpoint", f"{scratch}/ck", "--out", f"{scratch}/r",
              "--follow", "--trigger", "1 second", "--run-seconds", "15")
    assert out == {"finished": False}  # still listening when the time ran out
    assert read_parquet_dir(spark, f"{scratch}/r").count() == 1000


def test_export_from_now_loads_and_dashboard(spark, sf001, scratch):
    export = ("export", "--log", f"{scratch}/log", "--parquet", f"{scratch}/p", "--json", f"{scratch}/j", "--checkpoint", f"{scratch}/ck", "--available-now", "--from-now", "--progress", f"{scratch}/progress")
    cli(spark, "publish", "--events", sf001, "--log", f"{scratch}/log")
    assert cli(spark, *export) == {"finished": True}
    cli(spark, "publish", "--events", sf001, "--log", f"{scratch}/log")
    cli(spark, *export)
    assert read_parquet_dir(spark, f"{scratch}/p").count() == 1000
    for _ in range(2):
        assert cli(spark, "load-columnar", "--parquet", f"{scratch}/p", "--path", f"{scratch}/c", "--load-id", "a")["rows"] == 1000
    assert read_parquet_dir(spark, f"{scratch}/c").count() == 1000
    table = f"cli_{scratch[-8:].replace('_', 'x').lower()}"
    assert cli(spark, "load-relational", "--parquet", f"{scratch}/p", "--path", f"{scratch}/r", "--table", table, "--catalog")["rows"] == 1000
    assert spark.table(table).count() == 1000
    shown = cli(spark, "dashboard", "--parquet", f"{scratch}/p", "--cube", f"{scratch}/cube")
    assert shown["new_files"] > 0 and sum(r["n"] for r in shown["tickets_by_team"]) == 1000
    assert cli(spark, "dashboard", "--parquet", f"{scratch}/p", "--cube", f"{scratch}/cube")["new_files"] == 0
