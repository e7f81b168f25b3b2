"""File sources and sinks (S3-S6, O4, K4, K5; semantics D12-D14, D18)."""

import glob
import os
import shutil

import pytest

from tessera.operators import distribution_summary, union_by_name
from tessera.plans import fixtures as fx
from tessera.schemas import ENRICHED_FIELDS, ENRICHED_SCHEMA
from tessera.sinks import read_csv, write_csv, write_json, write_parquet, write_summary_text
from tessera.sources import NoDataError, list_data_files, load_exports, load_parquet_exports, read_json_dir, read_parquet_dir
from tessera.sources.files import json_rejects

SCHEMA7 = ", ".join(f"{c} string" for c in ENRICHED_FIELDS)


def rows_of(df):
    return sorted(map(tuple, df.select(*ENRICHED_FIELDS).collect()), key=str)


def test_parquet_and_json_roundtrip(spark, sf001, scratch):
    routed = fx.routed_tickets(spark, sf001)
    write_parquet(routed, f"{scratch}/p")
    write_json(routed, f"{scratch}/j")
    assert rows_of(read_parquet_dir(spark, f"{scratch}/p")) == rows_of(routed)
    assert rows_of(read_json_dir(spark, f"{scratch}/j")) == rows_of(routed)


def test_json_keeps_text_and_restores_null_columns(spark, scratch):
    df = spark.createDataFrame([("00123", None, "2024-01-01T00:00:00")], "ticket_id string, request string, created_at string")
    write_json(df, f"{scratch}/j")  # the writer leaves the all-null column out
    back = read_json_dir(spark, f"{scratch}/j").first()
    assert back.ticket_id == "00123"  # D12: no number guessing
    assert back.created_at == "2024-01-01T00:00:00"
    assert back.request is None and "assigned_team" in read_json_dir(spark, f"{scratch}/j").columns  # D13


def test_merge_schema_union_of_columns(spark, scratch):
    spark.createDataFrame([("a", "x")], "ticket_id string, request string").write.parquet(f"{scratch}/d/part1")
    spark.createDataFrame([("b", "t")], "ticket_id string, assigned_team string").write.parquet(f"{scratch}/d/part2")
    df = read_parquet_dir(spark, [f"{scratch}/d/part1", f"{scratch}/d/part2"])
    assert set(df.columns) == {"ticket_id", "request", "assigned_team"}  # D18
    got = {r.ticket_id: (r.request, r.assigned_team) for r in df.collect()}
    assert got == {"a": ("x", None), "b": (None, "t")}


def test_union_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "ticket_id string, request string")
    b = spark.createDataFrame([("y", "2")], "request string, ticket_id string")
    c = spark.createDataFrame([("3",)], "ticket_id string")
    got = sorted(map(tuple, union_by_name([a, b, c]).collect()), key=str)
    assert got == [("1", "x"), ("2", "y"), ("3", None)]


def test_csv_roundtrip_edge_cases(spark, scratch):
    rows = [
        ("t1", "C1", "2024-01-01 10:00:00", 'say "hi", then go', "support", "low", "Equipe Support"),
        ("t2", "C2", "2024-01-01 10:00:00", "  leading and trailing  ", "support", "low", "Equipe Support"),
        ("t3", "C3", "2024-01-01 10:00:00", "", "support", "low", "Equipe Support"),
        ("t4", "C4", "2024-01-01 10:00:00", None, "support", "low", "Equipe Support"),
        ("t5", "C5", "2024-01-01 10:00:00", "two\nlines", "support", "low", "Equipe Support"),
        ("t6", "C6", "2024-01-01 10:00:00", "back\\slash \\N", "support", "low", "Equipe Générique"),
        ("t7", "C7", "2024-01-01 10:00:00", '{"k": 1}', "support", "low", "Equipe Support"),
        ("t8", "C8", "2024-01-01 10:00:00", "é ü 中", "support", "low", "Equipe Support"),
    ]
    df = spark.createDataFrame(rows, SCHEMA7)
    write_csv(df, f"{scratch}/csv")
    back = read_csv(spark, f"{scratch}/csv", ENRICHED_SCHEMA)
    assert rows_of(back) == sorted(rows, key=str)
    header = open(sorted(glob.glob(f"{scratch}/csv/part-*.csv"))[0], encoding="utf-8").readline().strip()
    assert header == ",".join(ENRICHED_FIELDS)


def test_format_preference_and_errors(spark, sf001, scratch):
    routed = fx.routed_tickets(spark, sf001)
    write_json(routed, f"{scratch}/json")
    os.makedirs(f"{scratch}/parquet")
    assert rows_of(load_exports(spark, f"{scratch}/parquet", f"{scratch}/json")) == rows_of(routed)
    write_parquet(routed.limit(3), f"{scratch}/parquet2")
    assert load_exports(spark, f"{scratch}/parquet2", f"{scratch}/json").count() == 3  # Parquet preferred
    with pytest.raises(NoDataError):
        load_exports(spark, f"{scratch}/nothing1", f"{scratch}/nothing2")
    with pytest.raises(FileNotFoundError) as missing:
        load_parquet_exports(spark, f"{scratch}/does-not-exist")
    assert not isinstance(missing.value, NoDataError)
    os.makedirs(f"{scratch}/empty")
    with pytest.raises(NoDataError):
        load_parquet_exports(spark, f"{scratch}/empty")


def test_listing_reads_no_content(spark, sf001, scratch):
    write_parquet(fx.routed_tickets(spark, sf001), f"{scratch}/p")
    listing = list_data_files(spark, f"{scratch}/p", "*.parquet")
    assert listing.columns == ["path"]
    assert listing.count() == len(glob.glob(f"{scratch}/p/*.parquet"))


def test_streaming_output_ignores_uncommitted_files(spark, sf001, scratch):
    from tessera.sources.kafka import read_message_log
    from tessera.streaming import run_export
    from tessera.streaming.publish import publish_tickets

    publish_tickets(fx.tickets(spark, sf001), log_path=f"{scratch}/log")
    run_export(read_message_log(spark, f"{scratch}/log"), f"{scratch}/p", f"{scratch}/j", f"{scratch}/ck", available_now=True)
    committed = read_parquet_dir(spark, f"{scratch}/p").count()
    stray = sorted(glob.glob(f"{scratch}/p/part-*.parquet"))[0]
    shutil.copy(stray, f"{scratch}/p/part-stray-from-aborted-attempt.parquet")
    assert read_parquet_dir(spark, f"{scratch}/p").count() == committed == 1000  # D14


def test_summary_text_in_order(spark, sf01, scratch):
    write_summary_text(distribution_summary(fx.routed_tickets(spark, sf01)), f"{scratch}/txt")
    lines = []
    for part in sorted(glob.glob(f"{scratch}/txt/part-*")):
        lines += open(part, encoding="utf-8").read().splitlines()
    assert lines[0] == "Répartition priorités :"
    assert lines[1:5] == ["high: 3737", "urgent: 3002", "medium: 2293", "low: 968"]
    assert lines[5] == ""
    assert lines[6] == "Types de requêtes :"
    assert "Équipes assignées :" in lines
    assert lines[-1] == ""


def test_corrupt_json_lines_are_counted_or_fail(spark, scratch):
    import os

    os.makedirs(f"{scratch}/j/deep")
    with open(f"{scratch}/j/deep/part-0.json", "w", encoding="utf-8") as out:
        out.write('{"ticket_id": "t1"}\n\n{"ticket_id": "t\n[1\n{}\n')
    row = json_rejects(spark, f"{scratch}/j").first()
    assert (row.lines, row.rejected) == (4, 2)
    assert read_json_dir(spark, f"{scratch}/j").count() == 4
    with pytest.raises(Exception):
        load_exports(spark, f"{scratch}/p", f"{scratch}/j").collect()


def test_folder_names_are_no_columns(spark, scratch):
    for i in range(2):
        spark.createDataFrame([("t1", 7)], "ticket_id string, batch_id int").write.parquet(f"{scratch}/p/batch_id={i}")
    got = load_parquet_exports(spark, f"{scratch}/p")
    assert got[0].columns == ["ticket_id", "batch_id"] and got[1] == len(glob.glob(f"{scratch}/p/*/part-*.parquet"))
    assert {r.batch_id for r in got[0].collect()} == {7}  # a real column of that name stays
