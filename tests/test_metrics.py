"""Distributions, cross-tab, daily series, summary (A1-A8, O1-O3; D8-D10)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import (
    crosstab,
    crosstab_long,
    distribution_summary,
    preview,
    rejected_dates,
    row_and_file_counts,
    tickets_by_priority,
    tickets_per_day,
    value_counts,
)
from tessera.plans import fixtures as fx
from tessera.sources import footer_row_count, list_data_files, read_parquet_dir


def test_value_counts_order_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "v string")
    assert [(r.v, r.n) for r in value_counts(df, "v").collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_priority_golden(spark, sf01):
    got = {r.priority: r.n for r in tickets_by_priority(fx.routed_tickets(spark, sf01)).collect()}
    assert got == {"high": 3737, "low": 968, "medium": 2293, "urgent": 3002}


def test_crosstab_semantics(spark):
    rows = [("A", "low"), ("A", "low"), ("A", "high"), ("B", "urgent"), ("C", None), (None, "low")]
    df = spark.createDataFrame(rows, "assigned_team string, priority string")
    ct = crosstab(df)
    assert ct.columns == ["assigned_team", "high", "low", "urgent"]  # present values, alphabetical
    got = {r.assigned_team: (r.high, r.low, r.urgent) for r in ct.collect()}
    assert got == {"A": (1, 2, 0), "B": (0, 0, 1)}  # C (only null priorities) is left out
    fixed = crosstab(df, values=["low", "medium", "high", "urgent"])
    assert fixed.columns == ["assigned_team", "low", "medium", "high", "urgent"]
    assert {r.assigned_team: r.medium for r in fixed.collect()} == {"A": 0, "B": 0}
    assert crosstab_long(df).count() == 3


def test_crosstab_value_bound(spark):
    df = spark.createDataFrame([("A", str(i)) for i in range(5)], "assigned_team string, priority string")
    from tessera.operators.metrics import pivot_values

    with pytest.raises(ValueError):
        pivot_values(df, "assigned_team", "priority", max_values=3)


@pytest.fixture
def dates(spark):
    rows = [("2024-01-02T10:00:00",), ("2024-01-01T23:59:59",), ("2024-01-02 08:00:00",), (None,), ("bad-date",)]
    return spark.createDataFrame(rows, "created_at string")


def test_daily_lenient(dates):
    got = [(r.day, r.n) for r in tickets_per_day(dates, mode="lenient").collect()]
    assert got == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)]  # ordered by day
    assert rejected_dates(dates) == 1


def test_daily_skip_and_strict(dates):
    assert tickets_per_day(dates, mode="skip") is None
    # two formats in one column: no series, as pandas raises on them
    assert tickets_per_day(dates.where("created_at != 'bad-date'"), mode="skip") is None
    assert tickets_per_day(dates.where("created_at LIKE '%T%'"), mode="skip").count() == 2
    with pytest.raises(Exception):
        tickets_per_day(dates, mode="strict").collect()


def test_summary_equals_three_group_bys(spark, sf01):
    routed = fx.routed_tickets(spark, sf01)
    summary = {(r.dimension, r.value): r.n for r in distribution_summary(routed).collect()}
    expected = {}
    for dim in ("priority", "request_type", "assigned_team"):
        for r in value_counts(routed, dim).collect():
            expected[(dim, r[dim])] = r.n
    assert summary == expected
    plan = distribution_summary(routed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # one scan for all three distributions


def test_preview_is_top_k(spark, sf01):
    first = preview(fx.routed_tickets(spark, sf01), 5, order_by="ticket_id")
    assert [r.ticket_id for r in first.collect()] == [f"T{i:010d}" for i in range(5)]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()


def test_row_and_file_counts(spark, scratch):
    for where in ("id < 3", "id >= 3", "false"):  # the last file has no rows
        spark.range(10).where(where).coalesce(1).write.mode("append").parquet(f"{scratch}/p")
    r = row_and_file_counts(footer_row_count(spark, f"{scratch}/p", read_parquet_dir(spark, f"{scratch}/p").schema), list_data_files(spark, f"{scratch}/p", "*.parquet")).first()
    assert (r.n_rows, r.n_files) == (10, 3)


def test_time_text_ignores_session_zone(spark):
    import datetime as dt

    from tessera.plans.analyse import csv_ready

    events = spark.createDataFrame(
        [(1, dt.datetime(2024, 3, 10, 2, 30, 5), 7, "click", 1.0, "{}")],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there that day
    try:
        ticket = fx.tickets_from_events(events).first()
        assert ticket.created_at == "2024-03-10T02:30:05"
        exported = csv_ready(fx.tickets_from_events(events), "lenient").first()
        assert exported.created_at == "2024-03-10 02:30:05"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_strict_dates_fail_without_ansi_too(spark, dates):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            with pytest.raises(Exception) as info:
                tickets_per_day(dates, mode="strict").collect()
            assert "does not parse" in str(info.value)
            assert tickets_per_day(dates.where("created_at != 'bad-date'"), mode="strict").count() == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_rows_are_counted_from_footers(spark, scratch):
    spark.range(100, numPartitions=4).selectExpr("id", "cast(id AS string) AS name").write.parquet(f"{scratch}/p")
    spark.range(0).selectExpr("id", "cast(id AS string) AS name").write.mode("append").parquet(f"{scratch}/p")
    before = dict(spark.conf.getAll)
    counted = footer_row_count(spark, f"{scratch}/p", "id long, name string")
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert [r.n_rows for r in counted.collect()] == [100]
    assert dict(spark.conf.getAll) == before  # the caller's settings stay


ODD_TYPES = [None, "", "a", "A", "a ", "a/b", "a=b:c", "é", "__HIVE_DEFAULT_PARTITION__", "x" * 300]


@pytest.mark.parametrize("types", [ODD_TYPES, [None, ""], [None], ["click"], [f"type {i}" for i in range(40)], []])
def test_counted_folder_has_one_file_per_event_type(spark, scratch, monkeypatch, types):
    """the number of files follows the event types, as the SQL says."""
    import duckdb

    import __spark_entry__ as se
    from tessera.plans import registry

    rows = [(i, dt.datetime(2024, 1, 1), None, kind, 1.0, "{}") for kind in types for i in (1, 2, 2, None)]
    spark.createDataFrame(rows, fx.TABLE_SCHEMAS["events"]).repartition(3).write.parquet(f"{scratch}/events.parquet")
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: f"{scratch}/{name}")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")  # a session's setting splits no type
    try:
        got = se.queries()["row_and_file_counts"](spark, scratch).first()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    kinds = {kind or "" for kind in types}
    assert (got.n_rows, got.n_files) == (4 * len(types), len(kinds) + 1)

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{scratch}/events.parquet/*.parquet')")
    assert con.sql(se.oracle_sql()["row_and_file_counts"]).fetchall() == [(got.n_rows, got.n_files)]

    written = read_parquet_dir(spark, f"{scratch}/row_and_file_counts", schema=fx.TABLE_SCHEMAS["events"])
    per_file = written.groupBy("_metadata.file_path").agg(F.collect_set(F.coalesce("event_type", F.lit(""))).alias("kinds"))
    assert sorted(r.kinds for r in per_file.collect()) == sorted([k] for k in kinds)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, written.collect()), key=key) == sorted(rows, key=key)
