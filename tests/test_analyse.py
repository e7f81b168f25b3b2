"""The analysis job end to end (J2) and the dashboard SQL."""

import glob
import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessera.operators.quality import MissingColumnsError, row_copies
from tessera.plans import fixtures as fx
from tessera.plans.analyse import analyse, csv_ready
from tessera.plans.dashboard import DASHBOARD_SQL, dashboard_over_table, dashboard_query
from tessera.schemas import ENRICHED_SCHEMA
from tessera.sinks import read_csv, write_json, write_parquet


def test_analyse_on_dirty_export(spark, sf01, scratch):
    write_parquet(fx.dirty_tickets(spark, sf01), f"{scratch}/parquet")
    result = analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out", priorities=["critical", "high", "low", "medium", "urgent"])
    assert result.audit == {"loaded": 11000, "deduplicated": 9901, "complete": 8912}
    assert result.null_report == {"ticket_id": 1, "client_id": 1, "created_at": 1, "request_type": 1, "request": 431, "priority": 584}
    assert not result.daily_skipped
    assert result.columns == list(ENRICHED_SCHEMA.fieldNames())
    by_priority = {r.priority: r.n for r in spark.read.parquet(result.paths["by_priority"]).collect()}
    assert by_priority == {"critical": 287, "high": 3209, "low": 844, "medium": 1996, "urgent": 2576}
    team_priority = spark.read.parquet(result.paths["team_priority"])
    assert team_priority.columns == ["assigned_team", "critical", "high", "low", "medium", "urgent"]
    assert team_priority.agg(F.sum("high")).first()[0] == 3209
    assert spark.read.parquet(result.paths["by_day"]).agg(F.sum("n")).first()[0] == 8912
    csv = read_csv(spark, result.paths["csv"], ENRICHED_SCHEMA)
    assert csv.count() == 8912
    assert csv.where(F.col("created_at").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")).count() == 8912  # D11
    assert glob.glob(f"{result.paths['summary_txt']}/part-*")


def test_analyse_falls_back_to_json_and_skips_bad_dates(spark, scratch):
    rows = [("t1", "C1", "2024-01-01T00:00:00", "r", "support", "low", "Equipe Support"),
            ("t2", "C2", "bad-date", "r", "support", "low", "Equipe Support")]
    write_json(spark.createDataFrame(rows, ENRICHED_SCHEMA), f"{scratch}/json")
    result = analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out", date_mode="skip")
    assert result.daily_skipped and "by_day" not in result.paths
    csv = {r.ticket_id: r.created_at for r in read_csv(spark, result.paths["csv"], ENRICHED_SCHEMA).collect()}
    assert csv == {"t1": "2024-01-01T00:00:00", "t2": "bad-date"}  # original text kept


def test_dashboard_sql(spark, sf001):
    routed = fx.routed_tickets(spark, sf001)
    for name in DASHBOARD_SQL:
        assert dashboard_query(spark, routed, name).count() > 0
    total = dashboard_query(spark, routed, "tickets_by_team").agg(F.sum("n")).first()[0]
    assert total == 1000


def outputs(result):
    return set(result.paths)


def test_outputs_do_not_depend_on_the_data(spark, scratch):
    rows = [(f"t{i}", "C1", "2024-01-01T00:00:00", "r", "support", f"p{i}", "Equipe Support") for i in range(6)]
    write_parquet(spark.createDataFrame(rows, ENRICHED_SCHEMA), f"{scratch}/parquet")
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        result = analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)
    assert outputs(result) == {"summary", "by_priority", "team_priority_long", "by_day", "csv", "summary_txt", "clean_rows"}
    assert spark.read.parquet(result.paths["team_priority_long"]).count() == 6


def csv_text(path):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_export_without_rows(spark, scratch):
    write_parquet(spark.createDataFrame([], ENRICHED_SCHEMA), f"{scratch}/parquet")
    result = analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out", priorities=["low"])
    assert result.audit == {"loaded": 0, "deduplicated": 0, "complete": 0} and result.null_report == {}
    assert csv_text(result.paths["csv"]).strip() == ",".join(ENRICHED_SCHEMA.fieldNames())
    assert "Répartition priorités" in csv_text(result.paths["summary_txt"])
    assert all(spark.read.parquet(result.paths[n]).count() == 0 for n in ("by_priority", "by_day", "team_priority", "team_priority_long"))


def test_export_with_incomplete_rows_only(spark, scratch):
    write_parquet(spark.createDataFrame([("t1", None, None, "r", "support", "low", "x")] * 2, ENRICHED_SCHEMA), f"{scratch}/parquet")
    result = analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out")
    assert result.audit == {"loaded": 2, "deduplicated": 1, "complete": 0}
    assert result.null_report == {"client_id": 1, "created_at": 1}
    assert csv_text(result.paths["csv"]).strip() == ",".join(ENRICHED_SCHEMA.fieldNames())


def test_missing_column_is_an_error(spark, scratch):
    write_parquet(spark.createDataFrame([("t1",) * 7], ENRICHED_SCHEMA).drop("priority"), f"{scratch}/parquet")
    with pytest.raises(MissingColumnsError) as info:
        analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out")
    assert info.value.missing == ["priority"]


def test_extra_column_survives(spark, scratch):
    rows = spark.createDataFrame([("t1", "C1", "2024-01-01T00:00:00", "r", "support", "low", "x")], ENRICHED_SCHEMA)
    write_parquet(rows.withColumn("extra", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("b")))), f"{scratch}/parquet")
    result = analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out")
    assert result.columns == [*ENRICHED_SCHEMA.fieldNames(), "extra"] and result.audit["deduplicated"] == 2
    assert spark.read.parquet(result.paths["clean_rows"]).count() == 2


def test_skip_mode_asks_for_one_format(spark, scratch):
    rows = [("t1", "C1", "2024-01-01T00:00:00", "r", "support", "low", "x"), ("t2", "C1", "2024-01-02 00:00:00", "r", "support", "low", "x")]
    write_parquet(spark.createDataFrame(rows, ENRICHED_SCHEMA), f"{scratch}/parquet")
    result = analyse(spark, f"{scratch}/parquet", f"{scratch}/json", f"{scratch}/out", date_mode="skip")
    assert result.daily_skipped
    write_parquet(spark.createDataFrame(rows[:1], ENRICHED_SCHEMA), f"{scratch}/parquet2")
    assert not analyse(spark, f"{scratch}/parquet2", f"{scratch}/json", f"{scratch}/out2", date_mode="skip").daily_skipped


def test_export_keeps_fraction_and_offset(spark):
    texts = {
        "2024-01-01T10:00:00.123456": "2024-01-01 10:00:00.123456", "2024-01-01T10:00:00.5": "2024-01-01 10:00:00.500000", "2024-01-01T10:00:00+02:00": "2024-01-01 10:00:00+02:00",
        "2024-01-01 10:00:00": "2024-01-01 10:00:00", "2024-01-01T10:00:00Z": "2024-01-01 10:00:00+00:00", "2024-01-01": "2024-01-01 00:00:00", "2024-01-01T10:00:00.25-05:30": "2024-01-01 10:00:00.250000-05:30", "no": "no",
    }
    df = csv_ready(spark.createDataFrame([(t, t) for t in texts], "key string, created_at string"), "lenient")
    assert {r.key: r.created_at for r in df.collect()} == texts


def test_no_sort_before_the_write_and_filter_above_the_observation(spark, scratch, event_log):
    observed = row_copies(spark.createDataFrame([("a",)], "c string")).observe(Observation("x"), F.count(F.lit(1)).alias("n")).where("c IS NOT NULL").select("c")
    plan = observed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("CollectMetrics")
    path = f"{scratch}/clean"
    observed.write.parquet(path)
    writes = [e for e in event_log() if "sparkPlanInfo" in e and path in json.dumps(e.get("physicalPlanDescription", ""))]
    assert writes and not any('"nodeName": "Sort"' in json.dumps(e["sparkPlanInfo"]) for e in writes)


def test_dashboard_reads_the_loaded_table(spark, sf001):
    spark.createDataFrame([("x",)], "priority string").createOrReplaceTempView("tickets_analysis")
    got = dashboard_over_table(spark, fx.routed_tickets(spark, sf001), "tickets_by_team").agg(F.sum("n")).first()[0]
    assert got == 1000 and spark.table("tickets_analysis").count() == 1  # a table of that name is not hidden
    spark.catalog.dropTempView("tickets_analysis")
