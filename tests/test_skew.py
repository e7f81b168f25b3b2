"""A third of all rows in one group: the shuffle must not carry that group.

Shuffle volumes are read from Spark's event log (written to a scratch folder
by the test session): partial aggregation has to collapse the hot group to
about one row per map task before the exchange.
"""

import glob
import json
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import cleaning_audit, crosstab, distinct_rows, distribution_summary, value_counts

N = 36_000
MAP_TASKS = 8


def shuffle_records(spark, action) -> int:
    sc = spark.sparkContext
    group = f"skew-{uuid.uuid4().hex[:8]}"
    sc.setJobGroup(group, group)
    try:
        action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    log_dir = spark.conf.get("spark.eventLog.dir").replace("file:", "")
    deadline = time.time() + 30
    while True:
        jobs, ended, written = {}, set(), {}
        found = glob.glob(f"{log_dir}/*{sc.applicationId}*")
        files = [f for p in found for f in (sorted(glob.glob(f"{p}/events_*")) if os.path.isdir(p) else [p])]
        for path in files:
            with open(path, encoding="utf-8") as fh:
                for line in fh:
                    event = json.loads(line)
                    kind = event.get("Event")
                    if kind == "SparkListenerJobStart" and (event.get("Properties") or {}).get("spark.jobGroup.id") == group:
                        jobs[event["Job ID"]] = event["Stage IDs"]
                    elif kind == "SparkListenerJobEnd":
                        ended.add(event["Job ID"])
                    elif kind == "SparkListenerTaskEnd":
                        metrics = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                        written[event["Stage ID"]] = written.get(event["Stage ID"], 0) + metrics.get("Shuffle Records Written", 0)
        if jobs and set(jobs) <= ended:
            stages = {s for ids in jobs.values() for s in ids}
            return sum(written.get(s, 0) for s in stages)
        if time.time() > deadline:
            pytest.fail("event log did not record the jobs")
        time.sleep(0.5)


@pytest.fixture(scope="module")
def hot(spark):
    """N rows over 8 partitions; every third row is the same all-null ticket."""
    hot_row = F.col("id") % 3 == 0
    return spark.range(0, N, 1, MAP_TASKS).select(
        F.when(hot_row, F.lit(None)).otherwise(F.concat(F.lit("T"), F.col("id").cast("string"))).alias("ticket_id"),
        F.when(hot_row, F.lit(None)).otherwise(F.lit("r")).alias("request"),
        F.when(hot_row, F.lit(None)).otherwise(F.lit("high")).alias("priority"),
        F.lit("Equipe Générique").alias("assigned_team"),
    )


def noop(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def test_dedup_collapses_hot_copies_map_side(spark, hot):
    distinct = N - N // 3
    written = shuffle_records(spark, noop(distinct_rows(hot)))
    assert written <= distinct + MAP_TASKS  # not distinct + N // 3
    assert distinct_rows(hot).count() == distinct + 1


def test_audit_shuffles_once(spark, hot):
    distinct = N - N // 3
    written = shuffle_records(spark, noop(cleaning_audit(hot)))
    assert written <= distinct + 2 * MAP_TASKS + 8
    assert {r.step: r.rows for r in cleaning_audit(hot).collect()} == {"loaded": N, "deduplicated": distinct + 1, "complete": distinct}


@pytest.mark.parametrize("build", [
    lambda df: value_counts(df, "assigned_team"),
    lambda df: crosstab(df, values=["high"]),
    lambda df: distribution_summary(df, ["priority", "assigned_team"]),
])
def test_counts_shuffle_per_group_not_per_row(spark, hot, build):
    written = shuffle_records(spark, noop(build(hot)))
    assert written <= 50 * MAP_TASKS  # a handful of groups per map task
