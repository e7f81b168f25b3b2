"""The plan-report and stage-times tools parse what Spark prints and logs."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import plan_report  # noqa: E402
import stage_times  # noqa: E402

PLAN = """AdaptiveSparkPlan isFinalPlan=false
+- HashAggregate(keys=[priority#1], functions=[count(1)])
   +- Exchange hashpartitioning(priority#1, 8), ENSURE_REQUIREMENTS, [plan_id=1]
      +- HashAggregate(keys=[priority#1], functions=[partial_count(1)])
         +- FileScan parquet [value#4,ts#5] Batched: true, DataFilters: [], Format: Parquet, PartitionFilters: [], PushedFilters: [IsNotNull(ts)], ReadSchema: struct<value:double,ts:timestamp_ntz>
"""


def test_plan_summary():
    s = plan_report.summarize(PLAN)
    assert s["scans"] == [{"format": "parquet", "columns": ["value", "ts"], "pushed": "IsNotNull(ts)", "partition_filters": ""}]
    assert (s["hash_exchanges"], s["range_exchanges"], s["aggregates"]) == (1, 0, 2)
    assert not s["python"] and not s["broadcast"]


def test_stage_report():
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0, 1], "Properties": {"spark.jobGroup.id": "g"}},
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Stage IDs": [2], "Properties": {"spark.jobGroup.id": "other"}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 0, "Task Metrics": {"Executor Run Time": 5, "Input Metrics": {"Bytes Read": 10},
                                                                          "Shuffle Write Metrics": {"Shuffle Bytes Written": 3}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 0, "Task Metrics": {"Executor Run Time": 7, "Disk Bytes Spilled": 2}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 2, "Task Metrics": {"Executor Run Time": 99}},
        {"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 0, "Stage Name": "scan", "Number of Tasks": 2,
                                                                "Submission Time": 100, "Completion Time": 150}},
    ]
    rows = stage_times.stage_report(events, "g")
    assert len(rows) == 1
    assert rows[0] == {"stage": 0, "task_ms": 12, "input_bytes": 10, "shuffle_read": 0, "shuffle_write": 3, "spill": 2,
                            "name": "scan", "tasks": 2, "wall_ms": 50}
