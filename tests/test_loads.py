"""Table loads (J3, J4, K6, K7, O5, S8; D16, D17, D20) on Parquet tables.

JDBC targets take the same code path with ``jdbc`` options; no database runs
in this environment, so only their option handling is checked here.
"""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.plans import fixtures as fx
from tessera.plans.loads import load_columnar, load_relational
from tessera.schemas import ENRICHED_FIELDS
from tessera.sinks import append_columnar, replace_table, write_parquet
from tessera.sources import NoDataError, read_table


@pytest.fixture
def export(spark, sf001, scratch):
    path = f"{scratch}/export"
    write_parquet(fx.dirty_tickets(spark, sf001), path)
    return path


def test_relational_replace_loads_uncleaned_rows(spark, scratch, export):
    first = load_relational(spark, export, path=f"{scratch}/t")
    assert (first.rows, first.files) == (1100, len(glob.glob(f"{export}/*.parquet")))
    assert load_relational(spark, export, path=f"{scratch}/t").rows == 1100
    assert read_table(spark, path=f"{scratch}/t").count() == 1100


def test_relational_guards(spark, scratch):
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in ENRICHED_FIELDS))
    assert replace_table(empty, path=f"{scratch}/t1") is False
    keyless = spark.createDataFrame([("x",)], "request string")
    assert replace_table(keyless, path=f"{scratch}/t2") is False
    assert not glob.glob(f"{scratch}/t1") and not glob.glob(f"{scratch}/t2")
    os.makedirs(f"{scratch}/no-files")
    with pytest.raises(NoDataError):
        load_relational(spark, f"{scratch}/no-files", path=f"{scratch}/t3")


def test_columnar_append_twice(spark, scratch, export):
    n = load_columnar(spark, export, path=f"{scratch}/t").rows
    assert n == load_columnar(spark, export, path=f"{scratch}/t").rows
    assert read_table(spark, path=f"{scratch}/t").count() == 2 * n
    assert read_table(spark, path=f"{scratch}/t").where(F.col("priority").isNull()).count() == 0


def test_columnar_selects_by_name(spark, scratch):
    rows = [("Equipe Support", "high", "support", "r", "2024-01-02T00:00:00", "C1", "t1")]
    shuffled = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in reversed(ENRICHED_FIELDS)))
    append_columnar(shuffled, path=f"{scratch}/t")
    got = read_table(spark, path=f"{scratch}/t").first()
    assert got.ticket_id == "t1" and got.assigned_team == "Equipe Support"


def test_storage_is_sorted_by_creation_text(spark, sf01, scratch):
    clean = fx.dirty_tickets(spark, sf01)
    append_columnar(clean.na.drop().dropDuplicates(), path=f"{scratch}/t")
    ranges = []
    for f in sorted(glob.glob(f"{scratch}/t/part-*.parquet")):
        values = pq.read_table(f, columns=["created_at"]).column(0).to_pylist()
        assert values == sorted(values)  # sorted as text (D20)
        if values:
            ranges.append((values[0], values[-1]))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # files cover disjoint slices
    table = read_table(spark, path=f"{scratch}/t")
    ranged = table.where((F.col("created_at") >= "2024-01-10") & (F.col("created_at") < "2024-01-12"))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "created_at" in plan.split("PushedFilters")[1][:300]
    assert ranged.count() == 598


def test_jdbc_options_are_passed(spark):
    df = spark.createDataFrame([("t1",)], "ticket_id string")
    from tessera.sinks.tables import _jdbc_writer

    writer = _jdbc_writer(df, {"url": "jdbc:none://host/db", "batchsize": "1000"}, "tickets_analysis")
    assert writer is not None
    with pytest.raises(ValueError):
        replace_table(df)
    with pytest.raises(ValueError):
        read_table(spark)


def test_write_errors_propagate(spark, sf001, scratch):
    blocker = f"{scratch}/not-a-folder"
    open(blocker, "w").close()
    df = fx.routed_tickets(spark, sf001)
    with pytest.raises(Exception):
        replace_table(df, path=f"{blocker}/table")
    with pytest.raises(Exception):
        append_columnar(df, path=f"{blocker}/table")
