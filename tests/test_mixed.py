"""Part files that disagree in a column's type."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.loads import load_relational
from tessera.schemas import ENRICHED_SCHEMA
from tessera.sources import data_file_names, load_exports, mixed, read_parquet_dir


@pytest.mark.parametrize("types, want", [
    (["int", "bigint"], "bigint"), (["tinyint", "smallint"], "smallint"), (["int", "double"], "double"), (["float", "double"], "double"), (["date", "timestamp_ntz"], "timestamp_ntz"),
    (["int", "string"], "string"), (["timestamp_ntz", "string"], "string"), (["boolean", "int"], "string"), (["string"], "string"), (["array<int>", "string"], "string"), (["void", "int"], "int"), (["void"], "string"),
])
def test_common_type(spark, types, want):
    known = [T.NullType() if t == "void" else T._parse_datatype_string(t) for t in types]
    assert mixed.common_type(known).simpleString() == want == mixed.common_type(known[::-1]).simpleString()


@pytest.fixture
def folder(spark, scratch):
    path = f"{scratch}/p"
    numbers = spark.range(0, 20, 1, 4)
    numbers.selectExpr("id AS key", "cast(id AS string) AS v", "'x' AS only_here").write.parquet(f"{path}/a")
    numbers.selectExpr("id + 100 AS key", "cast(id AS int) AS v").write.parquet(f"{path}/b")
    numbers.selectExpr("cast(id + 200 AS int) AS key", "timestamp_ntz'2024-01-05 10:00:00' AS v").write.parquet(f"{path}/c")
    numbers.selectExpr("id + 300 AS key", "cast(id AS string) AS v").write.parquet(f"{path}/d")
    return path


def test_all_rows_by_name(spark, folder):
    got = {r.key: (r.v, r.only_here) for r in read_parquet_dir(spark, folder).collect()}
    assert len(got) == 80
    assert (got[7], got[107], got[207], got[307]) == (("7", "x"), ("7", None), ("2024-01-05 10:00:00", None), ("7", None))
    assert [(f.name, f.dataType.simpleString()) for f in read_parquet_dir(spark, folder).schema] == [("key", "bigint"), ("v", "string"), ("only_here", "string")]


def test_one_scan_for_each_group_of_types(spark, folder, monkeypatch):
    files = data_file_names(spark, folder)
    groups = mixed.schema_groups(spark, files)
    assert len(files) == 16 and sorted(len(members) for _, members in groups) == [4, 4, 8]  # both text lots together
    tried = []
    real = mixed.merged_schema
    monkeypatch.setattr(mixed, "merged_schema", lambda s, part: tried.append(len(part)) or real(s, part))
    mixed.schema_groups(spark, files)
    assert len(tried) <= 7  # by write job: changes of type count, not files
    read = read_parquet_dir(spark, folder).where(F.col("key") > 250).select("key")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and "GreaterThan(key,250)" in plan and "only_here" not in plan


def test_a_given_schema_decides(spark, folder):
    got = mixed.read_mixed_parquet(spark, data_file_names(spark, folder), T._parse_datatype_string("key string, missing string"))
    assert got.dtypes == [("key", "string"), ("missing", "string")] and got.count() == 80 and got.where("missing IS NOT NULL").isEmpty()


def test_files_that_agree_are_one_scan(spark, scratch):
    spark.range(10).selectExpr("id", "1 AS a").write.parquet(f"{scratch}/p/x")
    spark.range(10).selectExpr("id", "'b' AS b").write.parquet(f"{scratch}/p/y")
    got = read_parquet_dir(spark, f"{scratch}/p")
    assert sorted(got.columns) == ["a", "b", "id"] and got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_loads_and_analysis_read_mixed_exports(spark, scratch):
    row = ("t1", "C1", "2024-01-01T00:00:00", "r", "support", "low", "Equipe Support")
    spark.createDataFrame([row], ENRICHED_SCHEMA).write.parquet(f"{scratch}/e/a")
    typed = spark.createDataFrame([row], ENRICHED_SCHEMA).withColumn("client_id", F.lit(7)).withColumn("created_at", F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz"))
    typed.write.parquet(f"{scratch}/e/b")
    assert sorted((r.client_id, r.created_at) for r in load_exports(spark, f"{scratch}/e", f"{scratch}/j").collect()) == [("7", "2024-01-02 00:00:00"), ("C1", "2024-01-01T00:00:00")]
    assert load_relational(spark, f"{scratch}/e", path=f"{scratch}/t").rows == 2
