"""Distinct rows of a table that grows by batches."""

import uuid

import pytest
from pyspark.sql import functions as F
from test_skew import shuffle_records

from tessera.operators import distinct_rows
from tessera.operators.incremental import KEY, DistinctStore, row_key
from tessera.plans import fixtures as fx


@pytest.fixture
def store(spark, scratch):
    made = DistinctStore(spark, scratch, f"keys_{uuid.uuid4().hex[:12]}", buckets=8)
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.table}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_a_full_distinct(spark, sf001, store):
    dirty, routed = fx.dirty_tickets(spark, sf001), fx.routed_tickets(spark, sf001)
    batches = [dirty.limit(300), dirty, routed.unionByName(dirty), dirty.where("false")]
    for i, batch in enumerate(batches):
        store.add(batch, f"b{i}")
    assert rows(store.rows(dirty.columns)) == rows(distinct_rows(dirty.unionByName(routed)))
    assert spark.table(store.table).count() == store.rows(dirty.columns).count()


def test_a_batch_that_runs_again(spark, sf001, store):
    dirty = fx.dirty_tickets(spark, sf001)
    store.add(dirty.limit(500), "a")
    for batch in (dirty.limit(700), dirty, dirty):  # its first try saw less, its last is the same again
        store.add(batch, "b")
    assert rows(store.rows(dirty.columns)) == rows(distinct_rows(dirty))


def test_only_the_collapsed_batch_is_shuffled(spark, store):
    """The stored keys are read bucket by bucket; a hot row leaves each map task once."""
    many = spark.range(0, 40_000, 1, 8).select(F.concat(F.lit("T"), "id").alias("ticket_id"))
    store.add(many, "a")
    hot = spark.range(0, 9_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("N"), "id")).alias("ticket_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = store.new_rows(hot)
        plan = new._jdf.queryExecution().executedPlan().toString()
        written = shuffle_records(spark, lambda: new.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The distinct step shuffles 6,000 rows and the hot one once a task; the join to the buckets those 6,001 again.
    assert written <= 2 * 6_001 + 8
    assert "SelectedBucketsCount: 8 out of 8" in plan
    assert new.count() == 6_001


def test_keys_tell_rows_apart(spark):
    schema = "a string, b string, x double, t array<string>"
    df = spark.createDataFrame([(None, "a", 0.0, ["a, b"]), ("a", None, 0.0, ["a, b"]), ("null", "a", 0.0, ["a, b"]), (None, "a", 0.0, ["a", "b"]), (None, "a", 1.0, ["a, b"]), (None, "a", -0.0, ["a, b"]), (None, "a", 0.0, None)], schema)
    keys = [r[0] for r in df.select(row_key(df)).collect()]
    assert len(set(keys)) == 6 and keys[0] == keys[5] and len(keys[0]) == 64


def test_fractions_of_a_second_count(spark, store):
    df = spark.sql("SELECT timestamp_ntz'2024-01-05 10:00:00.000001' AS t UNION ALL SELECT timestamp_ntz'2024-01-05 10:00:00.000002'")
    store.add(df, "a")
    store.add(df, "b")
    assert store.rows(["t"]).count() == 2 and KEY not in store.rows(["t"]).columns
