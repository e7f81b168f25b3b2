"""Tables that a failing load leaves alone (K6, K7; J3, J4)."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.quality import clean_for_warehouse
from tessera.plans import fixtures as fx
from tessera.plans.loads import load_columnar, load_relational
from tessera.sinks import append_columnar, replace_table, write_parquet
from tessera.sinks.swap import Folders, current_folder, replace_catalog_table, table_location
from tessera.sources import read_table


@pytest.fixture
def table(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex[:12]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def routed(spark, sf001):
    return fx.routed_tickets(spark, sf001)


def broken(df):
    return df.withColumn("request", F.when(F.col("ticket_id").endswith("7"), F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("request")))


def test_a_failed_replacement_leaves_the_folder(spark, scratch, routed):
    replace_table(routed, path=f"{scratch}/t")
    for bad in (broken(routed), broken(routed.limit(500))):
        with pytest.raises(Exception, match="broken row"):
            replace_table(bad, path=f"{scratch}/t")
        assert read_table(spark, path=f"{scratch}/t").count() == 1000
    assert os.listdir(scratch) == ["t"]  # nothing left beside it
    assert replace_table(routed.limit(3), path=f"{scratch}/t") and read_table(spark, path=f"{scratch}/t").count() == 3
    assert os.listdir(scratch) == ["t"]


def test_a_corrupt_export_file_leaves_the_table(spark, scratch, routed, table):
    write_parquet(routed, f"{scratch}/export")
    for target in ({"path": f"{scratch}/t"}, {"path": f"{scratch}/c", "table": table, "catalog": True}):
        assert load_relational(spark, f"{scratch}/export", **target).rows == 1000
    first = sorted(glob.glob(f"{scratch}/export/*.parquet"))[0]
    with open(first, "r+b") as fh:  # the footer stays, the pages go
        fh.seek(4)
        fh.write(b"\xff" * (os.path.getsize(first) // 2))
    for crc in glob.glob(f"{scratch}/export/.*.crc"):
        os.remove(crc)
    for target in ({"path": f"{scratch}/t"}, {"path": f"{scratch}/c", "table": table, "catalog": True}):
        with pytest.raises(Exception):
            load_relational(spark, f"{scratch}/export", **target)
        assert read_table(spark, path=target["path"], table=target.get("table"), catalog="catalog" in target).count() == 1000


def test_a_swap_that_died_between_its_renames(spark, scratch, routed):
    replace_table(routed, path=f"{scratch}/t")
    Folders(spark, scratch).rename(f"{scratch}/t", f"{scratch}/_t-old")  # and there the driver died
    assert read_table(spark, path=f"{scratch}/t").count() == 1000
    Folders(spark, scratch).rename(f"{scratch}/t", f"{scratch}/_t-old")
    replace_table(routed.limit(7), path=f"{scratch}/t")
    assert read_table(spark, path=f"{scratch}/t").count() == 7 and os.listdir(scratch) == ["t"]
    assert current_folder(spark, f"{scratch}/nothing") == f"{scratch}/nothing"


def test_catalog_table_changes_its_folder(spark, scratch, routed, table):
    first = replace_catalog_table(routed, table, f"{scratch}/base")
    reader = spark.table(table)  # planned on the first folder
    second = replace_catalog_table(routed.limit(10), table, f"{scratch}/base")
    assert first != second and table_location(spark, table) == second
    assert spark.table(table).count() == 10 and reader.count() in (10, 1000)
    assert Folders(spark, scratch).exists(first)  # for readers that still run
    with pytest.raises(Exception, match="broken row"):
        replace_catalog_table(broken(routed), table, f"{scratch}/base")
    assert spark.table(table).count() == 10
    replace_catalog_table(routed.limit(20), table, f"{scratch}/base")
    assert spark.table(table).count() == 20
    assert not Folders(spark, scratch).exists(first) and Folders(spark, scratch).exists(second)


def test_catalog_table_takes_other_columns(spark, scratch, routed, table):
    replace_catalog_table(routed, table, f"{scratch}/base")
    replace_catalog_table(routed.select("ticket_id", F.lit(1).alias("n")), table, f"{scratch}/base")
    assert spark.table(table).dtypes == [("ticket_id", "string"), ("n", "int")] and spark.table(table).count() == 1000
    assert not spark.catalog.tableExists(f"{table}_next")


def test_guards_hold_for_the_catalog(spark, scratch, routed, table):
    assert replace_table(routed.where("false"), path=f"{scratch}/b", table=table, catalog=True) is False
    assert not spark.catalog.tableExists(table) and table_location(spark, table) is None


def test_append_by_ddl_and_by_name(spark, scratch, routed, table):
    """The table is made once, its rows keep their columns whatever the input's order."""
    shuffled = routed.select(*reversed(routed.columns), F.lit(1).alias("extra"))
    append_columnar(shuffled, path=f"{scratch}/t", table=table, catalog=True, load_id="a")
    made = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    append_columnar(shuffled, path=f"{scratch}/t", table=table, catalog=True)  # a load id of its own
    assert spark.sql(f"SHOW CREATE TABLE {table}").first()[0] == made and "PARTITIONED BY (load_id)" in made
    got = read_table(spark, table=table, catalog=True)
    assert got.count() == 2000 and got.columns == routed.columns
    assert got.exceptAll(routed.unionByName(routed)).isEmpty()


def test_a_new_catalog_finds_the_loads_of_the_folder(spark, scratch, routed, table):
    append_columnar(routed, path=f"{scratch}/t", table=table, catalog=True, load_id="a")
    spark.sql(f"DROP TABLE {table}")
    append_columnar(routed, path=f"{scratch}/t", table=table, catalog=True, load_id="b")
    assert {r.load_id: r["count"] for r in spark.table(table).groupBy("load_id").count().collect()} == {"a": 1000, "b": 1000}


@pytest.mark.parametrize("catalog", [False, True])
def test_a_load_that_died_and_ran_again_equals_one_load(spark, scratch, sf001, table, catalog):
    dirty = fx.dirty_tickets(spark, sf001)
    write_parquet(dirty, f"{scratch}/export")
    where = {"path": f"{scratch}/t", "table": table, "catalog": catalog}
    load_columnar(spark, f"{scratch}/export", load_id="monday", **where)
    with pytest.raises(Exception, match="broken row"):
        append_columnar(broken(clean_for_warehouse(dirty)), load_id="tuesday", **where)
    left = f"{scratch}/t/load_id=tuesday"  # files of a first try that were moved already
    os.makedirs(left, exist_ok=True)
    for i, f in enumerate(sorted(glob.glob(f"{scratch}/t/load_id=monday/*.parquet"))[:1]):
        os.link(f, f"{left}/part-9000{i}.parquet")
    n = load_columnar(spark, f"{scratch}/export", load_id="tuesday", **where).rows
    rows = read_table(spark, path=where["path"], table=table, catalog=catalog)
    assert rows.count() == 2 * n == 2 * clean_for_warehouse(dirty).count()
    load_columnar(spark, f"{scratch}/export", load_id="tuesday", **where)
    assert read_table(spark, path=where["path"], table=table, catalog=catalog).count() == 2 * n
