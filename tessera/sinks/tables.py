"""Table loads: relational replace (K6) and column-store append (K7).

With ``jdbc`` options the rows go through Spark's JDBC writer; every task
opens its own connection, so ``numPartitions`` and ``batchsize`` in the
options bound the load on the database. Without them the table is a Parquet
folder (for example under the shared folder of the cluster), or a table of
Spark's catalog with its files under such a folder. Both replace a table
without a moment at which a failure could lose it (``sinks.swap``), and append
under a load id, so that a load run again takes the place of its first try.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators.layout import sort_for_storage
from tessera.operators.quality import has_key_column, is_empty
from tessera.schemas import DEFAULT_TABLE, ENRICHED_FIELDS
from tessera.sinks.swap import quoted, recover_partitions, replace_catalog_table, replace_folder

# --- Fixed value ---------------------------------------------------------------
# The column-store table definition tail the original load creates its table
# with (engine, and rows kept sorted by the creation text).
COLUMNAR_TABLE_OPTIONS = "ENGINE = MergeTree() ORDER BY created_at"

#: Partition column of tables that are appended to under load ids.
LOAD_ID = "load_id"


def _jdbc_writer(df: DataFrame, jdbc: dict, table: str):
    options = dict(jdbc)
    options.setdefault("dbtable", table)
    return df.write.format("jdbc").options(**options)


def loadable(df: DataFrame) -> bool:
    """C10 + C11: the table has a key column and at least one row."""
    return has_key_column(df) and not is_empty(df)


def replace_table(
    df: DataFrame,
    *,
    path: str | None = None,
    jdbc: dict | None = None,
    table: str = DEFAULT_TABLE,
    truncate: bool = False,
    guard: bool = True,
    catalog: bool = False,
) -> bool:
    """K6: replace the table with ``df`` as it is (no cleaning).

    Nothing is written when ``df`` is empty (C10) or lacks ``ticket_id``
    (C11); returns whether a write happened. Write errors propagate.
    A JDBC table is dropped and made anew, definition included; ``truncate``
    keeps its definition instead. A folder is swapped for one written aside;
    with ``catalog`` the catalog table ``table`` is pointed to a new folder
    under ``path``. Either way a load that fails leaves the table as it was.
    ``guard=False`` skips the checks when the caller has made them.
    """
    if guard and not loadable(df):
        return False
    if jdbc:
        _jdbc_writer(df, jdbc, table).option("truncate", str(truncate).lower()).mode("overwrite").save()
    elif path and catalog:
        replace_catalog_table(df, table, path)
    elif path:
        replace_folder(df, path)
    else:
        raise ValueError("give a folder path or jdbc options")
    return True


def create_columnar_table(spark: SparkSession, table: str, path: str, columns=ENRICHED_FIELDS) -> bool:
    """K7: create the catalog table if it is absent; True if it was. Its
    columns are text, and its rows lie in one partition for each load."""
    if spark.catalog.tableExists(table):
        return False
    fields = ", ".join(f"{quoted(c)} STRING" for c in (*columns, LOAD_ID))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({fields}) USING parquet PARTITIONED BY ({LOAD_ID}) LOCATION '{path}'")
    recover_partitions(spark, table, path)  # loads of an earlier catalog
    return True


def append_columnar(
    df: DataFrame,
    *,
    path: str | None = None,
    jdbc: dict | None = None,
    table: str = DEFAULT_TABLE,
    order_column: str = "created_at",
    columns=ENRICHED_FIELDS,
    table_options: str = COLUMNAR_TABLE_OPTIONS,
    observation: Observation | None = None,
    load_id: str | None = None,
    catalog: bool = False,
) -> None:
    """K7: create the table if absent, then append ``df``.

    With a ``load_id`` the rows are the table's partition of that load: a load
    that was killed half-way and runs again overwrites what it left (and
    nothing else), while another load id adds rows. With ``catalog`` the table
    is ``table`` in the catalog, made by DDL with its files under ``path`` and
    filled by ``INSERT ... BY NAME``; a load id is then made up where none is
    given.

    Columns are selected by name first, so the insert never depends on the
    input's column order. Rows are range-partitioned and sorted on
    ``order_column`` (O5) before the write, so each appended file covers one
    slice of it. ``observation`` collects the written row count; it sits
    above the range exchange, so the partitioner's sampling pass is not
    counted.
    """
    ordered = sort_for_storage(df.select(*columns), order_column)
    if observation is not None:
        ordered = ordered.observe(observation, F.count(F.lit(1)).alias("rows"))
    if jdbc:
        _jdbc_writer(ordered, jdbc, table).option("createTableOptions", table_options).mode("append").save()
    elif path and catalog:
        create_columnar_table(df.sparkSession, table, path, columns)
        load = (load_id or uuid.uuid4().hex).replace("'", "''")
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {quoted(table)} PARTITION ({LOAD_ID} = '{load}') BY NAME SELECT * FROM {{rows}}", rows=ordered)
    elif path and load_id is not None:
        marked = ordered.withColumn(LOAD_ID, F.lit(load_id))
        marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_ID).parquet(path)
    elif path:
        ordered.write.mode("append").parquet(path)
    else:
        raise ValueError("give a folder path or jdbc options")
