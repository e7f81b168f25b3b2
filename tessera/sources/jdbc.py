"""Reading a loaded table back.

With ``jdbc`` options the table is read through Spark's JDBC source, split
into ``numPartitions`` range reads when a partition column is given. Without
them the table is a Parquet folder written by ``sinks.tables``, or a table of
Spark's catalog (``catalog``). The column that tells the loads of an appended
table apart is no column of the table's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sinks.swap import current_folder
from tessera.sinks.tables import LOAD_ID


def read_table(spark: SparkSession, *, path: str | None = None, jdbc: dict | None = None, table: str | None = None, catalog: bool = False) -> DataFrame:
    if jdbc:
        options = dict(jdbc)
        if table and "dbtable" not in options and "query" not in options:
            options["dbtable"] = table
        return spark.read.format("jdbc").options(**options).load()
    if catalog and table:
        return spark.table(table).drop(LOAD_ID)
    if not path:
        raise ValueError("give a folder path or jdbc options")
    return spark.read.parquet(current_folder(spark, path)).drop(LOAD_ID)
