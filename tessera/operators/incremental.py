"""Full-row distinct of a table that grows by batches.

Removing the duplicates of the whole export anew for every batch shuffles all
rows ever exported. Here the distinct rows stay where they are and a table of
their keys is kept beside them, bucketed by key in the catalog. A batch is
collapsed first (its hot rows leave each map task once), then meets the key
table bucket by bucket: Spark shuffles the batch to the table's buckets and
reads the table's files as they lie. Rows whose key is new are added, with
their keys.

The key is a SHA-256 digest of all columns (null told from text, columns from
each other), so the key table holds one short text a row and no row is read
again to compare it. Batches have ids: a batch that failed half-way and runs
again overwrites its own rows and keys, and is compared with the others' only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.quality import COPIES, row_copies
from tessera.sinks.swap import quoted, recover_partitions

KEY, BATCH = "row_key", "batch_id"


def row_key(df: DataFrame) -> F.Column:
    """Digest of a whole row of ``df``; equal rows have equal keys, nulls too."""

    def text(field: T.StructField) -> F.Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(column)
        if isinstance(field.dataType, T.BinaryType):
            return F.hex(column)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = F.when(column == 0, F.lit(0).cast(field.dataType)).otherwise(column)  # -0.0 equals 0.0
        return column.cast("string")

    return F.sha2(F.to_json(F.array(*[text(f) for f in df.schema])), 256)


class DistinctStore:
    """The distinct rows under ``path`` and their keys in the catalog table ``table``."""

    def __init__(self, spark: SparkSession, path: str, table: str, buckets: int = 200):
        self.spark, self.path, self.table, self.buckets = spark, path.rstrip("/"), table, buckets

    def _create(self) -> None:
        if self.spark.catalog.tableExists(self.table):
            return
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {quoted(self.table)} ({KEY} STRING, {BATCH} STRING) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/keys'"
        )
        recover_partitions(self.spark, self.table, f"{self.path}/keys")

    def new_rows(self, batch: DataFrame, batch_id: str | None = None) -> DataFrame:
        """The distinct rows of ``batch`` that no (other) batch brought, with their keys."""
        self._create()
        known = self.spark.table(self.table)
        if batch_id is not None:
            known = known.where(F.col(BATCH) != batch_id)
        fresh = row_copies(batch).drop(COPIES)
        return fresh.withColumn(KEY, row_key(fresh)).join(known.select(KEY), KEY, "left_anti")

    def add(self, batch: DataFrame, batch_id: str) -> None:
        """Add a batch: its new rows first, then their keys."""
        own = f"{self.path}/rows/{BATCH}={batch_id}"
        self.new_rows(batch, batch_id).write.mode("overwrite").parquet(own)
        keys = self.spark.read.schema(f"{KEY} string").parquet(own).repartition(self.buckets, KEY)  # a task writes one bucket
        safe = batch_id.replace("'", "''")
        self.spark.sql(f"INSERT OVERWRITE TABLE {quoted(self.table)} PARTITION ({BATCH} = '{safe}') SELECT {KEY} FROM {{keys}}", keys=keys)

    def rows(self, columns) -> DataFrame:
        """All distinct rows so far. Columns of batches that lack some are null."""
        found = self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")
        return found.select(*columns)
