"""Replacing a table so that a failure leaves the old one (K6).

A load writes its rows aside first; the table changes only when they are all
there. For a folder the change is two renames in the table's file system (the
old folder goes out of the way, the new one takes its place); should the driver
die between them, the next replacement or ``current_folder`` puts the old one
back. For a catalog table the change is its location: readers that planned on
the old folder finish on it, as it is kept until the replacement after.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _sibling(path: str, mark: str) -> str:
    """A folder beside ``path`` that readers of the parent don't see (``_`` first)."""
    parent, name = posixpath.split(path.rstrip("/"))
    return posixpath.join(parent, f"_{name}-{mark}")


class Folders:
    """Renames and deletes in the file system of a path (Hadoop's, so any store Spark writes to)."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._path(path)).toString()


def current_folder(spark: SparkSession, path: str) -> str:
    """``path``, after putting back an old table that a broken swap left beside it."""
    folders, old = Folders(spark, path), _sibling(path, "old")
    if not folders.exists(path) and folders.exists(old):
        folders.rename(old, path)
    return path


def replace_folder(df: DataFrame, path: str) -> None:
    """Replace the Parquet table at ``path`` by ``df``, or leave it as it is."""
    spark = df.sparkSession
    folders, aside, old = Folders(spark, path), _sibling(path, f"new-{uuid.uuid4().hex}"), _sibling(path, "old")
    try:
        df.write.parquet(aside)
    except BaseException:
        folders.delete(aside)
        raise
    current_folder(spark, path)
    if folders.exists(path):
        folders.delete(old)
        folders.rename(path, old)
    try:
        folders.rename(aside, path)
    except BaseException:
        current_folder(spark, path)
        raise
    folders.delete(old)


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.replace("`", "").split("."))


def recover_partitions(spark: SparkSession, table: str, path: str) -> None:
    """Make partitions known that lie in a new table's folder already."""
    if Folders(spark, path).exists(path):
        spark.sql(f"ALTER TABLE {quoted(table)} RECOVER PARTITIONS")


def table_location(spark: SparkSession, table: str) -> str | None:
    """The folder of a catalog table; None where there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def replace_catalog_table(df: DataFrame, table: str, base: str) -> str:
    """Replace the catalog table ``table`` by ``df``; returns its new folder.

    Every replacement writes a folder of its own under ``base``. With the same
    columns the table's location is swapped in one catalog call; other columns
    take a new definition under another name first, which then takes the
    table's name. The folder before the last one goes.
    """
    spark = df.sparkSession
    folders = Folders(spark, base)
    folder = folders.qualified(f"{base.rstrip('/')}/{table.split('.')[-1]}-{uuid.uuid4().hex}")
    try:
        df.write.parquet(folder)
    except BaseException:
        folders.delete(folder)
        raise
    before = table_location(spark, table)
    if before is None:
        spark.sql(f"CREATE TABLE {quoted(table)} ({_definition(df)}) USING parquet LOCATION '{folder}'")
    elif [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION '{folder}'")
    else:
        following = f"{table}_next"
        spark.sql(f"DROP TABLE IF EXISTS {quoted(following)}")
        spark.sql(f"CREATE TABLE {quoted(following)} ({_definition(df)}) USING parquet LOCATION '{folder}'")
        spark.sql(f"DROP TABLE {quoted(table)}")  # external: its files stay
        spark.sql(f"ALTER TABLE {quoted(following)} RENAME TO {quoted(table)}")
    spark.catalog.refreshTable(table)
    if before is not None:
        _drop_superseded(spark, folders, base, before)
    return folder


def _drop_superseded(spark: SparkSession, folders: Folders, base: str, before: str) -> None:
    """Keep the folder just replaced (running readers), delete the one before it."""
    note = f"{base.rstrip('/')}/_superseded"
    if folders.exists(note):
        (last,) = [r[0] for r in spark.read.text(note).collect()]
        if last != before:
            folders.delete(last)
    spark.range(1, numPartitions=1).select(F.lit(before).alias("value")).write.mode("overwrite").text(note)


def _definition(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
