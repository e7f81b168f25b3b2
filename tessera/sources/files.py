"""File sources for exported tickets.

Directories are read whole by Spark's file sources: splits follow
``spark.sql.files.maxPartitionBytes``, and a directory written by a streaming
sink is read through its ``_spark_metadata`` log, so files of an aborted
attempt are not counted.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.schemas import ENRICHED_SCHEMA
from tessera.sources.mixed import merged_schema, read_mixed_parquet


class NoDataError(FileNotFoundError):
    """A folder exists but holds no data file of the expected kind."""


def _missing_path(exc: AnalysisException) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def read_parquet_dir(spark: SparkSession, path, merge_schema: bool = True, schema=None) -> DataFrame:
    """S3: all Parquet part files of one or more folders as one table.

    ``mergeSchema`` gives the union of the files' columns, null where a file
    lacks one, as concatenating per-file frames would (one distributed pass
    over the footers). With an explicit ``schema`` no footer is read up front.
    Folder names such as ``batch_id=3`` are no columns, and nested folders are
    read as the listing (``list_data_files``) lists them. Files that give a
    column different types are read in groups and cast (``sources.mixed``).
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        return reader.schema(schema).parquet(*paths)
    if not merge_schema:
        return reader.option("mergeSchema", "false").parquet(*paths)
    merged = merged_schema(spark, paths)  # the pass over the footers
    if merged is not None:
        return reader.schema(merged).parquet(*paths)
    return read_mixed_parquet(spark, [f for p in paths for f in data_file_names(spark, p)])


def read_json_dir(spark: SparkSession, path, schema=ENRICHED_SCHEMA, mode: str = "PERMISSIVE") -> DataFrame:
    """JSON Lines part files with an explicit schema.

    The schema keeps every field a string (no guessing of numbers or dates)
    and restores columns the JSON writer left out because they were null.
    A corrupt line gives a row of nulls (``PERMISSIVE``; ``json_rejects``
    counts them) or fails the job (``FAILFAST``).
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).options(mode=mode, recursiveFileLookup="true").json(paths)


def json_rejects(spark: SparkSession, path, schema=ENRICHED_SCHEMA) -> DataFrame:
    """One row, ``lines`` and ``rejected``: lines of JSON part files, and those
    that are no JSON object. (Blank lines are no records and do not count.)"""
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).where(F.trim("value") != "")
    marked = StructType([*schema.fields, StructField("_corrupt", StringType())])
    parsed = F.from_json("value", marked, {"columnNameOfCorruptRecord": "_corrupt"})
    return lines.select(parsed["_corrupt"].isNotNull().alias("bad")).agg(F.count(F.lit(1)).alias("lines"), F.count_if("bad").alias("rejected"))


def list_data_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Data files under ``path`` matching ``pattern``, without reading them.

    Only the ``path`` column is selected, so file contents are never loaded.
    Raises ``FileNotFoundError`` when the folder does not exist.
    """
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(path)
        )
    except AnalysisException as exc:
        if _missing_path(exc):
            raise FileNotFoundError(f"folder not found: {path}") from exc
        raise
    return listing.select("path")


def data_file_names(spark: SparkSession, path: str, pattern: str = "*.parquet") -> list[str]:
    """The listed files by name, on the driver (which holds them anyway to plan a scan)."""
    return [row["path"] for row in list_data_files(spark, path, pattern).collect()]


def footer_row_count(spark: SparkSession, path, schema) -> DataFrame:
    """A6 from the files' footers: one row, ``n_rows``.

    The scan pushes COUNT(*) down to Parquet, so a task opens a file's footer
    and reads no page of it. That takes Spark's newer Parquet source, which is
    chosen in a session of its own: settings of the caller's stay as they are.
    """
    session = spark.newSession()
    v1 = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    paths = [path] if isinstance(path, str) else list(path)
    scan = session.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)
    # without a row group the pushed-down count is null, not 0; greatest() skips nulls
    return scan.agg(F.greatest(F.count(F.lit(1)), F.lit(0)).alias("n_rows"))


def has_data_files(spark: SparkSession, path: str, pattern: str) -> bool:
    """True when at least one matching file exists (lists, reads one name)."""
    try:
        return not list_data_files(spark, path, pattern).isEmpty()
    except FileNotFoundError:
        return False


def load_exports(spark: SparkSession, parquet_dir: str, json_dir: str, schema=ENRICHED_SCHEMA, json_mode: str = "FAILFAST") -> DataFrame:
    """S5 + S6: the exported tickets, Parquet first, else JSON, else an error.

    Raises ``NoDataError`` (a ``FileNotFoundError``) when neither folder holds
    a data file; a missing folder counts as empty here, as the original
    loader creates both folders before looking.

    Parquet files keep all their own columns, so a column that no file has is
    missing and not null, and rows that differ in an extra column stay apart.
    JSON files are read with the explicit ``schema`` (the JSON writer leaves
    null fields out), and a corrupt line fails the job unless ``json_mode``
    says otherwise. Export folders (``batch_id=N``) give no column.
    """
    if has_data_files(spark, parquet_dir, "*.parquet"):
        return read_parquet_dir(spark, parquet_dir)
    if has_data_files(spark, json_dir, "*.json"):
        return read_json_dir(spark, json_dir, schema, json_mode)
    raise NoDataError(f"no .parquet file in {parquet_dir} and no .json file in {json_dir}")


def load_parquet_exports(spark: SparkSession, parquet_dir: str, schema=None) -> tuple[DataFrame, int]:
    """S3 + S6 + A7 as the database loaders use it: the rows, and the number
    of files from the same listing. A missing folder and an empty folder are
    two distinct errors. ``schema`` saves the pass over the footers where the
    caller knows the files' columns."""
    files = list_data_files(spark, parquet_dir, "*.parquet").count()  # raises if the folder is missing
    if not files:
        raise NoDataError(f"no .parquet file in {parquet_dir}")
    return read_parquet_dir(spark, parquet_dir, schema=schema), files
