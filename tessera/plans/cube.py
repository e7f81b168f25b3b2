"""Dashboard counts that grow with the exports.

Counting the whole table again for every dashboard costs a scan of everything
ever exported. All dashboard figures are counts, and counts add up: each update
groups only the part files that came since the last one, by the four dashboard
dimensions together, and keeps the result as a small table; a dashboard sums
the updates' rows when it is read.

Layout under the cube's folder: ``counts/update=N`` (one row a combination),
``files/update=N`` (the part files counted), and ``log/update=N``, written last.
Only logged updates are read. An update that dies before its log entry is not
there, and the next one takes its number and overwrites what it left, so a file
is counted once, whenever an update fails.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tickets import calendar_day, text_to_timestamp
from tessera.sources.files import list_data_files, read_parquet_dir

DIMENSIONS = ("priority", "request_type", "assigned_team", "day")
_COUNTS = "priority string, request_type string, assigned_team string, day date, n bigint"

CUBE_SQL = {
    "tickets_by_priority": "SELECT priority, sum(n) AS n FROM {cube} WHERE priority IS NOT NULL GROUP BY priority",
    "tickets_by_request_type": "SELECT request_type, sum(n) AS n FROM {cube} WHERE request_type IS NOT NULL GROUP BY request_type",
    "tickets_by_team": "SELECT assigned_team, sum(n) AS n FROM {cube} WHERE assigned_team IS NOT NULL GROUP BY assigned_team",
    "team_priority": """SELECT assigned_team, priority, sum(n) AS n FROM {cube}
        WHERE assigned_team IS NOT NULL AND priority IS NOT NULL GROUP BY assigned_team, priority""",
    "team_day": """SELECT assigned_team, day, sum(n) AS n FROM {cube}
        WHERE assigned_team IS NOT NULL AND day IS NOT NULL GROUP BY assigned_team, day""",
}


def updates(spark: SparkSession, cube_dir: str) -> list[int]:
    """Numbers of the logged updates, ascending."""
    try:
        log = spark.read.schema("value string, update int").text(f"{cube_dir.rstrip('/')}/log")
        return sorted(r["update"] for r in log.select("update").distinct().collect())
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return []
        raise


def _read(spark: SparkSession, cube_dir: str, kind: str, schema: str, logged: list[int]) -> DataFrame:
    if not logged:
        columns = [f.split() for f in schema.split(", ")]
        return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])
    return spark.read.schema(schema).parquet(*[f"{cube_dir.rstrip('/')}/{kind}/update={k}" for k in logged])


def _relative(export_dir: str):
    """A part file's name below the export folder, whatever the path's form."""
    return F.substring_index("path", f"{export_dir.rstrip('/')}/", -1).alias("file")


def pending_files(spark: SparkSession, export_dir: str, cube_dir: str, logged: list[int] | None = None) -> DataFrame:
    """(path, file) of the part files that no logged update has counted."""
    logged = updates(spark, cube_dir) if logged is None else logged
    listed = list_data_files(spark, export_dir, "*.parquet").select("path", _relative(export_dir))
    return listed.join(_read(spark, cube_dir, "files", "file string", logged), "file", "left_anti").select("path", "file")


def update_cube(spark: SparkSession, export_dir: str, cube_dir: str) -> list[str]:
    """Count the part files that came since the last update; returns them.

    Only those files are opened, and of them four columns. The files' names pass
    through the driver, as they do to plan any scan.
    """
    cube = cube_dir.rstrip("/")
    logged = updates(spark, cube_dir)
    new = sorted(tuple(r) for r in pending_files(spark, export_dir, cube_dir, logged).collect())
    if not new:
        return []
    number = logged[-1] + 1 if logged else 0
    day = calendar_day(text_to_timestamp("created_at", "lenient")).alias("day")
    counts = read_parquet_dir(spark, [path for path, _ in new]).select(*DIMENSIONS[:3], day).groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(f"{cube}/counts/update={number}")
    names = spark.range(1, numPartitions=1).select(F.explode(F.array(*[F.lit(name) for _, name in new])).alias("file"))
    names.write.mode("overwrite").parquet(f"{cube}/files/update={number}")
    spark.range(1, numPartitions=1).select(F.lit(f"{len(new)} files").alias("value")).write.mode("overwrite").text(f"{cube}/log/update={number}")
    return [path for path, _ in new]


def read_cube(spark: SparkSession, cube_dir: str) -> DataFrame:
    """All logged counts: a combination has a row for each update it occurs in."""
    return _read(spark, cube_dir, "counts", _COUNTS, updates(spark, cube_dir))


def dashboard_from_cube(spark: SparkSession, cube_dir: str, name: str) -> DataFrame:
    """One dashboard statement, merged from the updates' counts."""
    return spark.sql(CUBE_SQL[name], cube=read_cube(spark, cube_dir))
