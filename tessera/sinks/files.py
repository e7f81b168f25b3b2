"""File sinks: Parquet, JSON Lines, CSV, text summary, chart tables.

Every writer writes a folder of part files, one per task; nothing is funnelled
through a single task or the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import SUMMARY_SECTIONS

# CSV dialect: quotes doubled (not backslash-escaped), spaces kept, empty text
# written as "" and null as \N, so a round trip gives back exactly the rows
# (line breaks, commas, quotes, backslashes and any Unicode included). The one
# value that cannot survive is text that is exactly \N: it is the null marker.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss",
}
CSV_READ_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "multiLine": "true",
}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int = 2_000_000) -> None:
    """K4: CSV with a header and no index column; a folder of part files. Line
    breaks inside quotes make a file unsplittable on reading, so a task starts
    a new file every ``max_records_per_file`` rows."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).option("maxRecordsPerFile", str(max_records_per_file)).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a folder written by ``write_csv`` back with an explicit schema."""
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(path)


def summary_lines(summary: DataFrame, sections=SUMMARY_SECTIONS) -> DataFrame:
    """K5 content: a heading per section, one ``value: n`` line per value
    (count descending, then value), a blank line after each section.

    ``summary`` is the (dimension, value, n) table of
    ``operators.metrics.distribution_summary``. Returns (section, part,
    neg_n, value, line); ordering by the first four gives the text in order.
    The headings and blank lines are a fixed six-row frame added by union.
    """
    spark = summary.sparkSession
    order = {d: i for i, (d, _) in enumerate(sections)}
    section = F.coalesce(*[F.when(F.col("dimension") == d, F.lit(i)) for d, i in order.items()])
    body = summary.select(
        section.alias("section"),
        F.lit(1).alias("part"),
        (-F.col("n")).alias("neg_n"),
        F.col("value"),
        F.format_string("%s: %d", F.col("value"), F.col("n")).alias("line"),
    ).where(F.col("section").isNotNull())
    # Headings and blank lines, built on the JVM side (a Python-list frame
    # would start Python workers for six rows).
    fixed = [
        F.struct(
            F.lit(i).alias("section"),
            F.lit(p).alias("part"),
            F.lit(0).cast("long").alias("neg_n"),
            F.lit("").alias("value"),
            F.lit(text).alias("line"),
        )
        for i, (_, label) in enumerate(sections)
        for p, text in ((0, f"{label} :"), (2, ""))
    ]
    frame = spark.range(1).select(F.inline(F.array(*fixed)))
    return body.unionByName(frame)


def write_summary_text(summary: DataFrame, path: str, sections=SUMMARY_SECTIONS) -> None:
    """K5: the summary as UTF-8 text lines, in order across the part files."""
    lines = summary_lines(summary, sections)
    lines.orderBy("section", "part", "neg_n", "value").select("line").write.mode("overwrite").text(path)


def write_chart_tables(tables: dict, root: str) -> dict:
    """The small tables behind the charts, one Parquet folder each."""
    paths = {}
    for name, df in tables.items():
        if df is None:
            continue
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
