"""Distributions, cross-tabulations and series.

Every aggregation here is a hash aggregate with a map-side partial step, so
its shuffle carries at most one row per group per map task, however skewed
the groups are. Outputs are small (one row per distinct value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tickets import calendar_day, text_to_timestamp
from tessera.functions.timeformat import format_of, one_series, ticket_time, unfit
from tessera.schemas import SUMMARY_SECTIONS


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """A1-A3: rows per value of one column; nulls excluded; ordered by count
    descending, ties by value (O1)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc(column))
    )


def tickets_by_priority(df: DataFrame) -> DataFrame:
    return value_counts(df, "priority")


def tickets_by_request_type(df: DataFrame) -> DataFrame:
    return value_counts(df, "request_type")


def tickets_by_team(df: DataFrame) -> DataFrame:
    return value_counts(df, "assigned_team")


def crosstab_long(df: DataFrame, index: str = "assigned_team", columns: str = "priority") -> DataFrame:
    """A4, long form: (index, columns, n) for every pair present; scales to any
    number of values."""
    return (
        df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
        .groupBy(index, columns)
        .agg(F.count(F.lit(1)).alias("n"))
    )


class TooManyValuesError(ValueError):
    """More distinct values than may become columns; use the long form."""


def pivot_values(df: DataFrame, index: str, columns: str, max_values: int | None = None) -> list[str]:
    """Values of ``columns`` present (with a non-null index), sorted.

    These become column names, so they pass through the driver: the count is
    checked against ``spark.sql.pivotMaxValues`` before anything is collected.
    """
    spark = df.sparkSession
    limit = max_values or int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    present = (
        df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
        .select(F.col(columns).cast("string").alias("v"))
        .distinct()
        .orderBy("v")
        .limit(limit + 1)
        .collect()
    )
    if len(present) > limit:
        raise TooManyValuesError(f"{columns} has more than {limit} distinct values; use crosstab_long")
    return [row.v for row in present]


def crosstab(df: DataFrame, index: str = "assigned_team", columns: str = "priority", values=None) -> DataFrame:
    """A4: rows = index values, one count column per value of ``columns``, zero-filled.

    Rows whose index or column value is null are left out, so a team whose
    priorities are all null does not appear.

    ``values`` given: one aggregation, a fixed output schema.
    ``values=None``: the values present in the data, alphabetically. The big
    input is still scanned once: its long form (one row per pair present) is
    aggregated and checkpointed to the shared folder, and both the value list
    and the pivot come from that small table.
    """
    if values is not None:
        values = list(values)
        pivoted = (
            df.where(F.col(index).isNotNull() & F.col(columns).isNotNull())
            .groupBy(index)
            .pivot(columns, values)
            .agg(F.count(F.lit(1)))
        )
        return pivoted.na.fill(0, subset=values) if values else pivoted
    return pivot_long(crosstab_long(df, index, columns).checkpoint(eager=True), index, columns)


def pivot_long(long: DataFrame, index: str = "assigned_team", columns: str = "priority", n: str = "n") -> DataFrame:
    """Wide cross-tab from a small long form (index, columns, n): the values
    present become columns, alphabetically, zero-filled. ``long`` should be
    materialized (checkpointed or written): it is read twice."""
    values = pivot_values(long, index, columns)
    pivoted = long.groupBy(index).pivot(columns, values).agg(F.sum(n))
    return pivoted.na.fill(0, subset=values) if values else pivoted


def _bad_date(column: str) -> F.Column:
    return F.col(column).isNotNull() & text_to_timestamp(column, "lenient").isNull()


def date_rejects(df: DataFrame, column: str = "created_at") -> DataFrame:
    """One row, ``rejected``: rows whose time text is set but does not parse."""
    return df.agg(F.count_if(_bad_date(column)).alias("rejected"))


def rejected_dates(df: DataFrame, column: str = "created_at") -> int:
    """``date_rejects`` as a number."""
    return int(date_rejects(df, column).first().rejected)


def unreadable(counted: DataFrame) -> bool:
    """For the ``skip`` mode: did the counted groups (``bad``, ``shape_lo``,
    ``shape_hi``) hold a text that does not parse, or more than one format?"""
    row = counted.agg(F.sum("bad").alias("bad"), F.min("shape_lo").alias("lo"), F.max("shape_hi").alias("hi")).first()
    return bool(row.bad) or row.lo != row.hi


def tickets_per_day(df: DataFrame, column: str = "created_at", mode: str = "lenient") -> DataFrame | None:
    """A5: tickets per calendar day, ordered by day.

    ``lenient``: text that does not parse is left out (count it with
    ``rejected_dates``). ``strict``: such text fails the job. ``skip``: as
    the original analysis, the first value's format (ISO or another, see
    ``functions.timeformat``) holds for the column, and any text that doesn't
    fit it means no series at all (returns None) while the rest of the job
    carries on. In ``skip`` mode the rejected rows are counted in the same
    aggregation as the days (they form the null-day group), and that small
    result is checkpointed, so the input is scanned once, after a look at its
    first value. ``inferred``: by that format too, but only the texts that
    don't fit are left out.
    """
    fmt = format_of(df, mode, column)
    ts = ticket_time(mode, fmt, column)
    day = calendar_day(ts).alias("day")
    if mode == "skip":
        counted = (
            df.select(day, unfit(ts, mode, column).alias("bad"), one_series(mode, fmt, column).alias("shape"))
            .groupBy("day")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), F.min("shape").alias("shape_lo"), F.max("shape").alias("shape_hi"))
            .checkpoint(eager=True)
        )
        if unreadable(counted):
            return None
        return counted.where(F.col("day").isNotNull()).select("day", "n").orderBy("day")
    if mode not in ("lenient", "strict", "inferred"):
        raise ValueError(f"unknown date mode {mode!r}")
    return df.select(day).where(F.col("day").isNotNull()).groupBy("day").agg(F.count(F.lit(1)).alias("n")).orderBy("day")


def row_count(df: DataFrame) -> int:
    """A6."""
    return df.count()


def row_and_file_counts(counted: DataFrame, files: DataFrame) -> DataFrame:
    """A6 + A7: (n_rows, n_files) of a folder.

    ``counted`` has the folder's ``n_rows`` (``sources.files.footer_row_count``
    takes them from the footers), ``files`` lists its data files
    (``sources.files.list_data_files``), so a part file without rows counts.
    """
    return counted.withColumn("n_files", F.lit(files.count()).cast("long"))


def distribution_summary(df: DataFrame, dimensions=tuple(d for d, _ in SUMMARY_SECTIONS)) -> DataFrame:
    """The per-value counts of several columns in one pass.

    Grouping sets, one per column, over a single scan; returns
    (dimension, value, n) with null values left out, as in A1-A3.
    """
    dims = list(dimensions)
    grouped = df.groupingSets([[d] for d in dims], *dims).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.grouping(d).alias(f"_g_{d}") for d in dims],
    )
    dimension = None
    value = None
    for d in dims:
        is_d = F.col(f"_g_{d}") == 0
        dimension = F.when(is_d, F.lit(d)) if dimension is None else dimension.when(is_d, F.lit(d))
        value = F.when(is_d, F.col(d).cast("string")) if value is None else value.when(is_d, F.col(d).cast("string"))
    return grouped.select(dimension.alias("dimension"), value.alias("value"), "n").where(F.col("value").isNotNull())


def preview(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """O3: the first ``n`` rows; with ``order_by`` a stable, top-k answer."""
    if order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(n)


def register_view(df: DataFrame, name: str) -> SparkSession:
    """Expose a table to SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession
