"""The analysis job (J2): load the exports, clean, profile, count, write reports.

Plan at scale:

1. One shuffle: the distinct rows with their copy counts (``row_copies``).
   The audit (C9) and the null report (C3-C5) are observed on them, and the
   complete rows (C6) go on and are written once, as ``clean_rows`` under the
   output folder. That is an output of the job and cuts the lineage: a lost
   executor later re-reads files instead of redoing the shuffle.
2. One pass over four columns of these rows groups them by priority, request
   type, team and day together. That small result is checkpointed; every chart
   table (K10) and the text summary (K5) is rolled up from it.
3. The rows are written once as CSV (K4).

So the big data is read three times in all: the raw exports (for the
de-duplication shuffle), and the cleaned rows twice (report counts, CSV).
The set of outputs does not depend on the data: no rows give a CSV with a
header only, empty chart tables and a summary without counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tickets import calendar_day, export_time_text
from tessera.functions.timeformat import TimeFormat, format_of, one_series, ticket_time, unfit, zone_text
from tessera.operators.metrics import unreadable
from tessera.operators.quality import COPIES, complete_row, require_columns, row_copies
from tessera.sinks.files import write_chart_tables, write_csv, write_summary_text
from tessera.session import run_concurrently
from tessera.sources.files import load_exports


@dataclass
class AnalysisResult:
    audit: dict
    null_report: dict
    columns: list = field(default_factory=list)  # P13; rows (A6) are in ``audit``
    paths: dict = field(default_factory=dict)
    daily_skipped: bool = False


def csv_ready(clean: DataFrame, date_mode: str, any_rejected: bool | None = None, fmt: TimeFormat | None = None) -> DataFrame:
    """Cleaned rows as exported: ``created_at`` rewritten as
    ``yyyy-MM-dd HH:mm:ss`` with its fraction and zone offset where it has
    them, when it parses. In ``skip`` mode with any text that does not parse,
    or more than one format, the original text is kept for every row
    (``any_rejected`` and ``fmt``, when the caller already knows them, save a
    pass)."""
    if date_mode == "skip" and any_rejected is None:
        fmt = format_of(clean, date_mode)
        any_rejected = unreadable(report_counts(clean, date_mode, fmt))
    elif date_mode == "inferred" and fmt is None:
        fmt = format_of(clean, date_mode)
    if date_mode == "skip" and any_rejected:
        return clean
    if fmt is not None:
        formatted = export_time_text("created_at", ts=ticket_time(date_mode, fmt), zone=zone_text(fmt))
    else:
        formatted = export_time_text("created_at", "strict" if date_mode == "strict" else "lenient")
    return clean.withColumn("created_at", F.coalesce(formatted, F.col("created_at")))


REPORT_COLUMNS = ("priority", "request_type", "assigned_team", "day")


def report_counts(clean: DataFrame, date_mode: str, fmt: TimeFormat | None = None) -> DataFrame:
    """Every count the reports need, in one pass over the cleaned rows:
    (priority, request_type, assigned_team, day, n, bad, shape_lo, shape_hi),
    one row per combination present, a small table. ``bad`` counts time texts
    that do not parse (they fall in the null-day groups); the shapes tell
    whether the texts have one format.
    """
    ts = ticket_time(date_mode, fmt)
    source = clean.select(
        "priority",
        "request_type",
        "assigned_team",
        calendar_day(ts).alias("day"),
        unfit(ts, date_mode).alias("bad"),
        one_series(date_mode, fmt).alias("shape"),
    )
    return source.groupBy(*REPORT_COLUMNS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), F.min("shape").alias("shape_lo"), F.max("shape").alias("shape_hi")
    )


def rolled_up(counts: DataFrame, *columns: str) -> DataFrame:
    """Rows per value (or combination) of ``columns``, nulls left out."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return counts.where(present).groupBy(*columns).agg(F.sum("n").alias("n"))


def summary_from_counts(counts: DataFrame) -> DataFrame:
    """A8's (dimension, value, n) from the report counts; null values left out."""
    parts = [rolled_up(counts, d).select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"), "n") for d in ("priority", "request_type", "assigned_team")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def analyse(spark: SparkSession, parquet_dir: str, json_dir: str, out_dir: str, date_mode: str = "lenient", priorities=None) -> AnalysisResult:
    """Run the job. The team and priority counts are written in long form
    (``team_priority_long``); with ``priorities`` given also as a table with
    one column for each of them (``team_priority``)."""
    out = out_dir.rstrip("/")
    raw = require_columns(load_exports(spark, parquet_dir, json_dir))  # S5, S6, C1
    columns = raw.columns

    # One shuffle: distinct rows with copy counts (C2). The audit (C9) and the
    # null report (C3-C5) are observed above it, in the write's result stage,
    # whose task updates Spark applies exactly once; only complete rows
    # pass on to the write.
    clean_path = f"{out}/clean_rows"
    stats = Observation("analyse_distinct_rows")
    observed_rows = row_copies(raw).observe(
        stats,
        F.coalesce(F.sum(COPIES), F.lit(0)).cast("long").alias("loaded"),
        F.count(F.lit(1)).alias("deduplicated"),
        F.count_if(complete_row(columns)).alias("complete"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)],
    )
    observed_rows.where(complete_row(columns)).select(*columns).write.mode("overwrite").parquet(clean_path)
    observed = stats.get
    audit = {k: int(observed.get(k) or 0) for k in ("loaded", "deduplicated", "complete")}
    report = {c: int(observed[f"nulls_{i}"]) for i, c in enumerate(columns) if observed.get(f"nulls_{i}")}
    clean = spark.read.schema(raw.schema).parquet(clean_path)
    result = AnalysisResult(audit=audit, null_report=report, columns=list(columns))

    # One pass for every report count (A1-A5, A8), kept as a small checkpoint.
    fmt = format_of(clean, date_mode)  # a look at the first time text, in the modes that read by format
    counts = report_counts(clean, date_mode, fmt).checkpoint(eager=True)
    any_rejected = unreadable(counts) if date_mode == "skip" else None
    daily = None if any_rejected else rolled_up(counts, "day").orderBy("day")
    result.daily_skipped = daily is None

    summary = summary_from_counts(counts)
    by_priority = rolled_up(counts, "priority").orderBy(F.desc("n"), "priority")
    long = rolled_up(counts, "assigned_team", "priority")
    tables = {"summary": summary, "by_priority": by_priority, "team_priority_long": long, "by_day": daily}
    if priorities is not None:
        pivoted = long.groupBy("assigned_team").pivot("priority", list(priorities)).agg(F.sum("n"))
        tables["team_priority"] = pivoted.na.fill(0, subset=list(priorities))
    charts = f"{out}/charts"
    writes = {name: (lambda df=df, name=name: write_chart_tables({name: df}, charts)) for name, df in tables.items() if df is not None}
    writes["csv"] = lambda: write_csv(csv_ready(clean, date_mode, any_rejected, fmt), f"{out}/tickets_csv")  # K4
    writes["summary_txt"] = lambda: write_summary_text(summary, f"{out}/summary_txt")  # K5
    run_concurrently(spark, writes)
    result.paths = {name: f"{charts}/{name}" for name, df in tables.items() if df is not None}
    result.paths.update({"csv": f"{out}/tickets_csv", "summary_txt": f"{out}/summary_txt", "clean_rows": clean_path})
    return result
