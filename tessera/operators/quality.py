"""Validation and cleaning.

The heavy step is full-row de-duplication: a shuffle keyed on every column.
Spark plans it as a hash aggregate with a map-side partial step, so a row that
occurs millions of times (say the all-null row every malformed message turns
into) collapses to one row per map task before anything crosses the network.
``row_copies`` keeps the number of copies next to each distinct row, so the
audit, the null report and the cleaned table all come out of that one shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.schemas import MESSAGE_FIELDS, PRIORITIES, REQUEST_TYPES, REQUIRED_COLUMNS, missing_columns

COPIES = "__copies"


class MissingColumnsError(ValueError):
    """Raised when a table lacks required columns; ``missing`` lists them."""

    def __init__(self, missing):
        self.missing = list(missing)
        super().__init__(f"missing required columns: {self.missing}")


def require_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Fail, naming every missing column, if a required column is absent.

    A schema check on the driver; no job runs.
    """
    missing = missing_columns(df.columns, required)
    if missing:
        raise MissingColumnsError(missing)
    return df


def has_key_column(df: DataFrame, key: str = "ticket_id") -> bool:
    """C11: the key column is present (schema only)."""
    return key in df.columns


def is_empty(df: DataFrame) -> bool:
    """No rows. Reads at most one row."""
    return df.isEmpty()


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication; nulls compare equal, one copy kept."""
    return df.dropDuplicates()


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop every row with a null in any column. Empty text is not null."""
    return df.na.drop(how="any")


def complete_row(columns) -> F.Column:
    """True when no column of the row is null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def row_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies: the one de-duplication shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column, in one aggregation pass."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "nulls")


def null_profile(df: DataFrame) -> DataFrame:
    """C2 then C3: null counts over the distinct rows (the order the report uses)."""
    return null_counts(distinct_rows(df))


def affected_columns(profile: DataFrame) -> DataFrame:
    """Keep only the columns that hold nulls."""
    return profile.where(F.col("nulls") > 0)


def any_nulls(profile: DataFrame) -> bool:
    """C4: does any column hold a null? Reads one row of a tiny result."""
    return not affected_columns(profile).isEmpty()


def clean_for_analysis(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Column check, de-duplication, then removal of incomplete rows.

    The null removal needs no condition: dropping rows without nulls is a no-op.
    """
    return drop_incomplete(distinct_rows(require_columns(df, required)))


def clean_for_warehouse(df: DataFrame) -> DataFrame:
    """De-duplication then removal of incomplete rows, no column check."""
    return drop_incomplete(distinct_rows(df))


def cleaning_audit(df: DataFrame) -> DataFrame:
    """Rows at start, after de-duplication and after null removal.

    One shuffle: the copy counts of the distinct rows give all three numbers.
    Returns (step, rows).
    """
    copies = row_copies(df)
    counts = copies.agg(
        F.sum(COPIES).cast("long").alias("loaded"),
        F.count(F.lit(1)).alias("deduplicated"),
        F.count_if(complete_row(df.columns)).alias("complete"),
    )
    return counts.unpivot([], ["loaded", "deduplicated", "complete"], "step", "rows")


def contract_rules(fields=MESSAGE_FIELDS) -> list[tuple[str, F.Column]]:
    """One (rule name, violated?) pair per message-contract rule."""
    rules = [(f"{name}_present", F.col(name).isNull()) for name in fields]
    rules.append(("request_type_in_domain", ~F.coalesce(F.col("request_type").isin(*REQUEST_TYPES), F.lit(False))))
    rules.append(("priority_in_domain", ~F.coalesce(F.col("priority").isin(*PRIORITIES), F.lit(False))))
    return rules


def contract_violations(df: DataFrame) -> DataFrame:
    """Number of rows breaking each rule, in one pass. Returns (rule, violations)."""
    rules = contract_rules()
    wide = df.agg(*[F.count_if(violated).alias(name) for name, violated in rules])
    return wide.unpivot([], [name for name, _ in rules], "rule", "violations")
