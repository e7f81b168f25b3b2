"""Combining inputs and laying rows out for storage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames, allow_missing: bool = True) -> DataFrame:
    """UNION ALL matching columns by name; a column absent from one input
    is null there. No shuffle: the inputs' partitions are simply concatenated."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def sort_for_storage(df: DataFrame, column: str = "created_at", tie_breaker: str = "ticket_id", partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``column`` so each written file covers
    one slice of it and Parquet min/max statistics can skip row groups.

    ``tie_breaker`` follows in the key, so one ``column`` value held by a third
    of all rows is still spread over many range partitions instead of landing
    in one. Two short columns are all that the sampled keys, which pass through
    the driver, hold of a row.
    """
    keys = [c for c in (column, tie_breaker) if c in df.columns]
    ordered = [F.col(c).asc_nulls_first() for c in keys]
    parted = df.repartitionByRange(partitions, *ordered) if partitions else df.repartitionByRange(*ordered)
    return parted.sortWithinPartitions(*ordered)
