"""Message decoding, parsing, flattening, routing and encoding.

All steps are projections: no shuffle, no Python, one whole-stage-codegen
span per stage. The same functions serve the stream and batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.tickets import decode, encode, parse, route_team
from tessera.schemas import MESSAGE_FIELDS, MESSAGE_SCHEMA


def parse_messages(df: DataFrame, value: str = "value", strict: bool = False, keep=(), schema=MESSAGE_SCHEMA) -> DataFrame:
    """Message bytes or text to one column per message field.

    ``keep`` names input columns carried through unchanged (for example a
    Kafka offset or timestamp).
    """
    kept = [F.col(c) for c in keep]
    parsed = df.select(*kept, parse(decode(value), schema=schema, strict=strict).alias("_msg"))
    return parsed.select(*kept, "_msg.*")


def assign_team(df: DataFrame, request_type: str = "request_type", team: str = "assigned_team") -> DataFrame:
    """Add (or replace) the routed team column."""
    return df.withColumn(team, route_team(request_type))


def enrich_messages(df: DataFrame, value: str = "value", strict: bool = False, keep=()) -> DataFrame:
    """Parse and route in one projection: the stream export's transformation."""
    return assign_team(parse_messages(df, value=value, strict=strict, keep=keep))


def encode_messages(df: DataFrame, fields=MESSAGE_FIELDS, key: str | None = None) -> DataFrame:
    """Rows to a message log (``key``, ``value`` bytes), the shape a topic holds."""
    # keys of any type become their UTF-8 text (numbers cannot cast to bytes directly)
    key_col = F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")
    return df.select(key_col.alias("key"), encode(fields).alias("value"))
