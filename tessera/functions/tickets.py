"""Column functions for ticket messages.

Every function returns a ``Column`` built from Spark's own expressions, so a
plan that uses them stays inside whole-stage code generation: no Python UDF
is involved anywhere in the ticket path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import DEFAULT_TEAM, MESSAGE_FIELDS, MESSAGE_SCHEMA, TEAM_BY_REQUEST_TYPE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(value="value") -> Column:
    """Message bytes as UTF-8 text."""
    return _col(value).cast("string")


def parse(text="value", schema=MESSAGE_SCHEMA, strict: bool = False) -> Column:
    """JSON text to a struct of the message schema.

    Permissive (default): malformed, empty, truncated, top-level array or null
    input gives a struct of nulls and the row is kept. (No option map: with
    one, Catalyst would not prune the fields that nobody reads.) Strict: the
    first record that is not a JSON object fails the job; empty, blank and
    null messages and top-level arrays or scalars included.
    """
    c = _col(text)
    if not strict:
        return F.from_json(c, schema)
    message = F.concat(F.lit("MALFORMED message, no JSON object: "), F.coalesce(c, F.lit("null")))
    checked = F.when(F.ltrim(c).startswith("{"), c).otherwise(F.raise_error(message).cast("string"))
    return F.from_json(checked, schema, {"mode": "FAILFAST"})


def route_team(request_type="request_type") -> Column:
    """Team for a request type (P5): exact, case-sensitive match, else the default team."""
    rt = _col(request_type)
    branches = None
    for kind, team in TEAM_BY_REQUEST_TYPE:
        branches = F.when(rt == kind, team) if branches is None else branches.when(rt == kind, team)
    return branches.otherwise(DEFAULT_TEAM)


def encode(fields=MESSAGE_FIELDS) -> Column:
    """Row as JSON message bytes (P12). Null fields are left out of the object."""
    return F.to_json(F.struct(*[_col(f) for f in fields])).cast("binary")


def text_to_timestamp(text="created_at", mode: str = "lenient") -> Column:
    """Ticket time text to ``timestamp_ntz``.

    ``lenient`` gives null for text that does not parse; ``strict`` fails the
    job on it, with or without ANSI mode. The all-or-nothing ``skip`` mode of
    the daily series is decided at the job level, see
    ``operators.metrics.tickets_per_day``.
    """
    c = _col(text)
    parsed = c.try_cast("timestamp_ntz")
    if mode == "strict":
        # fail explicitly, whatever the session's ANSI setting
        message = F.concat(F.lit("time text does not parse: "), c)
        return F.when(c.isNotNull() & parsed.isNull(), F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)
    if mode == "lenient":
        return parsed
    raise ValueError(f"unknown date mode {mode!r}")


def timestamp_text(ts, separator: str = " ") -> Column:
    """``yyyy-MM-dd<separator>HH:mm:ss`` text of a ``timestamp_ntz`` value.

    Built from the value's own text form rather than ``date_format``, which
    passes the wall-clock time through the session time zone and so shifts
    times that fall in a daylight-saving gap there.
    """
    text = _col(ts).cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit(separator), F.substring(text, 12, 8))


def export_time_text(text="created_at", mode: str = "lenient", ts: Column | None = None, zone: Column | None = None) -> Column:
    """A ticket time text as the CSV export writes it:
    ``yyyy-MM-dd HH:mm:ss``, then the fraction in six digits where there is
    one, then the zone offset where the text has one (``Z`` as ``+00:00``).
    Null where the text does not parse (``lenient``). ``ts`` and ``zone`` are
    the time and the offset of a text that was read by a format of its own."""
    c = _col(text)
    value = (text_to_timestamp(c, mode) if ts is None else ts).cast("string")
    fraction = F.substring(value, 20, 7)
    offset = F.regexp_extract(c, r":\d{2}(?:\.\d+)?\s*([Zz]|[+-]\d{2}(?::?\d{2})?)\s*$", 1) if zone is None else zone
    digits = F.rpad(F.regexp_replace(offset, r"[^0-9]", ""), 4, "0")
    shown = F.when(offset == "", "").when(F.upper(offset) == "Z", "+00:00").otherwise(F.concat(F.substring(offset, 1, 1), F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2)))
    return F.concat(F.substring(value, 1, 10), F.lit(" "), F.substring(value, 12, 8), F.when(fraction == "", "").otherwise(F.rpad(fraction, 7, "0")), shown)


def time_shape(text="created_at") -> Column:
    """The form of a time text: digits as 9, a fraction as .f. A column in one
    format has one shape; the ``skip`` date mode asks for that."""
    plain = F.regexp_replace(_col(text), r"\.\d+", ".f")
    return F.regexp_replace(F.regexp_replace(plain, r"\d", "9"), r"[+-]99:?99$", "+9999")


def calendar_day(ts) -> Column:
    """Calendar date of a timestamp (P10)."""
    return F.to_date(_col(ts))
