"""The one format of a column of time texts.

The original conversion takes the format from the first value that is set and
reads every value by it, exactly; one value that doesn't fit means no
conversion. ``infer_format`` does so on a table: the first set value is all that
reaches the driver (a take, which reads no more of the table than it needs),
``guess`` names its format, and ``parsed`` reads the column by it: one regular
expression turns a text into ISO form, so parsing stays in the JVM.

Forms known: year first, or month, day and year (day first where the first
number can't be a month), parted by ``-``, ``/`` or ``.``; eight digits; month
names, full or short; then an optional time after a blank or ``T``, with
seconds, a fraction of up to nine digits, AM or PM, and a zone offset. An
offset is not applied: the day is the text's own.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.tickets import text_to_timestamp, time_shape

#: Texts that stand for "not set" (fixed values of the original conversion).
NOT_SET = ("", "NaT", "nat", "NAT", "nan", "NaN", "NAN")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

#: What each part of a format matches.
_PARTS = {
    "Y": r"(\d{4})",
    "m": r"(1[0-2]|0[1-9]|[1-9])",
    "d": r"(3[01]|[12]\d|0[1-9]|[1-9])",
    "b": "(" + "|".join(m[:3] for m in MONTHS) + ")",
    "B": "(" + "|".join(MONTHS) + ")",
    "H": r"(2[0-3]|[01]\d|\d)",
    "I": r"(1[0-2]|0[1-9]|[1-9])",
    "M": r"([0-5]\d|\d)",
    "S": r"([0-5]\d|\d)",
    "f": r"(\d{1,9})",
    "p": "(am|pm)",
    "z": r"(z|[+-]\d{2}:?[0-5]\d)",
}

class TimeFormat(NamedTuple):
    """A format as its parts in order: letters of ``_PARTS``, and text between them."""

    parts: tuple[str, ...]

    @property
    def expression(self) -> str:
        """A regular expression for a whole text of this format."""
        return "(?i)" + "".join(_PARTS.get(p) or re.escape(p) for p in self.parts)

    @property
    def pattern(self) -> str:
        """The expression as Spark takes it, bound to the text's ends."""
        return self.expression.replace("(?i)", r"(?i)\A") + r"\z"

    @property
    def text(self) -> str:
        """The format in the usual ``%`` notation."""
        return "".join(f"%{p}" if p in _PARTS else p for p in self.parts)

    def group(self, part: str) -> int | None:
        places = [p for p in self.parts if p in _PARTS]
        return places.index(part) + 1 if part in places else None


_TIME = re.compile(r"(?P<gap>[T ])(?P<H>\d{1,2}):(?P<M>\d{2})(?P<sec>:\d{2}(?P<frac>\.\d{1,9})?)?(?P<mer> ?[AaPp][Mm])?(?P<zone> ?(?:Z|[+-]\d{2}:?\d{2}))?", re.ASCII)
_DATES = (
    (re.compile(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})", re.ASCII), lambda m: ("Y", m[2], "m", m[2], "d")),
    (re.compile(r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4})", re.ASCII), lambda m: ("d", m[2], "m", m[2], "Y") if int(m[1]) > 12 else ("m", m[2], "d", m[2], "Y")),
    (re.compile(r"(\d{4})(\d{2})(\d{2})", re.ASCII), lambda m: ("Y", "m", "d")),
    (re.compile(r"([A-Za-z]{3,9}) (\d{1,2})(,?) (\d{4})", re.ASCII), lambda m: (_month(m[1]), " ", "d", f"{m[3]} ", "Y")),
    (re.compile(r"(\d{1,2})([- ])([A-Za-z]{3,9})([- ])(\d{4})", re.ASCII), lambda m: ("d", m[2], _month(m[3]), m[4], "Y")),
)


def _month(name: str) -> str:
    """How a month is written: in three letters, or in full."""
    if name.lower() in MONTHS and len(name) > 3:
        return "B"
    return "B" if name.lower() == "may" else "b" if name.lower() in {m[:3] for m in MONTHS} else "?"


def guess(text: str) -> TimeFormat | None:
    """The format of one time text; None where it has none of the known forms."""
    for pattern, parts_of in _DATES:
        found = pattern.match(text)
        if not found:
            continue
        parts = parts_of(found)
        if "?" in parts:
            continue
        rest = text[found.end() :]
        if rest:
            time = _TIME.fullmatch(rest)
            if not time:
                continue
            parts += (time["gap"], "I" if time["mer"] else "H", ":", "M")
            parts += (":", "S") if time["sec"] else ()
            parts += (".", "f") if time["frac"] else ()
            parts += ((" ", "p") if time["mer"][0] == " " else ("p",)) if time["mer"] else ()
            parts += ((" ", "z") if time["zone"][0] == " " else ("z",)) if time["zone"] else ()
        made = TimeFormat(tuple(parts))
        if re.fullmatch(made.expression, text, re.ASCII):
            return made
    return None


def is_set(text: str = "created_at") -> Column:
    return F.col(text).isNotNull() & ~F.col(text).isin(*NOT_SET)


def first_text(df: DataFrame, column: str = "created_at") -> str | None:
    """The first set value in the table's order."""
    found = df.where(is_set(column)).select(column).first()
    return found[0] if found else None


def infer_format(df: DataFrame, column: str = "created_at") -> TimeFormat | None:
    """The format that the first set value has; None without one."""
    text = first_text(df, column)
    return guess(text) if text is not None else None


def parsed(fmt: TimeFormat, column: str | Column = "created_at") -> Column:
    """The ``timestamp_ntz`` of a text in exactly this format, else null."""
    c = F.col(column) if isinstance(column, str) else column
    pick = lambda part: F.regexp_extract(c, fmt.pattern, fmt.group(part))
    numbers = {p: f"${fmt.group(p)}" for p in "YmdHMSf" if fmt.group(p)}
    if fmt.group("b") is None and fmt.group("B") is None and fmt.group("p") is None:
        # Nothing to translate: one replacement puts the parts in ISO order.
        get = lambda part, missing: numbers.get(part, missing)
        iso = F.regexp_replace(c, fmt.pattern, f"{get('Y', '')}-{get('m', '')}-{get('d', '')} {get('H', '00')}:{get('M', '00')}:{get('S', '00')}.{get('f', '0')}")
    else:
        month = pick("m") if fmt.group("m") else _month_number(pick("b" if fmt.group("b") else "B"))
        hour = pick("H") if fmt.group("H") else F.lit("00")
        if fmt.group("p"):  # 12 AM is 0, 12 PM is 12
            of_twelve = pick("I").try_cast("int") % 12
            hour = F.lpad((of_twelve + F.when(F.lower(pick("p")) == "pm", 12).otherwise(0)).cast("string"), 2, "0")
        rest = [F.concat(F.lit(":"), pick(p)) if fmt.group(p) else F.lit(":00") for p in "MS"]
        fraction = F.concat(F.lit("."), pick("f")) if fmt.group("f") else F.lit("")
        iso = F.concat(pick("Y"), F.lit("-"), month, F.lit("-"), pick("d"), F.lit(" "), hour, *rest, fraction)
    return F.when(c.rlike(fmt.pattern), iso.try_cast("timestamp_ntz"))


def _month_number(name: Column) -> Column:
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m[:3], f"{i:02d}")])
    return F.element_at(numbers, F.lower(F.substring(name, 1, 3)))


def zone_text(fmt: TimeFormat, column: str | Column = "created_at") -> Column:
    """The zone offset of a text (``Z`` as ``+0000``), empty without one: a
    column with several offsets is no one time series."""
    c = F.col(column) if isinstance(column, str) else column
    if fmt.group("z") is None:
        return F.lit("")
    offset = F.regexp_replace(F.upper(F.regexp_extract(c, fmt.pattern, fmt.group("z"))), ":", "")
    return F.when(offset == "Z", "+0000").otherwise(offset)


#: Date modes that read a column by its own format.
BY_FORMAT = ("skip", "inferred")


def format_of(df: DataFrame, mode: str, column: str = "created_at") -> TimeFormat | None:
    """The format a date mode reads the column by; None for ISO text (or if the
    first value has no known form, which then counts as ISO text)."""
    return infer_format(df, column) if mode in BY_FORMAT else None


def ticket_time(mode: str, fmt: TimeFormat | None, column: str = "created_at") -> Column:
    """The time of a ticket in a date mode."""
    if fmt is not None:
        return parsed(fmt, column)
    return text_to_timestamp(column, "strict" if mode == "strict" else "lenient")


def unfit(ts: Column, mode: str, column: str = "created_at") -> Column:
    """A text that is set but was not read."""
    return (is_set(column) if mode in BY_FORMAT else F.col(column).isNotNull()) & ts.isNull()


def one_series(mode: str, fmt: TimeFormat | None, column: str = "created_at") -> Column:
    """Must be the same for all texts of one time series: the form, or with a
    known format (whose texts have one form) the zone offset."""
    what = time_shape(column) if fmt is None else zone_text(fmt, column)
    return F.when(is_set(column), what) if mode in BY_FORMAT else what
