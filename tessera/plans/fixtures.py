"""Ticket tables derived from the driver's ``events`` table.

Rules are deterministic (no randomness), so Spark and the DuckDB oracle build
the same rows. One ticket per event, over the whole table; the work grows
with ``events``. All derivations are projections and unions: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tickets import timestamp_text
from tessera.operators.transform import assign_team, encode_messages
from tessera.schemas import ENRICHED_FIELDS

# Event type -> request type; any other event type is kept as is, so
# ``signup`` reaches the default team.
EVENT_REQUEST_TYPE = (("click", "support"), ("view", "facturation"), ("purchase", "technique"), ("error", "commercial"))
# Upper bounds of ``value`` for each priority; above the last, ``urgent``.
PRIORITY_BOUNDS = ((5, "low"), (20, "medium"), (60, "high"))


def zero_padded(prefix: str, number, width: int) -> F.Column:
    """``prefix`` + the number left-padded with zeros to ``width`` digits;
    longer numbers are kept whole, never cut."""
    digits = F.col(number).cast("string") if isinstance(number, str) else number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


# Schemas of the driver tables read here. Given explicitly, no job reads
# Parquet footers to infer them, and ``ts`` is always a wall-clock
# (``timestamp_ntz``) value, whatever the session's inference settings.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tickets_from_events(events: DataFrame, keep=()) -> DataFrame:
    """Six-field ticket messages, one per event (FIXTURES section 3).

    ``keep`` names event columns carried along unchanged.
    """
    et = F.col("event_type")
    request_type = None
    for kind, rt in EVENT_REQUEST_TYPE:
        request_type = F.when(et == kind, rt) if request_type is None else request_type.when(et == kind, rt)
    request_type = request_type.otherwise(et)
    priority = None
    for bound, label in PRIORITY_BOUNDS:
        cond = F.col("value") < bound
        priority = F.when(cond, label) if priority is None else priority.when(cond, label)
    priority = priority.otherwise("urgent")
    return events.select(
        *keep,
        zero_padded("T", "event_id", 10).alias("ticket_id"),
        zero_padded("C", "user_id", 5).alias("client_id"),
        timestamp_text("ts", "T").alias("created_at"),
        F.col("props").alias("request"),
        request_type.alias("request_type"),
        priority.alias("priority"),
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets_from_events(read_table(spark, sf_dir, "events"))


def routed_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets with their team: the table the stream export writes."""
    return assign_team(tickets(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets as a message log (key = ticket id, value = JSON bytes)."""
    return encode_messages(tickets(spark, sf_dir), key="ticket_id")


def dirty_tickets_from_events(events: DataFrame) -> DataFrame:
    """Enriched tickets with planted defects (FIXTURES section 4).

    Null rules first, then the copies, so copies carry the same defects. The
    defect rules pick rows by ``event_id``; every row of ``events`` is kept.
    """
    base = tickets_from_events(events, keep=[F.col("event_id").alias("_eid")])
    broken = F.col("_eid") % 101 == 0  # all six fields null, as a malformed message gives
    null_priority = F.col("_eid") % 17 == 0
    null_request = F.col("_eid") % 23 == 0
    empty_request = F.col("_eid") % 29 == 0
    unknown_priority = F.col("_eid") % 31 == 0

    def nulled(name: str, extra=None) -> F.Column:
        cond = broken if extra is None else (broken | extra)
        return F.when(cond, F.lit(None).cast("string")).otherwise(F.col(name))

    request = nulled("request", null_request)
    request = F.when(request.isNotNull() & empty_request, F.lit("")).otherwise(request)
    priority = nulled("priority", null_priority)
    priority = F.when(priority.isNotNull() & unknown_priority, F.lit("critical")).otherwise(priority)
    defective = base.select(
        "_eid",
        nulled("ticket_id").alias("ticket_id"),
        nulled("client_id").alias("client_id"),
        nulled("created_at").alias("created_at"),
        request.alias("request"),
        nulled("request_type").alias("request_type"),
        priority.alias("priority"),
    )
    # Exact copies of every tenth row, made in the same scan (a generator,
    # not a second read of ``events``).
    copies = F.sequence(F.lit(1), F.when(F.col("_eid") % 10 == 0, 2).otherwise(1))
    routed = assign_team(defective).withColumn("_copy", F.explode(copies))
    return routed.select(*ENRICHED_FIELDS)


def tickets_with_bad_dates_from_events(events: DataFrame) -> DataFrame:
    """Routed tickets whose creation text is ``bad-date`` on every 37th event
    (a planted defect for the date modes); every event is kept."""
    base = tickets_from_events(events, keep=[F.col("event_id").alias("_eid")])
    created = F.when(F.col("_eid") % 37 == 0, F.lit("bad-date")).otherwise(F.col("created_at"))
    return assign_team(base.withColumn("created_at", created)).select(*ENRICHED_FIELDS)


def subsecond_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed tickets whose creation text keeps the event time's fraction."""
    events = read_table(spark, sf_dir, "events")
    base = tickets_from_events(events.withColumn("_ts", F.col("ts")), keep=["_ts"])
    text = F.translate(F.col("_ts").cast("string"), " ", "T")
    return assign_team(base.withColumn("created_at", text)).select(*ENRICHED_FIELDS)


# Other written forms of the creation time, by name: what each is built from
# (slices of the ISO text, the month's name, the hour of twelve).
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
TIME_FORMS = ("slashes", "compact", "month name", "day and month name", "twelve hours", "year first", "zone")


def time_in_form(iso: F.Column, form: str) -> F.Column:
    """An ISO time text (``yyyy-MM-ddTHH:mm:ss``) written in another form."""
    y, m, d, h, mi, sec = (F.substring(iso, at, n) for at, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2)))
    name = F.element_at(F.array(*[F.lit(x) for x in MONTH_NAMES]), m.cast("int"))
    of_twelve = F.lpad(F.when(h.cast("int") % 12 == 0, 12).otherwise(h.cast("int") % 12).cast("string"), 2, "0")
    pieces = {
        "slashes": [m, "/", d, "/", y, " ", h, ":", mi],
        "compact": [y, m, d, " ", h, ":", mi, ":", sec],
        "month name": [name, " ", d, " ", y, " ", h, ":", mi, ":", sec],
        "day and month name": [d, "-", name, "-", y],
        "twelve hours": [m, "/", d, "/", y, " ", of_twelve, ":", mi, " ", F.when(h.cast("int") < 12, "AM").otherwise("PM")],
        "year first": [y, "/", m, "/", d, " ", h, ":", mi, ":", sec, ".5"],
        "zone": [iso, "+02:00"],
    }[form]
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in pieces])


def tickets_in_form(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    """Routed tickets whose creation text has another written form throughout."""
    return routed_tickets(spark, sf_dir).withColumn("created_at", time_in_form(F.col("created_at"), form))


def tickets_with_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets_with_bad_dates_from_events(read_table(spark, sf_dir, "events"))


def dirty_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_tickets_from_events(read_table(spark, sf_dir, "events"))


__all__ = [
    "dirty_tickets",
    "dirty_tickets_from_events",
    "messages",
    "read_table",
    "routed_tickets",
    "tickets_in_form",
    "time_in_form",
    "subsecond_tickets",
    "tickets",
    "tickets_from_events",
    "tickets_with_bad_dates",
    "tickets_with_bad_dates_from_events",
]
