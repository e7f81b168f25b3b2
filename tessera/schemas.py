"""One schema module shared by the stream, the batch readers and the sinks.

A ticket message is a flat JSON object of six text fields. The enriched ticket
adds the routed team. Every field is a nullable string, dates included: the
stream keeps the message text as it arrived and conversion happens downstream.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# These must equal the values the original pipeline uses, or routing, domain
# checks and report labels give different results. Kept together, in the
# original order.
REQUEST_TYPES = ("support", "facturation", "technique", "commercial")
PRIORITIES = ("low", "medium", "high", "urgent")
TEAM_BY_REQUEST_TYPE = (
    ("support", "Equipe Support"),
    ("facturation", "Equipe Facturation"),
    ("technique", "Equipe Technique"),
    ("commercial", "Equipe Commerciale"),
)
DEFAULT_TEAM = "Equipe Générique"
REQUIRED_COLUMNS = (
    "ticket_id",
    "client_id",
    "created_at",
    "request_type",
    "priority",
    "assigned_team",
)
DEFAULT_TOPIC = "client_tickets"
DEFAULT_TABLE = "tickets_analysis"
SUMMARY_SECTIONS = (
    ("priority", "Répartition priorités"),
    ("request_type", "Types de requêtes"),
    ("assigned_team", "Équipes assignées"),
)
# --- end of fixed values ------------------------------------------------------

MESSAGE_FIELDS = ("ticket_id", "client_id", "created_at", "request", "request_type", "priority")
ENRICHED_FIELDS = MESSAGE_FIELDS + ("assigned_team",)
TEAMS = tuple(team for _, team in TEAM_BY_REQUEST_TYPE) + (DEFAULT_TEAM,)

MESSAGE_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in MESSAGE_FIELDS])
ENRICHED_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in ENRICHED_FIELDS])

# Layout of a message log: the part of a Kafka record the pipeline reads.
# File-backed logs in tests and replays use the same columns, so the stream
# code cannot tell them apart.
MESSAGE_LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
    ]
)


def missing_columns(columns, required=REQUIRED_COLUMNS) -> list[str]:
    """Required names absent from ``columns``, in the order of ``required``."""
    present = set(columns)
    return [name for name in required if name not in present]
