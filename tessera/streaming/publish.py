"""Publishing tickets (J6, the data half of the ticket producer).

The random generator and its pacing loop are not rebuilt: tickets come from
a table (here, derived from ``events``) and are published in one distributed
write, to Kafka or to a message-log folder the stream jobs read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.schemas import DEFAULT_TOPIC
from tessera.sinks.topic import publish_to_log, publish_to_topic


def publish_tickets(tickets: DataFrame, *, log_path: str | None = None, bootstrap_servers: str | None = None, topic: str = DEFAULT_TOPIC, key: str | None = "ticket_id") -> None:
    if bootstrap_servers:
        publish_to_topic(tickets, bootstrap_servers, topic, key=key)
    elif log_path:
        publish_to_log(tickets, log_path, key=key)
    else:
        raise ValueError("give a message-log folder or Kafka servers")
