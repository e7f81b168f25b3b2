"""Publishing tickets as messages (K8).

To Kafka through Spark's Kafka writer (each task produces its own rows), or
to a folder-backed message log with the same ``key``/``value`` layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.transform import encode_messages
from tessera.schemas import DEFAULT_TOPIC, MESSAGE_FIELDS


def kafka_write_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC, extra=None) -> dict:
    if not bootstrap_servers:
        raise ValueError("bootstrap_servers is required")
    options = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    options.update(extra or {})
    return options


def publish_to_topic(df: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC, fields=MESSAGE_FIELDS, key: str | None = None, extra=None) -> None:
    """K8: one JSON message per row."""
    encode_messages(df, fields, key).write.format("kafka").options(**kafka_write_options(bootstrap_servers, topic, extra)).save()


def publish_to_log(df: DataFrame, path: str, fields=MESSAGE_FIELDS, key: str | None = None) -> None:
    """K8 on files: append the messages to a message-log folder.

    Each append is one Spark write job: its files become visible to a
    streaming reader only once the job has committed them.
    """
    encode_messages(df, fields, key).write.mode("append").parquet(path)
