"""Message sources: a Kafka topic, or a folder-backed message log.

Both give a (possibly streaming) DataFrame with a binary ``value`` column, so
the export and replay jobs take either. The Kafka connector jar is not part
of this environment; its option maps are unit-tested, and the file-backed
log exercises the same downstream code end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.schemas import DEFAULT_TOPIC, MESSAGE_LOG_SCHEMA


# A backlog is read in several micro-batches of this size instead of one huge
# one (nothing is left out; ``None`` lifts the bound).
MESSAGES_PER_BATCH = 50_000_000
FILES_PER_BATCH = 10_000


def kafka_options(
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    extra=None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict:
    """Reader options for a topic.

    ``latest``: new messages only (the export). ``earliest``: replay the whole
    topic; remembered progress then lives in the query's checkpoint, not in a
    consumer group. ``max_offsets_per_trigger`` bounds a micro-batch (a
    backlog is split into several batches instead of one huge one);
    ``min_partitions`` splits topic partitions into more Spark tasks when the
    topic has fewer partitions than the cluster has cores.
    """
    if not bootstrap_servers:
        raise ValueError("bootstrap_servers is required")
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    options.update(extra or {})
    return options


def read_topic(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    extra=None,
    max_offsets_per_trigger: int | None = MESSAGES_PER_BATCH,
    min_partitions: int | None = None,
) -> DataFrame:
    """A streaming read of a Kafka topic."""
    options = kafka_options(bootstrap_servers, topic, starting_offsets, extra, max_offsets_per_trigger, min_partitions)
    return spark.readStream.format("kafka").options(**options).load()


def read_message_log(spark: SparkSession, path: str, max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """A folder of Parquet files with ``key`` and ``value`` bytes, read as a stream.

    New files are picked up as they appear; progress is remembered by the
    query's checkpoint, so a restart continues after the last file consumed.
    """
    reader = spark.readStream.schema(MESSAGE_LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def read_message_text_log(spark: SparkSession, path: str, max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """A folder of JSON-lines files, one message per line, read as a stream.

    Gives a ``value`` column of text; parsing accepts text as well as bytes.
    An empty line is an empty message (parsed as all-null, as an empty topic
    value is).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_message_log_batch(spark: SparkSession, path: str) -> DataFrame:
    """The same log read once, as a batch table."""
    return spark.read.schema(MESSAGE_LOG_SCHEMA).parquet(path)
