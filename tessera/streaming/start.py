"""Where an export begins.

A Kafka source knows "latest" itself. A folder-backed log does not: its stream
reads what is already there. ``start_at_now`` gives it that start position. At
the first start it runs the same query once over the backlog with a condition
on the files' metadata that none meets: Spark decides it while it lists, so no
old file is opened, but the source's offsets in the checkpoint move past the
files that are there. The position is thus kept with the checkpoint and as exact as any
later offset: a message published a moment later is new, whatever the clocks
say, and a restart continues after the last message exported.

``start_position`` under the checkpoint says how far this went. ``taking`` is
written before and ``taken`` after, so a start that fails in between takes the
position again instead of exporting half of the backlog.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EARLIEST, LATEST = "earliest", "latest"


def _lines(spark: SparkSession, path: str) -> list[str] | None:
    try:
        return [r[0] for r in spark.read.text(path).limit(10).collect()]
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def start_position(spark: SparkSession, checkpoint: str) -> str | None:
    """``taking``, ``taken``, or None where no start position was asked for."""
    found = _lines(spark, f"{checkpoint.rstrip('/')}/start_position")
    return found[0] if found else None


def has_progress(spark: SparkSession, checkpoint: str) -> bool:
    """The checkpoint holds a committed micro-batch."""
    return bool(_lines(spark, f"{checkpoint.rstrip('/')}/commits"))


def _note(spark: SparkSession, checkpoint: str, state: str) -> None:
    spark.range(1, numPartitions=1).select(F.lit(state).alias("value")).write.mode("overwrite").text(f"{checkpoint.rstrip('/')}/start_position")


def without_messages(source: DataFrame) -> DataFrame:
    """The stream of a folder's files without any of them: a condition on what
    the listing knows of a file, so that none is opened."""
    return source.where(F.col("_metadata.file_size") < 0)


def start_at_now(rows: DataFrame, checkpoint: str, begin: Callable[[DataFrame], None]) -> bool:
    """Move a fresh checkpoint past all messages present; True if it did.

    ``begin`` runs the query over ``rows``, the export's stream
    ``without_messages``, to the end of what is there. An older checkpoint with progress keeps it: the start position counts at the
    first start only.
    """
    spark = rows.sparkSession
    state = start_position(spark, checkpoint)
    if state == "taken" or (state is None and has_progress(spark, checkpoint)):
        return False
    _note(spark, checkpoint, "taking")
    begin(rows)
    _note(spark, checkpoint, "taken")
    return True
