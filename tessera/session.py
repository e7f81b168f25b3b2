"""Session helpers: a local session for tests and benches, and the shared
folder every job writes its intermediate tables to.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``
(a distributed file system every executor can reach). Only when that setting
is absent, as in tests on one machine, do we create a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench: local mode, UI off, adaptive execution on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(spark)
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def is_local(master: str) -> bool:
    """One machine and one process: ``local``, ``local[N]``, ``local[*]``."""
    return master == "local" or master.startswith("local[")


def ensure_shared_dir(spark: SparkSession) -> str:
    """Return the shared folder; create a local one only when none is set.

    The local fallback is for single-machine runs (tests, the bench). On a
    cluster ``spark.checkpoint.dir`` names a distributed folder and is used
    as it is; without it there is no folder that all executors share, which
    is an error.
    """
    existing = _checkpoint_dir(spark)
    if existing:
        return existing
    master = spark.conf.get("spark.master", "")
    if not is_local(master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master!r} is not local)")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(local)
    except Exception:  # no SparkContext in this client (Spark Connect)
        return local
    return _checkpoint_dir(spark) or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one job run."""
    root = ensure_shared_dir(spark).rstrip("/")
    return f"{root}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def run_concurrently(spark: SparkSession, actions: dict) -> None:
    """Run independent Spark actions from separate threads so their jobs are
    scheduled side by side instead of one after the other (small jobs, such
    as report tables or the two formats of one micro-batch, would otherwise
    leave most of the cluster idle). The first failure is raised once all
    have finished."""
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(actions)))) as pool:
        # inherit the caller's job group, description and pool in each thread
        inherit = inheritable_thread_target(spark)
        futures = [pool.submit(inherit(action)) for action in actions.values()]
    for future in futures:
        future.result()


def scale_settings(input_bytes: int, target_partition_bytes: int = 512 << 20, min_partitions: int = 200) -> dict:
    """Runtime SQL settings sized for ``input_bytes`` of exported tickets.

    The de-duplication shuffle moves about the input's size, so the shuffle
    starts with enough partitions for ``target_partition_bytes`` each (a
    reduce task's hash map then fits in executor memory); adaptive execution
    merges the small ones at run time. 100 TB gives about 190,000 tasks; more
    input gives more tasks, not larger ones. Input splits stay at the default 128 MB. All keys can be
    set on a running session.
    """
    partitions = max(min_partitions, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
    }


def apply_settings(spark: SparkSession, settings: dict) -> None:
    for key, value in settings.items():
        spark.conf.set(key, value)
