"""Object-store addressing.

Paths stay plain parameters (``s3a://bucket/prefix``); credentials and the
endpoint are session settings supplied by the caller, never written in code.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def s3a_settings(endpoint: str, access_key: str, secret_key: str, path_style: bool = True) -> dict:
    """Session settings for an S3-compatible store; pass them to the builder."""
    if not endpoint:
        raise ValueError("object-store endpoint is required")
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def configured_endpoint(spark: SparkSession) -> str | None:
    """The endpoint the session's Hadoop configuration holds, if any."""
    value = spark.conf.get("spark.hadoop.fs.s3a.endpoint", None)
    if value:
        return value
    try:
        # settings given as fs.s3a.* (without the spark.hadoop. prefix) live
        # only in the Hadoop configuration
        return spark.sparkContext._jsc.hadoopConfiguration().get("fs.s3a.endpoint")
    except Exception:  # no SparkContext in this client (Spark Connect)
        return None


def require_endpoint(spark: SparkSession) -> str:
    """Fail early when the object-store endpoint is not configured."""
    endpoint = configured_endpoint(spark)
    if not endpoint:
        raise ValueError("fs.s3a.endpoint is not configured")
    return endpoint
