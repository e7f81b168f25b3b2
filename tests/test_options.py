"""Connector settings that cannot run here (S1, S2, S7, K8): no Kafka or S3A
jars exist in this environment, so only the option maps are checked."""

import pytest

from tessera.schemas import DEFAULT_TOPIC
from tessera.sinks import kafka_write_options
from tessera.sources import configured_endpoint, kafka_options, require_endpoint, s3a_settings


def test_kafka_reader_options():
    latest = kafka_options("broker:9092")
    assert latest == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": DEFAULT_TOPIC,
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    replay = kafka_options("broker:9092", "other", "earliest", {"maxOffsetsPerTrigger": "1000"})
    assert replay["startingOffsets"] == "earliest" and replay["subscribe"] == "other"
    assert replay["maxOffsetsPerTrigger"] == "1000"
    with pytest.raises(ValueError):
        kafka_options("")


def test_kafka_writer_options():
    assert kafka_write_options("b:1") == {"kafka.bootstrap.servers": "b:1", "topic": DEFAULT_TOPIC}
    with pytest.raises(ValueError):
        kafka_write_options(None)


def test_s3a_settings_and_endpoint_check(spark):
    s = s3a_settings("http://store:9000", "key", "secret")
    assert s["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert s["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert s["spark.hadoop.fs.s3a.impl"].endswith("S3AFileSystem")
    with pytest.raises(ValueError):
        s3a_settings("", "k", "s")
    if configured_endpoint(spark) is None:
        with pytest.raises(ValueError):
            require_endpoint(spark)


def test_kafka_source_absent_here(spark):
    from tessera.sources import read_topic

    with pytest.raises(Exception):
        read_topic(spark, "localhost:1").writeStream.format("console").start()


def test_scale_settings():
    from tessera.session import scale_settings

    small = scale_settings(10 << 20)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert small["spark.sql.adaptive.enabled"] == "true"
    hundred_tb = scale_settings(100 << 40)
    assert hundred_tb["spark.sql.shuffle.partitions"] == "204800"  # 0.5 GB per task
    one_tb = scale_settings(1 << 40)
    assert one_tb["spark.sql.shuffle.partitions"] == str((1 << 40) // (512 << 20))
