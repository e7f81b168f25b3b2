"""The shared folder and the settings for large inputs."""

import pytest

from tessera import session


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Session:
    """A stand-in session: only its settings count."""

    def __init__(self, **conf):
        self.conf = _Conf({k.replace("_", "."): v for k, v in conf.items()})

    @property
    def sparkContext(self):
        raise RuntimeError("no context in this client")


def test_shared_folder_is_required_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(ValueError):
            session.ensure_shared_dir(_Session(spark_master=master))
        assert session.ensure_shared_dir(_Session(spark_master=master, spark_checkpoint_dir="hdfs://x/shared")) == "hdfs://x/shared"
    assert session.ensure_shared_dir(_Session(spark_master="local[4]"))


def test_partitions_grow_with_the_input():
    tasks = lambda n: int(session.scale_settings(n)["spark.sql.shuffle.partitions"])
    assert tasks(1) == 200 and tasks(100 << 40) == 100 * 2048 and tasks(1000 << 40) == 10 * tasks(100 << 40)
