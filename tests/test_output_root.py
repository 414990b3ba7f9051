"""Where written tables go: the shared folder itself, the same in every session."""

import pytest

from kickwx.session import output_root


class FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class FakeSpark:
    def __init__(self, master, **values):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = FakeConf({k.replace("_", "."): v for k, v in values.items()})


def test_the_configured_folder_is_used_as_it_is():
    spark = FakeSpark("spark://host:7077", spark_checkpoint_dir="hdfs:///shared/")
    assert output_root(spark) == output_root(spark) == "hdfs:///shared"
    assert output_root(FakeSpark("local[2]", spark_checkpoint_dir="/a", spark_kickwx_root="/b")) == "/b"


def test_a_cluster_without_a_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            output_root(FakeSpark(master))


def test_a_local_master_gets_one_scratch_folder():
    spark = FakeSpark("local[2]")
    assert output_root(spark) == output_root(spark)
