from __future__ import annotations

import os

import pytest

from brindle.sources.scratch import scratch_folder


class Session:
    """A session's settings alone."""

    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_unset_in_local_mode():
    spark = Session(spark_master="local[8]")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != two and os.path.dirname(one) == os.path.dirname(two) and os.path.isdir(os.path.dirname(one).removeprefix("file://"))


def test_unset_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_folder(Session(spark_master=master), "x")


def test_a_session_without_the_setting_can_write(spark, monkeypatch):
    unset = Session(spark_master="local[*]")
    path = scratch_folder(unset, "rows")
    spark.range(5).write.parquet(path)
    assert spark.read.parquet(path).count() == 5


def test_local_paths_on_a_cluster_are_told_once(caplog):
    spark = Session(spark_master="yarn")
    spark.conf["spark.checkpoint.dir"] = "file:///mnt/shared/"
    assert scratch_folder(spark, "x").startswith("file:///mnt/shared/x-")
    scratch_folder(spark, "x")
    assert len([r for r in caplog.records if "mounted" in r.message]) == 1
    spark.conf["spark.checkpoint.dir"] = "hdfs://name/shared"
    assert scratch_folder(spark, "x").startswith("hdfs://name/shared/x-")
    assert len(caplog.records) == 1
