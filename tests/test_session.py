"""Shared folders and shipping."""

import os
import time

import pytest

from hopscan import session


def test_a_run_leaves_nothing(spark):
    with session.run_folder(spark) as path:
        table = session.checkpointed(spark.range(5))
        assert table.count() == 5
        assert path in table.inputFiles()[0]
    assert not os.path.exists(path.removeprefix("file:"))
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_the_folder_must_be_named():
    class Unset:
        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Unset)


def test_shuffles_of_stored_tables_are_removed(spark):
    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").count("shuffle_")

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(key)
    with session.shuffles_removed(spark):
        kept = session.checkpointed(spark.range(1000).repartition(3, "id"), "zstd")
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before and kept.count() == 1000 and spark.conf.get(key) == setting
