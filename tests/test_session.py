"""Sizing rules and the shared folder."""

import pytest

from cohortlens.session import shared_folder, sized_for

MB = 1 << 20


def sizes(input_bytes, cores):
    settings = sized_for(input_bytes, cores)
    return int(settings["spark.sql.files.maxPartitionBytes"]), int(settings["spark.sql.shuffle.partitions"])


def test_sizes():
    assert sizes(1 << 30, 8) == (128 * MB, 8)
    assert sizes(1 << 40, 64) == (128 * MB, 2048)
    assert sizes(100 << 40, 8000) == (1024 * MB, 204_800)
    assert sizes(0, 4) == (128 * MB, 4)


def test_shared_folder_is_below_the_named_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base + "/") and shared_folder(spark) != shared_folder(spark)


class FakeCluster:
    """A session on a cluster that names no folder."""

    class conf:
        get = staticmethod(lambda name, default: default)

    class sparkContext:
        master = "yarn"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeCluster)
