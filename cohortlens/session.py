"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

MB = 1 << 20


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Scan and shuffle sizes for a run over ``input_bytes``.

    Scan splits grow from 128 MB to 1 GB so that a very large input keeps to about
    100,000 scan tasks. Shuffle partitions hold 512 MB of input each at any size, at
    least one per core; AQE merges partitions that turn out small.
    """
    split = min(max(input_bytes // 100_000, 128 * MB), 1024 * MB)
    partitions = max(-(-input_bytes // (512 * MB)), cores)
    return {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.shuffle.partitions": str(partitions)}


def builder(app_name: str = "cohortlens", **settings: str) -> SparkSession.Builder:
    """Builder with the adaptive settings the joins rely on, plus the given ones.

    ``forceOptimizeSkewedJoin`` lets AQE split a hot partition in the middle of
    the star join's chain too, where that costs one more exchange.
    """
    adaptive = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    return SparkSession.builder.appName(app_name).config(map={**adaptive, **settings})


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="cohortlens-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one named in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary
    folder. On a cluster a machine-local folder would be lost with its machine,
    so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base()
    return os.path.join(base, f"cohortlens-{uuid.uuid4().hex}")
