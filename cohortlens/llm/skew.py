"""Joins on keys of which a few may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(big: DataFrame, found: DataFrame, key: str, rows: str) -> DataFrame:
    """Left join of ``big`` with ``found``, which has one row per key.

    ``rows`` is the column of ``found`` that counts the key's rows in ``big``. A key
    is hot if it has more than (total / shuffle partitions) of them, so at most as
    many keys can be hot as there are partitions; only those are broadcast and
    joined where their rows are. Other rows go through a shuffle, in which hot and
    NULL keys are spread, as they match nothing there. ``found`` is read three times
    and should be a written table.
    """
    spark = big.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = found.agg(F.sum(rows)).first()[0] or 0
    limit = max(total // parts, 1)
    fields = [c for c in found.columns if c != key]
    packed = found.select(F.col(key), F.struct(*fields).alias("_found"), F.col(rows).alias("_rows"))
    hot = packed.filter(F.col("_rows") > limit).select(key, F.col("_found").alias("_hot"))
    cold = packed.filter(F.col("_rows") <= limit).select(key, F.col("_found").alias("_cold"), F.lit(0).cast("long").alias("_salt"))
    alone = F.col("_hot").isNotNull() | F.col(key).isNull()
    dealt = big.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.when(alone, F.monotonically_increasing_id() + 1).otherwise(0)
    )
    joined = dealt.join(cold, [key, "_salt"], "left").withColumn("_found", F.coalesce("_hot", "_cold"))
    return joined.select(*big.columns, *[F.col(f"_found.{c}").alias(c) for c in fields])
