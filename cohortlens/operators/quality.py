"""Profiling, key checks, orphans, repeats, rejected rows and controlled error injection."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.joins import split_star_join
from cohortlens.sources.tables import written


class RepeatedKeyError(ValueError):
    """A table that must hold one row per key holds several."""


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``(table_name, record_count)``."""
    counts = [
        df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def _distinct_values(df: DataFrame) -> DataFrame:
    """``(column_name, distinct_count)``: each column's values are counted map-side
    first, so a frequent value crosses the shuffle once per task."""

    def comparable(c: str) -> Column:
        is_float = df.schema[c].dataType.typeName() in ("float", "double")
        return (F.col(c) + F.lit(0.0) if is_float else F.col(c)).cast("string")  # -0.0 equals 0.0

    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), comparable(c).alias("value")) for c in df.columns])
    return (
        df.select(F.inline(pairs))
        .groupBy("column_name", "value")
        .agg(F.lit(1))
        .groupBy("column_name")
        .agg(F.count("value").alias("distinct_count"))
    )


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """Per column: rows, NULLs, distinct values, minimum and maximum (as text).

    Everything is measured in one aggregation, distinct values as a HyperLogLog
    estimate. Exact distinct counts take a second pass whose shuffle carries
    every distinct value of every column once.
    """
    measures = [F.count("*").alias("rows")]
    for c in df.columns:
        measures += [
            (F.count("*") - F.count(c)).alias(f"{c}_nulls"),
            F.min(c).cast("string").alias(f"{c}_min"),
            F.max(c).cast("string").alias(f"{c}_max"),
        ]
        if not exact_distinct:
            measures.append(F.approx_count_distinct(c).alias(f"{c}_distinct"))

    def described(c: str) -> Column:
        distinct = [] if exact_distinct else [F.col(f"{c}_distinct").alias("distinct_count")]
        return F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows"),
            F.col(f"{c}_nulls").alias("null_count"),
            *distinct,
            F.col(f"{c}_min").alias("min_value"),
            F.col(f"{c}_max").alias("max_value"),
        )

    per_column = df.agg(*measures).select(F.inline(F.array(*[described(c) for c in df.columns])))
    if exact_distinct:
        per_column = per_column.join(_distinct_values(df), "column_name", "left").na.fill(0, ["distinct_count"])
    return per_column.select("column_name", "rows", "null_count", "distinct_count", "min_value", "max_value")


def key_check(df: DataFrame, key: str) -> DataFrame:
    """One row: total rows, distinct keys, keys that repeat and rows of the hottest key.

    Counting per key first keeps a hot key's rows out of the shuffle.
    """
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
            F.count(key).alias("unique_keys"),
            F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
            F.coalesce(F.max("n"), F.lit(0)).alias("max_rows_per_key"),
        )
    )


def assert_unique_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` itself if no key repeats, else ``RepeatedKeyError``."""
    repeated = key_check(df, key).first()["repeated_keys"]
    if repeated:
        raise RepeatedKeyError(f"{name}: {repeated} values of {key} occur more than once")
    return df


def key_presence(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Per key, blanks around it stripped: in which tables it is, its rows, and how many of them are padded.

    Padded keys join with nothing where only one side is stripped. One aggregation over
    the key columns of all tables: no table is joined or exchanged by itself.
    """
    own = F.col(key)
    keys = [
        df.select(F.trim(own).alias(key), (own != F.trim(own)).alias("padded"), F.lit(name).alias("found"))
        for name, df in tables.items()
    ]
    order = F.array(*[F.lit(name) for name in tables])
    return (
        reduce(DataFrame.unionAll, keys)
        .groupBy(key)
        .agg(
            F.collect_set("found").alias("found"),  # at most one entry per table
            F.count("*").alias("rows"),
            F.count_if("padded").alias("padded_rows"),
        )
        .withColumn("found", F.array_join(F.array_intersect(order, F.col("found")), ","))
    )


def orphans(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """How many keys are in which tables: ``(found_in, keys, rows, padded_keys, padded_rows)``.

    A row for all tables and one for each combination that lacks some. NULL keys, which join
    with nothing, are under ``no key``.
    """
    found = F.when(F.col(key).isNull(), "no key").otherwise(F.col("found")).alias("found_in")
    return key_presence(tables, key).groupBy(found).agg(
        F.count("*").alias("keys"),
        F.sum("rows").alias("rows"),
        F.count_if(F.col("padded_rows") > 0).alias("padded_keys"),
        F.sum("padded_rows").alias("padded_rows"),
    )


def resolve_repeats(df: DataFrame, key: str, best: Mapping[str, Column], hot_rows: int = 1_000_000) -> DataFrame:
    """All rows with ``repeats`` (rows of the key), ``keep`` and ``reason``: one row of each key is kept.

    ``best`` names the criteria in order; the row with the larger value wins, NULL loses.
    Rows equal in all of them are told apart by their place. The reason is ``only``,
    ``winner``, ``no key`` (kept) or, of a loser, the first criterion it lost by,
    ``equal`` if none.

    The winner of a key is one aggregate, combined in the map tasks: a hot key's rows do
    not meet in one task. Losers see their winner through a join that splits hot keys.
    """
    names = [f"_by_{name}" for name in best]
    rows = written(
        df.withColumns(dict(zip(names, best.values(), strict=True))).withColumn("_place", F.monotonically_increasing_id())
    )
    order = F.struct(*names, -F.col("_place"))
    won = rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("repeats"), F.max_by(F.struct("_place", *names), order).alias("_won")
    )
    won = written(won)
    hot = written(
        won.where(F.col("repeats") > hot_rows).select(
            key, F.col("repeats").alias("rows"), F.lit(1).alias("winner"), F.lit(float(max(hot_rows, 1))).alias("_rows")
        )
    )
    joined = split_star_join({"rows": rows, "winner": won}, key, "left", hot)
    is_first = F.col("_place") == F.col("_won._place")
    lost = [F.when(~F.col(c).eqNullSafe(F.col(f"_won.{c}")), F.lit(name)) for name, c in zip(best, names, strict=True)]
    reason = (
        F.when(F.col(key).isNull(), "no key")
        .when(F.col("repeats") == 1, "only")
        .when(is_first, "winner")
        .otherwise(F.coalesce(*lost, F.lit("equal")))
    )
    keep = F.coalesce(is_first, F.lit(True)).alias("keep")
    return joined.select(*df.columns, F.coalesce("repeats", F.lit(1)).alias("repeats"), keep, reason.alias("reason"))


def rejects(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Rows a filter would drop, with the first rule each one breaks.

    A rule is the condition a good row meets; a NULL condition is a broken rule,
    just as ``where`` drops it.
    """
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in reasons.items()]
    return df.withColumn("reject_reason", F.coalesce(*broken)).where(F.col("reject_reason").isNotNull())


def stable_bucket(key: Column, salt: str | int, buckets: int = 10_000) -> Column:
    """Bucket 0..buckets-1 of a key: the same on any partitioning, run or engine.

    The first 32 bits of an MD5 over ``key:salt``; any SQL engine can repeat it.
    """
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(salt))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets))


def inject_errors(df: DataFrame, column: str, fraction: float, value: Column, key: str, seed: str | int) -> DataFrame:
    """Overwrite about ``fraction`` of a column, picking rows by a hash of their key."""
    hit = stable_bucket(F.col(key), f"{column}:{seed}") < round(fraction * 10_000)
    return df.withColumn(column, F.when(hit, value.cast(df.schema[column].dataType)).otherwise(F.col(column)))
