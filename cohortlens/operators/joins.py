"""Key joins, plain and split for hot keys.

``star_join`` is the plain chain of equi-joins on one key: every input is
exchanged at most once, the chain reuses the partitioning, and AQE turns small
sides into broadcasts and splits skewed left sides.

``split_star_join`` gives the same rows when a key has more rows, or makes more
pairs, than one task should hold. Its rows are dealt over a grid of tasks; rows of
other keys take the plain join, and NULL keys, which match nothing, take none.
``hot_keys`` finds the keys from exact counts in all tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.tables import written

# Up to this many hot keys (a key and a few counts each, some 100 MB in all) are broadcast.
# More are looked up by a shuffle, each in this many copies, so that a hot key's rows
# meet it in as many tasks.
MOST_BROADCAST = 1_000_000
LOOKUP_COPIES = 64


def star_join(spine: DataFrame, satellites: Iterable[DataFrame], key: str, how: str = "left") -> DataFrame:
    joined = spine
    for satellite in satellites:
        joined = joined.join(satellite, key, how)
    return joined


def key_counts(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows (key, a count per table): exact, from one aggregation over the key columns of all tables.

    Tasks count their own keys first, so a hot key crosses the shuffle once per task.
    """
    keys = [df.select(F.col(key), F.lit(name).alias("_table")) for name, df in tables.items()]
    counts = [F.count_if(F.col("_table") == name).alias(name) for name in tables]
    return reduce(DataFrame.unionAll, keys).groupBy(key).agg(*counts)


def pairs_of(tables: Iterable[str]) -> Column:
    """How many rows a key can make in a join of the tables, or hold in one of them."""
    return reduce(mul, [F.greatest(F.col(t), F.lit(1)).cast("double") for t in tables])


def hot_keys(tables: Mapping[str, DataFrame], key: str, hot_rows: int = 1_000_000) -> DataFrame:
    """Keys with more than ``hot_rows`` rows in a table or pairs in the join of all: (key, a count per table).

    Every key with more is found; there are at most (rows of the join) / ``hot_rows`` of them.
    The list is written once, since all branches of a join must see one and the same.
    """
    hot = key_counts(tables, key).where(pairs_of(tables) > hot_rows)
    return written(hot.withColumn("_rows", F.lit(float(max(hot_rows, 1)))))


def _with_hot(df: DataFrame, hot: DataFrame, key: str, join: str, few: bool) -> DataFrame:
    """``df`` joined with the list of hot keys, whose rows stay where they are or are dealt over copies."""
    if few:
        return df.join(F.broadcast(hot), key, join)
    at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(LOOKUP_COPIES))
    copies = hot.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(LOOKUP_COPIES - 1).cast("long"))))
    return df.withColumn("_copy", at).join(copies, [key, "_copy"], join).drop("_copy")


def split_star_join(tables: Mapping[str, DataFrame], key: str, how: str, hot: DataFrame) -> DataFrame:
    """``star_join`` of the first table with the others, hot keys split on either side.

    ``hot`` comes from ``hot_keys`` and has a count column for (at least) these
    tables. It must be a stored list: rows would be lost or doubled if two branches
    saw two lists.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    known = [df.where(F.col(key).isNotNull()) for df in tables.values()]
    listed = hot.where(F.col(key).isNotNull())
    few = (number := listed.count()) <= MOST_BROADCAST
    if number:
        cold = [_with_hot(df, listed.select(key), key, "left_anti", few) for df in known]
    else:
        cold = known
    joined = star_join(cold[0], cold[1:], key, how)
    if number:
        counts = listed.select(key, "_rows", *[F.col(t).cast("double").alias(f"_n_{t}") for t in tables])
        joined = joined.unionByName(_dealt_star_join(dict(zip(tables, known, strict=True)), key, how, counts, few))
    if how == "left":
        spine = next(iter(tables.values()))
        empty = [F.lit(None).cast(joined.schema[c].dataType).alias(c) for c in joined.columns if c not in spine.columns]
        joined = joined.unionByName(spine.where(F.col(key).isNull()).select("*", *empty))
    return joined


def grid(left: Column, right: Column, rows: Column) -> tuple[Column, Column]:
    """Into how many parts to split each side of a key, given the rows of both and the most a task should hold.

    The product of parts brings the pairs of a task down to ``rows``, each side its own
    rows too; of all such grids about the one that copies fewest rows.
    """
    left, right = (F.greatest(side, F.lit(1.0)) for side in (left, right))
    tasks = F.greatest(F.ceil(left * right / rows), F.lit(1)).cast("double")
    balanced = F.ceil(F.sqrt(tasks * left / right)).cast("double")
    of_left = F.least(F.greatest(balanced, F.ceil(left / rows).cast("double")), left)
    needed = F.greatest(F.ceil(tasks / of_left), F.ceil(right / rows)).cast("double")
    return of_left.cast("long"), F.least(needed, right).cast("long")


def _dealt_star_join(tables: Mapping[str, DataFrame], key: str, how: str, counts: DataFrame, few: bool) -> DataFrame:
    """The join's rows for hot keys.

    In each join the left rows of a key are dealt over parts ``_l`` and copied to parts
    ``_r``, the right rows the other way round, so each matching pair meets exactly once.

    The part of a row follows from a number that is stored with it: equal rows have
    different numbers, and a re-run task reads the same ones.
    """

    def tagged(df: DataFrame) -> DataFrame:
        numbered = df.withColumn("_at", F.xxhash64(F.monotonically_increasing_id()))
        return written(_with_hot(numbered, counts, key, "inner", few))

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    (first, spine), *satellites = tables.items()
    joined, left_n = tagged(spine), F.col(f"_n_{first}")
    own = [f"_n_{t}" for t in tables] + ["_rows"]
    for name, satellite in satellites:
        right_n = F.col(f"_n_{name}")
        left_parts, right_parts = grid(left_n, right_n, F.col("_rows"))
        dealt_left = joined.withColumn("_l", F.pmod("_at", left_parts)).withColumn("_r", every(right_parts))
        dealt_right = (
            tagged(satellite)
            .withColumn("_r", F.pmod("_at", right_parts))
            .withColumn("_l", every(left_parts))
            .withColumnRenamed("_at", "_hit")
            .drop(*own)
        )
        joined = dealt_left.join(dealt_right, [key, "_l", "_r"], how)
        if how == "left":
            # A key split on the right has a partner somewhere, so a copy that
            # met none in its own part is no unmatched row.
            joined = joined.where(F.col("_hit").isNotNull() | (right_parts == 1))
        joined = joined.withColumn("_at", F.xxhash64("_at", "_hit")).drop("_l", "_r", "_hit")
        left_n = left_n * F.greatest(right_n, F.lit(1.0))
    return joined.drop("_at", *own)
