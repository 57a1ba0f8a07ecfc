"""The split join must give the plain join's rows, whatever is hot."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import joins
from cohortlens.operators.joins import grid, hot_keys, split_star_join, star_join


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def split(tables, how, hot_rows):
    named = {f"t{i}": df for i, df in enumerate(tables)}
    return split_star_join(named, "k", how, hot_keys(named, "k", hot_rows))


@pytest.fixture(scope="module")
def frames(spark):
    """Keys hot on the left, on the right, on both, on none, absent, and NULL."""
    left = [("a", i % 3) for i in range(60)] + [("b", 1), ("c", 2), ("c", 2), ("x", 0)] + [(None, 5)] * 20
    left += [("both", i) for i in range(12)]
    right = [("a", 10), ("c", 11), ("y", 12), (None, 13)] + [("b", i % 2) for i in range(70)]
    right += [("both", i) for i in range(15)]
    other = [("a", True), ("b", False), ("z", True)] + [("c", True)] * 40
    return (
        spark.createDataFrame(left, "k string, l int").repartition(5),
        spark.createDataFrame(right, "k string, r int").repartition(3),
        spark.createDataFrame(other, "k string, o boolean").repartition(4),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [0, 1, 4, 10, 1000])
def test_same_rows_as_plain_join(spark, frames, how, hot_rows):
    left, right, other = frames
    plain = star_join(left, [right, other], "k", how)
    salted = split([left, right, other], how, hot_rows)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_tables(spark, seed):
    rng = random.Random(seed)
    keys = [None, *"abcdef"]

    def table(column):
        weights = [rng.random() ** 4 for _ in keys]
        data = [(k, rng.randint(0, 2)) for k in rng.choices(keys, weights, k=rng.randint(1, 40))]
        return spark.createDataFrame(data, f"k string, {column} int").repartition(rng.randint(1, 4))

    tables = [table(c) for c in "xyz"]
    for how in ("inner", "left"):
        plain = star_join(tables[0], tables[1:], "k", how)
        assert rows(split(tables, how, rng.randint(1, 6))) == rows(plain)


def test_swapped_sides(spark, frames):
    left, right, _ = frames
    assert rows(split([right, left], "left", 5)) == rows(right.join(left, "k", "left"))


def test_hot_keys_have_exact_counts(spark, frames):
    left, right, _ = frames
    both = hot_keys({"l": left, "r": right}, "k", 10).drop("_rows").collect()
    assert {tuple(r) for r in both} == {("a", 60, 1), ("b", 1, 70), ("both", 12, 15), (None, 20, 1)}


def test_all_hot_keys_are_found_at_any_number_and_rarity(spark):
    """3,000 keys above the threshold, and one that holds 0.01 % of the rows."""
    many = spark.range(0, 60_000, 1, 8).select((F.col("id") % 3000).alias("k"))
    assert hot_keys({"t": many}, "k", 19).count() == 3000
    rare = spark.range(0, 1_000_000, 1, 8).select(F.when(F.col("id") % 10_000 == 7, -1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r)[:2] for r in hot_keys({"t": rare}, "k", 99).collect()] == [(-1, 100)]


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.fixture
def many_tasks(spark):
    """64 shuffle partitions that stay as they are."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("few", [True, False])
def test_pairs_of_a_key_are_dealt_over_tasks(spark, many_tasks, monkeypatch, few):
    """900 equal rows on either side: 810,000 pairs, 10,000 a part, none of them alone in a task."""
    if not few:
        monkeypatch.setattr(joins, "MOST_BROADCAST", 0)
    left = spark.range(0, 900, 1, 1).select(F.lit("k").alias("k"), F.lit(1).alias("l"))
    right = spark.range(0, 900, 1, 1).select(F.lit("k").alias("k"), F.lit(2).alias("r"))
    tables = {"a": left, "b": right}
    joined = split_star_join(tables, "k", "inner", hot_keys(tables, "k", 10_000))
    sizes = rows_by_task(joined)
    assert sum(sizes) == 810_000 and len(sizes) > 30 and max(sizes) < 810_000 / 8
    plain = rows_by_task(star_join(left, [right], "k", "inner"))
    assert max(plain) == 810_000


def test_three_thousand_hot_keys_are_all_split(spark, many_tasks):
    """Keys of 20 x 20 pairs, 40 a part: each is cut into ten parts or more."""
    left = spark.range(0, 60_000, 1, 4).select((F.col("id") % 3000).alias("k"), F.col("id").alias("l"))
    right = spark.range(0, 60_000, 1, 4).select((F.col("id") % 3000).alias("k"), F.col("id").alias("r"))
    tables = {"a": left, "b": right}
    hot = hot_keys(tables, "k", 40)
    parts = hot.select(*grid(F.col("a").cast("double"), F.col("b").cast("double"), F.col("_rows"))).distinct().collect()
    assert hot.count() == 3000 and all(r[0] * r[1] >= 10 for r in parts)
    joined = split_star_join(tables, "k", "inner", hot)
    assert joined.count() == 3000 * 400
    tasks = joined.groupBy("k", F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert tasks <= 400 / 2


def test_grid_keeps_tasks_within_the_rows_asked_for(spark):
    cases = spark.createDataFrame([(float(a), float(b), 100.0) for a in (0, 1, 7, 900, 10**6) for b in (0, 1, 7, 900, 10**6)], "a double, b double, n double")
    for r in cases.select("*", *[c.alias(x) for c, x in zip(grid(F.col("a"), F.col("b"), F.col("n")), "lr", strict=True)]).collect():
        a, b = max(r.a, 1), max(r.b, 1)
        assert 1 <= r.l <= a and 1 <= r.r <= b
        assert -(-a // r.l) * -(-b // r.r) <= 4 * 100 and a / r.l <= 100 and b / r.r <= 100
        assert a * r.r + b * r.l <= 4 * (a * b * -(-a * b // 100)) ** 0.5 + 2 * (a + b)


def test_many_null_keys_take_no_join(spark, many_tasks):
    left = spark.range(0, 9000, 1, 16).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.lit("x").alias("l"))
    right = spark.range(0, 3000, 1, 4).select(F.col("id").alias("k"), F.lit("y").alias("r"))
    tables = {"a": left, "b": right}
    joined = split_star_join(tables, "k", "left", hot_keys(tables, "k", 1000))
    nulls = rows_by_task(joined.where("k IS NULL"))
    assert sum(nulls) == 3000 and max(nulls) < 400
    assert rows(joined) == rows(left.join(right, "k", "left"))


def test_empty_sides(spark, frames):
    left, right, _ = frames
    none = right.where("r < -1")
    assert rows(split([left, none], "left", 2)) == rows(left.join(none, "k", "left"))
    assert split([none, left], "left", 2).count() == 0


def test_unsupported_type(frames):
    with pytest.raises(ValueError):
        split(frames[:2], "full", 2)


def test_plan_has_no_product_and_no_python(frames):
    left, right, other = frames
    for df in (star_join(left, [right, other], "k"), split([left, right, other], "left", 5)):
        plan = df._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan
