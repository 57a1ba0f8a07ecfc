"""Quality checks, model and alerts on small frames, against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import alerts, model, quality, rates


# --- quality ---------------------------------------------------------------------


def test_key_check(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "k string")
    assert tuple(quality.key_check(df, "k").first()) == (6, 2, 1, 3)
    assert tuple(quality.key_check(df.limit(0), "k").first()) == (0, 0, 0, 0)


def test_assert_unique_key(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert quality.assert_unique_key(df, "k", "t") is df
    with pytest.raises(quality.RepeatedKeyError, match="t: 2 values of k"):
        quality.assert_unique_key(df.union(df), "k", "t")


def test_profile(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (3, "a")], "n int, s string")
    want = {("n", 3, 1, 2, "1", "3"), ("s", 3, 0, 2, "a", "b")}
    assert {tuple(r) for r in quality.profile(df, exact_distinct=True).collect()} == want
    assert {tuple(r) for r in quality.profile(df).collect()} == want


def test_injection_is_the_same_on_any_partitioning(spark):
    df = spark.range(20_000).select(F.concat(F.lit("S"), "id").alias("student_id"), F.lit(7).alias("grade"))
    one = quality.inject_errors(df.repartition(1), "grade", 0.02, F.lit(15), "student_id", 1)
    many = quality.inject_errors(df.repartition(13), "grade", 0.02, F.lit(15), "student_id", 1)
    hit = {r[0] for r in one.where("grade = 15").collect()}
    assert hit == {r[0] for r in many.where("grade = 15").collect()}
    assert 300 < len(hit) < 500
    other = quality.inject_errors(df, "grade", 0.02, F.lit(15), "student_id", 2)
    assert {r[0] for r in other.where("grade = 15").collect()} != hit


def test_breakdown_tells_null_from_absent(spark):
    df = spark.createDataFrame([("A", 1), (None, 1), (None, 2)], "d string, g int")
    got = {tuple(r) for r in rates.breakdown(df, ["d", "g"]).collect()}
    assert got == {("d", "A", 1), ("d", None, 2), ("g", "1", 2), ("g", "2", 1)}


# --- model -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    """Features with a noisy label, 2,000 rows, none of them collinear."""
    rng = random.Random(7)
    rows = []
    for i in range(2000):
        pct, perf, risk, grade = rng.uniform(30, 100), rng.uniform(20, 95), rng.uniform(0, 100), rng.randint(6, 12)
        flags = [rng.randint(0, 1) for _ in range(3)]
        z = -0.05 * (pct - 70) - 0.04 * (perf - 60) + 0.02 * risk + 0.5 * flags[0] - 1 + rng.gauss(0, 1)
        rows.append((f"S{i}", pct, perf, risk, grade, *flags, int(z > 0)))
    names = ["student_id", *model.FEATURES, "label"]
    return spark.createDataFrame(rows, names).withColumn("grade_level", F.col("grade_level").cast("int"))


@pytest.fixture(scope="module")
def fitted(labelled):
    return model.fit(model.assemble(labelled))


def test_probabilities_equal_newton_fit(labelled, fitted):
    pdf = model.score(fitted, labelled).toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf[model.FEATURES].to_numpy(float)])
    y, w = pdf["label"].to_numpy(float), np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (y - p))
    assert np.abs(1 / (1 + np.exp(-x @ w)) - pdf["dropout_probability"]).max() < 1e-3


def test_probabilities_equal_the_models_own(labelled, fitted, tmp_path):
    fitted.write().overwrite().save(str(tmp_path / "m"))
    plain = LogisticRegressionModel.load(str(tmp_path / "m"))  # without training summary
    own = plain.transform(model.assemble(labelled)).select(
        "student_id", vector_to_array("dropout_probability")[1].alias("own")
    )
    both = model.score(fitted, labelled).join(own, "student_id")
    assert both.select(F.max(F.abs(F.col("own") - F.col("dropout_probability")))).first()[0] < 1e-12


def test_scoring_stays_out_of_python(labelled, fitted):
    plan = model.score(fitted, labelled)._jdf.queryExecution().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_auc_equals_pair_count(spark):
    rng = random.Random(3)
    rows = [(float(rng.randint(0, 9)), float(rng.randint(0, 1))) for _ in range(300)]
    positive = [s for s, label in rows if label]
    negative = [s for s, label in rows if not label]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    got = model.auc(spark.createDataFrame(rows, "s double, label double"), "s")
    assert math.isclose(got, wins / len(positive) / len(negative), abs_tol=1e-9)


def test_hash_split_ignores_partitioning(labelled):
    sides = []
    for n in (1, 9):
        train, test = model.split(labelled.repartition(n))
        sides.append(({r[0] for r in train.select("student_id").collect()}, {r[0] for r in test.select("student_id").collect()}))
    assert sides[0] == sides[1]
    train, test = sides[0]
    assert not train & test and len(train | test) == 2000 and 1500 < len(train) < 1700


def test_random_split(labelled):
    train, test = model.split(labelled, method="random")
    assert train.count() + test.count() == 2000
    with pytest.raises(ValueError):
        model.split(labelled, method="other")


def test_features_drop_unknown_measures(spark):
    ddl = (
        "student_id string, attendance_pct double, performance_score double, risk_score int, grade_level int, "
        "academic_risk_flag boolean, attendance_risk_flag boolean, socio_economic_risk_flag boolean, retention_risk_flag boolean"
    )
    rows = [
        ("S1", 70.0, 50.0, 40, 7, None, True, False, True),
        ("S2", None, 50.0, 40, 7, None, True, False, True),
        ("S3", 70.0, float("nan"), 40, 7, None, True, False, True),
        ("S4", 70.0, 50.0, 40, 7, None, True, False, None),
    ]
    got = [tuple(r) for r in model.features(spark.createDataFrame(rows, ddl)).orderBy("student_id").collect()]
    assert got == [("S1", 70.0, 50.0, 40.0, 7, 0, 1, 0, 1), ("S4", 70.0, 50.0, 40.0, 7, 0, 1, 0, 0)]


# --- alerts ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    predictions = spark.createDataFrame(
        [("S3", 0.9), ("S1", 0.9), ("S2", 0.7), ("S4", 0.69), ("S5", None), ("S6", 0.95)], "student_id string, dropout_probability double"
    )
    profile = spark.createDataFrame(
        [
            ("S1", "ATTENDANCE", 7, "HIGH", True),
            ("S2", None, 10, "LOW", False),
            ("S3", "ATTENDANCE", 10, "HIGH", True),
            ("S4", "ACADEMIC", 8, "LOW", False),
        ],
        "student_id string, primary_risk_driver string, grade_level int, risk_level string, intervention_required boolean",
    )
    return predictions, profile


def test_threshold_is_inclusive_or_not(scored):
    predictions, _ = scored
    assert {r[0] for r in alerts.high_risk(predictions).collect()} == {"S1", "S2", "S3", "S6"}
    assert {r[0] for r in alerts.high_risk(predictions, inclusive=False).collect()} == {"S1", "S3", "S6"}
    assert "alert_generated_timestamp" in alerts.stamped(predictions).columns


def test_top_k_breaks_ties_by_id(scored):
    predictions, profile = scored
    assert [r[0] for r in alerts.top_k(predictions, 3).collect()] == ["S6", "S1", "S3"]
    joined = alerts.predictions_with_risk(predictions, profile, 2).collect()
    assert [tuple(r) for r in joined] == [("S1", 0.9, "HIGH", True), ("S3", 0.9, "HIGH", True)]
    assert "TakeOrderedAndProject" in alerts.top_k(predictions, 3)._jdf.queryExecution().toString()


def test_counts_are_ordered(scored):
    predictions, profile = scored
    high = alerts.high_risk(predictions)
    assert [tuple(r) for r in alerts.driver_counts(high, profile).collect()] == [("ATTENDANCE", 2), (None, 1)]
    assert [tuple(r) for r in alerts.grade_counts(high, profile).collect()] == [(10, 2), (7, 1)]


def test_repeated_ids_count_like_a_join(scored):
    predictions, profile = scored
    high = alerts.high_risk(predictions.union(predictions))
    doubled = profile.union(profile)
    joined = high.join(doubled, "student_id")
    want = {tuple(r) for r in joined.groupBy("grade_level").count().collect()}
    assert {tuple(r) for r in alerts.grade_counts(high, doubled).collect()} == want
    top = [tuple(r) for r in alerts.predictions_with_risk(high, doubled, 6).collect()]
    assert top == [("S1", 0.9, "HIGH", True)] * 4 + [("S3", 0.9, "HIGH", True)] * 2


def test_digest(scored):
    predictions, profile = scored
    got = [tuple(r) for r in alerts.digest(alerts.high_risk(predictions), profile, 2).collect()]
    assert set(got) == {
        ("total", 1, "high_risk_students", 4.0),
        ("top_students", 1, "S6", 0.95),
        ("top_students", 2, "S1", 0.9),
        ("primary_risk_driver", 1, "ATTENDANCE", 2.0),
        ("primary_risk_driver", 2, None, 1.0),
        ("grade_level", 1, "10", 2.0),
        ("grade_level", 2, "7", 1.0),
        *[("recommended_actions", i, line, None) for i, line in enumerate(alerts.ADVICE, 1)],
    }


def test_rate_trend(spark):
    rows = [("N", 2020, False)] * 4 + [("N", 2021, True)] + [("N", 2021, False)] * 3 + [("N", 2022, None)] * 2
    rows += [("S", 2021, True)] * 2
    df = spark.createDataFrame(rows, "region string, year int, dropped boolean")
    got = [tuple(r) for r in alerts.rate_trend(df, "year", "dropped", ["region"], 0.2).orderBy("region", "year").collect()]
    assert got == [
        ("N", 2020, 4, 0, 0.0, None, False),
        ("N", 2021, 4, 1, 0.25, 0.25, True),
        ("N", 2022, 2, 0, 0.0, -0.25, False),
        ("S", 2021, 2, 2, 1.0, None, False),
    ]
    overall = [tuple(r) for r in alerts.rate_trend(df, "year", "dropped").orderBy("year").collect()]
    assert overall == [(2020, 4, 0, 0.0, None, False), (2021, 6, 3, 0.5, 0.5, True), (2022, 2, 0, 0.0, -0.5, False)]


def test_orphans_by_combination_of_tables(spark):
    make = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string")
    tables = {"a": make(["1", "2", None]), "b": make(["1", " 1", "3 ", "3", None]), "c": make(["1", "4"])}
    got = {tuple(r) for r in quality.orphans(tables, "k").collect()}
    assert got == {("a,b,c", 1, 4, 1, 1), ("a", 1, 1, 0, 0), ("b", 1, 2, 1, 1), ("c", 1, 1, 0, 0), ("no key", 1, 2, 0, 0)}
    plan = quality.orphans(tables, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 1 and "Join" not in plan


@pytest.mark.parametrize("hot_rows", [0, 3, 1000])
def test_one_row_of_each_key_is_kept(spark, hot_rows):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "p"), ("b", 0, "p"), ("c", 5, "q"), (None, 1, "r"), (None, 1, "r")]
    rows += [("h", 9, "same")] * 8
    df = spark.createDataFrame(rows, "k string, v int, w string").repartition(4)
    best = {"v": F.col("v"), "w": F.col("w")}
    got = quality.resolve_repeats(df, "k", best, hot_rows).collect()
    assert sorted(map(str, [tuple(r)[:3] for r in got])) == sorted(map(str, rows))
    of = lambda k: sorted([(r.keep, r.reason, r.v, r.repeats) for r in got if r.k == k], key=str)
    assert of("a") == [(False, "v", 1, 3), (False, "w", 3, 3), (True, "winner", 3, 3)]
    assert of("b") == [(False, "v", None, 2), (True, "winner", 0, 2)]
    assert of("c") == [(True, "only", 5, 1)]
    assert of(None) == [(True, "no key", 1, 1)] * 2
    assert of("h") == [(False, "equal", 9, 8)] * 7 + [(True, "winner", 9, 8)]
    plan = quality.resolve_repeats(df, "k", best, hot_rows)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
