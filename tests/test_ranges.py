"""Running totals and neighbours across ranges, against plain Python; the AUC and the trend built on them."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cohortlens.operators import alerts, model, ranges
from cohortlens.operators.ranges import previous, running_totals


@pytest.fixture(params=[0, 1, 2, 5, 400])
def values(request):
    rng = random.Random(request.param)
    return [(i * 3, rng.choice([None, 0, 1, 7, 10**17])) for i in range(request.param)]


@pytest.mark.parametrize("inline", [True, False])
def test_running_totals(spark, values, inline, monkeypatch):
    monkeypatch.setattr(ranges, "MOST_INLINE", 200 if inline else -1)
    df = spark.createDataFrame(random.Random(1).sample(values, len(values)), "k long, v long")
    want, total = [], 0
    for k, v in values:
        want.append((k, v, total))
        total += v or 0
    got = running_totals(df, ["k"], ["v"])
    assert sorted((r.k, r.v, int(r.v_before)) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan or "SinglePartition" not in plan


@pytest.mark.parametrize("inline", [True, False])
def test_previous(spark, values, inline, monkeypatch):
    monkeypatch.setattr(ranges, "MOST_INLINE", 200 if inline else -1)
    df = spark.createDataFrame(random.Random(2).sample(values, len(values)), "k long, v long")
    want = [(k, v, None if i == 0 else values[i - 1][1]) for i, (k, v) in enumerate(values)]
    assert sorted(map(tuple, previous(df, ["k"], {"before": "v"}).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_by_rank(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([0.0, -0.0, 1.5, rng.random()]), float(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame([*rows, (None, 1.0), (0.5, None)], "raw_prediction double, label double")
    positives, negatives = ([s for s, y in rows if y == label] for label in (1.0, 0.0))
    want = sum((p > n) + (p == n) / 2 for p in positives for n in negatives) / len(positives) / len(negatives)
    assert model.auc_by_rank(df).first()["auc"] == pytest.approx(want, abs=1e-12)
    known = df.na.drop().withColumn("raw_prediction", F.col("raw_prediction") + 0.0)  # it tells -0.0 from 0.0
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw_prediction", numBins=0)
    assert evaluator.evaluate(known) == pytest.approx(want, abs=1e-12)
    assert model.auc_by_rank(df.where("label = 1")).first()["auc"] is None
    assert model.auc_by_rank(df.limit(0)).first()["auc"] is None


def test_trend_over_many_periods_is_no_single_task(spark):
    rng = random.Random(4)
    rows = [(f"p{i:05d}", rng.random() < 0.4) for i in range(500) for _ in range(rng.randint(1, 3))]
    trend = alerts.rate_trend(spark.createDataFrame(rows, "period string, event boolean"), "period", "event")
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(1" not in plan
    rates, before = {}, None
    for r in trend.orderBy("period").collect():
        own = [e for p, e in rows if p == r.period]
        assert r.total == len(own) and r.rate == round(sum(own) / len(own), 4)
        assert r.rate_change == (None if before is None else round(r.rate - before, 4))
        assert r.alert == (before is not None and r.rate_change >= 0.02)
        before = rates[r.period] = r.rate


def test_wrong_weights_break_the_score_equations(spark):
    rng = random.Random(5)
    rows = [(f"S{i}", *[rng.random() * 100 for _ in range(3)], rng.randint(6, 12), *[rng.randint(0, 1) for _ in range(3)]) for i in range(400)]
    rows = [(*r, int(r[1] + r[4] + rng.random() * 80 > 90)) for r in rows]
    schema = "student_id string, " + ", ".join(f"{c} double" for c in model.FEATURES[:3]) + ", grade_level int, "
    df = spark.createDataFrame(rows, schema + ", ".join(f"{c} int" for c in model.FLAGS) + ", label int")
    fitted = model.fit(model.assemble(df))
    good = model.score_equations(model.score(fitted, df)).collect()
    assert len(good) == 8 and all(abs(r.expected / r.observed - 1) < 1e-3 for r in good)

    class Zeroed:
        intercept, coefficients = fitted.intercept, type("W", (), {"toArray": staticmethod(lambda: [0.0] * 7)})

    bad = model.score_equations(model.score(Zeroed, df)).collect()
    assert any(abs(r.expected / r.observed - 1) > 0.05 for r in bad)
    gram = {(r.row_feature, r.column_feature): r["product"] for r in model.gram(model.assemble(df)).collect()}
    assert len(gram) == 28
    assert gram["risk_score", "grade_level"] == pytest.approx(sum(r[3] * r[4] for r in rows))
    assert df.select(F.sum("label")).first()[0] == round(good[0].observed)


@pytest.mark.parametrize("inline", [True, False])
def test_alert_ranks(spark, inline, monkeypatch):
    monkeypatch.setattr(ranges, "MOST_INLINE", 200 if inline else -1)
    rng = random.Random(3)
    rows = [(f"s{i:04}", rng.choice([0.7, 0.9, 1.0, rng.random()])) for i in range(500)]
    rows += [(None, 0.9), ("a", None), (None, None)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "student_id string, dropout_probability double")
    key = lambda r: (r[1] is None, -(r[1] or 0), r[0] is None, r[0] or "")
    want = [(*r, place) for place, r in enumerate(sorted(rows, key=key), 1)]
    ranked = alerts.ranked(df)
    assert sorted(map(tuple, ranked.collect()), key=lambda r: r[2]) == want
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert alerts.ranked(df.filter("false")).count() == 0
