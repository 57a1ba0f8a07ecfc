import numpy as np
import pytest

from cohortlens.llm import mixing
from cohortlens.llm.queries import op3_soft_mixing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rated(spark):
    return op3_soft_mixing(spark, SF).toPandas()


def test_expected_tokens_meet_the_targets(rated):
    for d in ("de", "en", "es", "fr"):
        got = (rated["rate"] * rated["n_tokens"] * rated["n_rows"] * rated[f"p_{d}"]).sum() / rated["n_tokens"].sum()
        assert abs(got - 0.25) < 1e-3
    assert (rated["rate"] >= 0).all() and len(rated) == 1000


def test_classifier_is_right_outside_its_sample(spark, rated):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    other = rated[~rated["doc_id"].isin(labels["doc_id"])].merge(docs, on="doc_id")
    best = other[["p_de", "p_en", "p_es", "p_fr"]].to_numpy().argmax(1)
    right = np.array(["de", "en", "es", "fr"])[best] == other["lang"]
    assert right[other["n_tokens"] >= 20].mean() > 0.97


def test_same_rates_as_a_dense_projected_gradient(rated):
    p = rated[["p_de", "p_en", "p_es", "p_fr"]].to_numpy()
    n = rated["n_tokens"].to_numpy() / rated["n_tokens"].sum()
    q, r = p.T @ n, np.ones(len(n))
    for _ in range(40):
        s = p.T @ (n * r)
        if np.abs(s - 0.25).max() <= 1e-4:
            break
        r = np.maximum(0, r - p @ ((s - 0.25) / q))
    assert np.allclose(r, rated["rate"], atol=1e-6)


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = mixing.draw(docs, mixing.rates(docs, docs, spark.read.parquet(f"{SF}/labels.parquet")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


SCHEMA = "doc_id long, text string, lang string, p int"


def test_defined_results(frame):
    rows = [(i, "der die das" if i % 2 else "the and of", "de" if i % 2 else "en", 1) for i in range(20)]
    rows += [(50, None, "en", 1), (51, "", None, 1), (52, "unknown", "xx", 1), (3, "der die das", "de", 1)]
    rows += [(None, "the and of", "en", 1), (60, "the and of " * 30_000, "en", 1)]
    docs = frame(rows, SCHEMA)
    labels = frame([(i, 1) for i in range(20)], "doc_id long, quality int")
    settings = mixing.Mixing(targets={"de": 2, "en": 2})
    got = {r.doc_id: r for r in mixing.rates(docs, docs, labels, settings).collect()}
    assert len(got) == len(rows) - 1 and got[3].n_rows == 2
    assert abs(sum(r.rate * r.n_rows * r.n_tokens * r.p[0] for r in got.values()) / sum(r.rate * r.n_rows * r.n_tokens for r in got.values()) - 0.5) < 1e-3
    assert got[50].n_tokens == 0 and abs(sum(got[50].p) - 1) < 1e-9
    grown = mixing.rates(docs, docs, labels, mixing.Mixing(targets={"de": 0.3, "en": 0.7}, budget=None))
    drawn = mixing.draw(docs, grown)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} >= {r.doc_id for r in grown.collect() if r.rate >= 1}
    assert mixing.rates(docs.limit(0), docs, labels, settings).count() == 0
    assert mixing.rates(docs, docs, labels.limit(0), settings).count() == len(rows) - 1
