import math
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from cohortlens.llm import mixing, repeats, toxicity
from cohortlens.llm.common import WORD, table
from cohortlens.sources.tables import written
from test_bpe import reference
from test_repeats import brute as brute_repeats
from test_shingle_join import brute as brute_join

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), {"": table(spark, SF, "documents")}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = written(stage(spark, docs, SF))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert steps[name].dtypes == steps[""].dtypes


def test_toxicity_keeps_what_the_model_calls_clean(spark, steps):
    labels = table(spark, SF, "labels").filter(~toxicity.held_out(toxicity.F.col("doc_id")))
    model = toxicity.fit(steps[""].select("doc_id", "text"), labels)
    want = [(i, t) for i, t in texts(steps[""]) if model.scores([t])[0] < 0.5]
    assert sorted(texts(steps["toxicity"])) == sorted(want)
    assert 0 < len(want) < 1000


def test_one_document_of_each_group_stays(steps):
    before = texts(steps["toxicity"])
    keep = {i for i, _, c in brute_join(before) if i == c}
    assert sorted(texts(steps["near_duplicates"])) == sorted((i, t) for i, t in before if i in keep)


def test_repeated_passages_go(steps):
    before = texts(steps["near_duplicates"])
    want = {i: (n, gone) for i, n, gone, _ in brute_repeats(before)}
    after = dict(texts(steps["repeated_passages"]))
    assert after.keys() == want.keys() and any(gone for _, gone in want.values())
    for i, text in before:
        n, gone = want[i]
        assert len(WORD.findall(after[i])) == n - gone
        assert gone or after[i] == text


def test_mix_meets_the_targets_and_loses_no_document(steps):
    tokens, copies = Counter(), Counter()
    for r in steps["mixing"].collect():
        tokens[r.lang] += len(WORD.findall(r.text or ""))
        copies[r.doc_id] += 1
    total = sum(tokens.values())
    for lang, share in corpus_pipeline.TARGETS.items():
        assert abs(tokens[lang] / total - share) < 0.02
    given = {r.doc_id for r in steps["repeated_passages"].select("doc_id").collect()}
    assert copies.keys() == given and max(copies.values()) <= 4


def test_tokens_are_those_of_the_library(steps):
    ref = reference()
    given = defaultdict(list)
    for i, t in texts(steps["mixing"]):
        given[i].append(t)
    for r in steps["tokens"].collect():
        assert r.ids == ref.encode_ordinary(given[r.doc_id][0]) and r.n_tokens == len(r.ids) and r.round_trip


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"
    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, "the of and to"), (3, "the of and to"), (4, long), (5, long + " end"), (None, "x"), (None, None)]
    odd = spark.createDataFrame([(i, t, None, None, None, 0.5, "k") for i, t in rows], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, SF))
            assert docs.columns == odd.columns
        docs.count()
        corpus_pipeline.encode(spark, docs, SF).count()


def test_run_is_the_chain_of_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.collect()) == sorted(
        (r.doc_id, tuple(r.ids)) for r in steps["tokens"].collect()
    )


def test_rates_of_the_mix_are_positive(spark, steps):
    settings = mixing.Mixing(targets=corpus_pipeline.TARGETS, budget=None)
    rated = mixing.rates(steps["repeated_passages"], steps[""], table(spark, SF, "labels"), settings)
    assert all(r.rate >= 1 and math.isfinite(r.rate) for r in rated.collect())
    assert repeats.WINDOW == 13
