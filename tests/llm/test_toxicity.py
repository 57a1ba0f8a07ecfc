import zlib

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import toxicity
from cohortlens.llm.queries import op4_string_kernel

SF = "/root/testdata/sf0.01"


def brute_features(word):
    """Weights of all triples of a word, by plain loops over its codes."""
    codes = [30, *[toxicity._code(ord(c)) for c in word]]
    out = {}
    for i in range(len(codes)):
        for j in range(i + 1, min(i + 4, len(codes))):
            for k in range(j + 1, min(j + 4, len(codes))):
                key = codes[i] << 10 | codes[j] << 5 | codes[k]
                out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
    return out


def test_kernel_against_brute_force():
    words = ["idiot", "idiiot", "ün-lucky", "a", "ab", "x1y"]
    features = toxicity._Words(words)
    everything = np.arange(len(words))
    kernel = features.kernel(everything, features.dense(everything))
    for i, one in enumerate(words):
        for j, other in enumerate(words):
            x, y = brute_features(one), brute_features(other)
            assert abs(kernel[i, j] - sum(v * y.get(k, 0) for k, v in x.items())) < 1e-3


def test_decision_is_that_of_the_highest_word():
    weights = np.random.default_rng(1).normal(size=toxicity.TRIPLES).astype(np.float32)
    index = np.arange(toxicity.TRIPLES)
    weights[(index >> 10 == 0) | (index >> 5 & 31 == 0) | (index & 31 == 0)] = 0
    texts = ["one two  three", "", "\n é ", "single"]
    want = []
    for text in texts:
        sums = [sum(weights[k] * v for k, v in brute_features(w).items()) for w in text.split()]
        want.append(max(sums, default=0) + 0.5)
    assert np.allclose(toxicity.decisions(texts, weights, 0.5), want, atol=1e-3)


def test_held_out_accuracy_and_disguises(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    english = docs.filter("lang = 'en'").select("doc_id")  # the other labels of this table are noise
    rows = op4_string_kernel(spark, sf).join(labels, "doc_id").join(english, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    toxic = [r.predicted for r in held if r.toxic]
    clean = [r.predicted for r in held if not r.toxic]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    plain, spelled, doubled, clean = model.scores(["so idiot here", "so i d i o t here", "so idiiot here", "so and here"])
    assert min(plain, spelled, doubled) > clean + 0.2


def test_defined_results(frame):
    docs = [(1, None), (2, ""), (3, "scum " * 30_000), (3, "scum " * 30_000), (None, "nice words here")]
    schema = "doc_id long, text string"
    labels = [(i, 1, f"scum {i}") for i in range(20)] + [(100 + i, 0, f"nice words here {i}") for i in range(20)]
    labelled = frame([(i, t, 1) for i, _, t in labels], "doc_id long, text string, score int")
    given = frame([(i, y) for i, y, _ in labels], "doc_id long, toxic int")
    model = toxicity.fit(labelled, given)
    got = sorted((r.doc_id or 0, r.predicted) for r in toxicity.score(frame(docs, schema), model).collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 1), (3, 1)]
    assert toxicity.score(frame([], schema), model).count() == 0
    for one_class in (given.filter("toxic = 0"), given.filter("toxic > 1")):
        none = toxicity.fit(labelled, one_class)
        assert {r.score for r in toxicity.score(frame(docs, schema), none).collect()} == {0.0}


def test_held_out_accuracy_over_all_languages(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op4_string_kernel(spark, sf).filter("held_out").join(labels, "doc_id").join(docs, "doc_id").collect()
    share = lambda toxic, english: np.mean([r.predicted for r in rows if r.toxic == toxic and (r.lang == "en") == english])
    print({(t, e): share(t, e) for t in (0, 1) for e in (False, True)})
    assert share(1, True) > 0.85 and share(0, True) < 0.02
    assert share(1, False) > 0.4 and share(0, False) < 0.06


def test_a_common_marker_weighs_more_than_a_piece_seen_once():
    assert toxicity._evidence(50, 120, 352, 2500) > 2 * toxicity._evidence(1, 0, 352, 2500) > 0
    assert toxicity._evidence(1, 120, 352, 2500) < 0
