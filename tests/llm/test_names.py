"""Columns whose names an operator uses for itself pass through unchanged."""

import pytest

from cohortlens.llm import bpe, ctph, mixing, repeats, rules, shingle_join, toxicity
from cohortlens.llm.common import aside

NAMES = ("_id", "_of", "_kept", "_whole", "_key", "_rate", "_copies", "_copy", "_row", "_text", "_bpe", "_words", "_Hits")
PASSAGE = " ".join(f"word{i}" for i in range(30))


@pytest.fixture
def docs(spark):
    rows = [(1, PASSAGE + " first one"), (2, "second " + PASSAGE), (3, "nothing shared here"), (None, None), (4, "")]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(*r, *(f"{r[0]}{n}" for n in NAMES)) for r in rows], schema)


def given(frame):
    return {tuple(r[n] for n in NAMES) for r in frame.collect()}


def test_aside_gives_names_back(docs):
    renamed, restore = aside(docs, "_ID", "_hits", "other")
    assert not {"_id", "_hits"} & {c.lower() for c in renamed.columns}
    assert restore(renamed).columns == docs.columns
    assert aside(docs, "free")[0] is docs


def test_row_operators_keep_them(docs):
    machine = toxicity.fit_sample(["you vile grobnik", "a calm day", "calm grobnik", "a day"] * 5, [1, 0, 1, 0] * 5)
    ranks = {bytes([b]): b for b in range(256)}
    for out in (
        rules.apply_rules(docs),
        ctph.fingerprints(docs),
        toxicity.score(docs, machine),
        bpe.encode(docs, ranks, r"\S+|\s+"),
    ):
        assert given(out) == given(docs)
        assert out.count() == 5


def test_passages_are_cut_beside_them(docs):
    out = repeats.apply(docs)
    assert out.columns == docs.columns
    assert given(out) == given(docs)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == {1: PASSAGE + " first one", 2: "second", 3: "nothing shared here", None: None, 4: ""}


def test_mix_and_representatives_keep_them(docs):
    named = docs.selectExpr("*", "xxhash64(coalesce(text, '')) AS text_key", "2.0D AS rate")
    drawn = mixing.draw(docs, named.select("doc_id", "text_key", "rate"))
    assert drawn.columns == docs.columns
    assert given(drawn) == given(docs)
    assert drawn.count() == 10
    kept = shingle_join.representatives(docs)
    assert kept.columns == docs.columns
    assert given(kept) <= given(docs)
