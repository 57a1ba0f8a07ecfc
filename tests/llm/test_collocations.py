import re
from collections import Counter, defaultdict

import pytest

from cohortlens.llm import collocations
from cohortlens.llm.common import table
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, least=100, longest=5, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", lower):
            words = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in f.items() if a >= least and 3 <= len(p)}
    inside = defaultdict(int)
    for (lang, *words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = (lang, *words[i : i + size])
                inside[part] = max(inside[part], a)
    out = defaultdict(list)
    for p, a in candidates.items():
        if inside[p] >= a:
            continue
        lang, *words = p
        cuts = [(f[(lang, *words[:k])], f[(lang, *words[k:])]) for k in range(1, len(words))]
        scored = [(1000 * a * n[lang] // (left * right), k, left, right) for k, (left, right) in enumerate(cuts, 1)]
        score, _, left, right = min(scored)
        phrase = " ".join(words)
        out[lang].append((-score, -a, phrase.encode(), (phrase, a, left, right, n[lang], score)))
    return [(lang, i, *row[3]) for lang, rows in out.items() for i, row in enumerate(sorted(rows)[:top], 1)]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least", [100, 8])
def test_all_documents(spark, least):
    docs = table(spark, SF, "documents")
    want = sorted(brute([(r.lang, r.text) for r in docs.collect()], least))
    df = QUERIES["op13_setm"](spark, SF) if least == 100 else collocations.collocations(docs, least)
    assert got(df) == want
    assert want or least == 100


def test_lists_beyond_the_broadcast_bound(spark, monkeypatch):
    docs = table(spark, SF, "documents").select("text", "lang")
    monkeypatch.setattr(collocations, "BROADCAST_ROWS", 0)
    assert got(collocations.collocations(docs, 8, top=50)) == sorted(brute([(r.lang, r.text) for r in docs.collect()], 8, top=50))


def test_odd_rows(spark, frame):
    rows = [
        (1, "A b\tc. A b c!\vA b c\x0bA b c", "en"),
        (1, "A b\tc. A b c!\vA b c\x0bA b c", "en"),
        (None, None, None),
        (2, "", "en"),
        (3, "x x x x x x, É é É é", None),
        (4, "\u00a0\u2028 \x0c \x0b \x85 a", "en"),
        (5, "z " * 30_000, "de"),
    ]
    docs = frame(rows, "doc_id long, text string, lang string").withColumn("phrase", collocations.F.lit("p"))
    want = sorted(brute([(lang, t) for _, t, lang in rows], 2))
    assert got(collocations.collocations(docs, 2)) == want
    assert got(collocations.collocations(docs.limit(0), 2)) == []


def test_products_past_64_bits(spark):
    """The score of counts whose products pass 64 bits is exact."""
    big = 4_000_000_000
    level = lambda rows: spark.createDataFrame(rows, "lang string, words array<string>, f long")
    sizes = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    levels = [level([("en", ["a"], big + 1), ("en", ["b"], big + 7)]), level([("en", ["a", "b"], big - 3)])]
    (row,) = collocations._scored(sizes, levels).collect()
    assert row.score == 1000 * (big - 3) * 9 * big // ((big + 1) * (big + 7))
