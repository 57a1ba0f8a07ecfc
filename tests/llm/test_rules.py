from cohortlens.llm.rules import apply_rules
from cohortlens.llm.common import WORD


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(hit),
        len(words) < 10 or 100 * len(hit) > 20 * len(words),
    )


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one two three four five one two three four five one",
    "a b c d e f a b c d e g a b c d e",
    "x x x x x x x x",
    "line\nline\n \nline \nother|<>#",
    "non breaking is one word too",
    "the of and to in is for that it with " * 2000,
    "the of and to in is for that it with",
    "the of and to in is for that it with",
]


def test_measures_against_brute_force(frame):
    docs = frame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words long")
    got = {r.doc_id: r for r in apply_rules(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text)
        assert r.kept == (not r.failed) and (not r.base_failed or not r.kept)


def test_empty_table(frame):
    assert apply_rules(frame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(frame):
    plan = apply_rules(frame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
