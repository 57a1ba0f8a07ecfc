import hashlib

from cohortlens.llm import repeats
from cohortlens.llm.common import WORD

SCHEMA = "doc_id long, text string, window int"


def brute(rows):
    first = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - 12):
            key = tuple(words[i : i + 13])
            first[key] = min(first.get(key, repeats.NO_ID), repeats.NO_ID if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        own, gone = repeats.NO_ID if doc_id is None else doc_id, set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < own:
                gone |= set(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def results(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in repeats.remove(df).collect()), key=str)


def test_all_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert results(docs) == brute([tuple(r) for r in docs.collect()])


def test_cases_against_brute_force(frame):
    run = [f"w{i}" for i in range(200)]
    text = lambda *parts: " ".join(w for p in parts for w in p)
    rows = [
        (5, text(run[:40])),
        (3, text(["a"], run[10:30], ["b"], run[:13])),
        (9, text(["x"] * 5, run[5:45], ["y"])),
        (10, text(run[20:32])),
        (11, text(run[30:43])),
        (12, text(run[50:70], ["gap"], run[50:70])),
        (13, text(run[50:70])),
        (14, text(run[50:70])),
        (14, text(run[50:70])),
        (15, "A " * 300),
        (16, "A " * 5_000),
        (17, None),
        (18, ""),
        (19, " \n\t "),
        (None, text(run[50:70])),
        (20, text(run[100:160], ["no break"], run[100:160])),
        (21, "q\x0b" + "\f".join(run[90:130])),
        (22, "\x1c".join(run[90:130])),
        (23, text(run[100:160], ["no break"], run[100:120]) + " tail"),
    ]
    assert results(frame([(*r, 1) for r in rows], SCHEMA)) == brute(rows)
    assert results(frame([], SCHEMA)) == []


def test_one_id_with_two_texts_is_one_source(frame):
    run = " ".join(f"w{i}" for i in range(20))
    rows = [(1, run), (1, run + " more"), (2, run + " other")]
    assert results(frame([(*r, 1) for r in rows], SCHEMA)) == brute(rows)


def thue_morse(size, letters):
    """The Thue-Morse word: under weights that are powers of one odd number it and its complement agree."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(size))


def test_words_that_powers_cannot_tell_apart(frame):
    hashes = repeats.Hashes()
    for size in (512, 1024, 2048, 4096):
        one, other = thue_morse(size, "ab"), thue_morse(size, "ba")
        found = hashes(f"{one} {other} {one}".encode())
        assert found[0] != found[1] and found[0] == found[2]
        tail = " ".join(f"w{i}" for i in range(20))
        rows = [(1, f"{one} {tail}"), (2, f"{other} {tail}"), (3, f"{other} {tail}")]
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in repeats.remove(frame(rows, "doc_id long, text string")).collect())
        assert got == brute(rows)
