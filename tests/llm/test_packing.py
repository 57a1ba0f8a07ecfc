import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cohortlens.llm import packing
from cohortlens.llm.common import table
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH, PATTERN = public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN


def reference():
    model = Tokenizer.from_file(PATH)
    model.encode_special_tokens = True
    return lambda text: model.encode(text or "", add_special_tokens=False).ids + [2]


def best_fit_decreasing(lengths, top):
    """Each piece on its own: the open bin with the least room that holds it. Returns the bins' contents."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if sum(b) + n <= top]
        if fits:
            max(fits, key=sum).append(n)
        else:
            bins.append([n])
    return sorted(map(tuple, bins))


def contents(counts, top):
    runs, bins = packing.place(counts, top)
    out = [[] for _ in range(bins)]
    for run in runs:
        number = min([r.rank for r in runs if r.length == run.length and r.rank > run.rank], default=dict(counts)[run.length])
        for j in range(number - run.rank):
            own = out[run.first + j // run.each]
            assert sum(own) == run.offset + (j % run.each) * run.length
            own.append(run.length)
    return sorted(map(tuple, out))


def test_runs_are_best_fit_decreasing():
    draw = random.Random(12)
    for top in (1, 7, 10, 64):
        for _ in range(60):
            lengths = [draw.randint(1, top) for _ in range(draw.randint(0, 60))]
            counts = [(n, lengths.count(n)) for n in set(lengths)]
            made, want = contents(counts, top), best_fit_decreasing(lengths, top)
            assert sorted(map(sum, made)) == sorted(map(sum, want))  # bins of equal room may hold other lengths
            assert sorted(n for b in made for n in b) == sorted(lengths)


def test_tightest_capacity():
    draw, tree, held = random.Random(1), packing.Capacities(37), []
    for _ in range(2000):
        if held and draw.random() < 0.5:
            held.remove(c := draw.choice(held))
            tree.change(c, -1)
        else:
            held.append(draw.randint(0, 37))
            tree.change(held[-1], 1)
        need = draw.randint(0, 37)
        assert tree.tightest(need) == min((c for c in held if c >= need), default=None)


def check(rows, packed, top=1024):
    """Every token of every document once, in pieces as agreed, sequences without gaps."""
    encode = reference()
    want = []
    for doc_id, text in rows:
        ids = encode(text)
        first = (len(ids) - 1) % top + 1 if len(ids) > top else len(ids)
        starts = [0, *range(first, len(ids), top)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = packed.collect()
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r))
    assert order([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]) == order(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= top
    return [tuple(sorted((n for _, n in b), reverse=True)) for b in bins.values()], [w[3] for w in want]


def test_all_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    bins, lengths = check(rows, QUERIES["op12_best_fit"](spark, SF))
    assert len(bins) == len(best_fit_decreasing(lengths, 1024))
    assert len(bins) <= 1.01 * -(-sum(lengths) // 1024) + 1


def test_odd_rows(spark, frame):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (1, None), (None, ""), (None, "x <|endoftext|> y"), (2, long), (2, long), (3, "é \U0001f600 \t\n")]
    docs = frame(rows, "doc_id long, text string").withColumn("piece", packing.F.lit(7)).withColumn("ids", packing.F.lit("i"))
    packed = packing.pack(docs.repartition(3), PATH, PATTERN, top=64, with_ids=True)
    check(rows, packed, top=64)
    made = packing.sequences(packed)
    assert sorted(i for r in made.collect() for i in r.ids) == sorted(i for _, t in rows for i in reference()(t))
    assert all(len(r.ids) <= 64 and r.starts[0] == 0 for r in made.collect())
    assert packing.pack(docs.limit(0), PATH, PATTERN).collect() == []
