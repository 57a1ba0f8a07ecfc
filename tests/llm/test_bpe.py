import base64
import hashlib

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from cohortlens.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "\n\n  \t x", "Don't stop 12345!!", "Éçà ß ñandú 漢字 🙂\u0000▁", "a" * 5000, "  two   blanks  "]


def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_tiktoken_on_all_documents(spark):
    ranks, ref = bpe.read_ranks(PATH), reference()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in bpe.encode(docs, ranks, public_tokenizers.PATTERN).collect():
        assert r.ids == ref.encode_ordinary(r.text)


def test_cases_and_round_trip(frame):
    ranks, ref = bpe.read_ranks(PATH), reference()
    docs = frame([(i, t, 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    rows = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.ids == ref.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    trip = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).collect()
    for r in trip:
        ids = ref.encode_ordinary(TEXTS[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
    assert bpe.encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_vocabularies_with_gaps_are_refused():
    with pytest.raises(ValueError):
        bpe.model_bytes({bytes([b]): b + 1 for b in range(256)})
    with pytest.raises(ValueError):
        bpe.model_bytes({b"a": 0})
