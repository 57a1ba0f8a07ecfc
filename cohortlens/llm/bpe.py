"""Byte-level BPE through a sentencepiece model written from the vocabulary.

``model_bytes`` serialises the model: piece i is token i with its bytes mapped to
printable characters, scored by its negative rank, with an identity normaliser.
Sentencepiece then merges the best-scored (lowest-ranked) pair first, leftmost on
ties, as byte-level BPE does. ``encode`` splits a text into pre-tokens and encodes
each on its own; a pre-token that is a token itself is that token. ``decode`` maps
ids back to bytes. Distinct short pre-tokens are encoded once per task, in a
memory of bounded size.

Defined results: a NULL text counts as empty; an empty text has no ids; rows are
independent (repeated rows give equal results, an empty table gives none); other
columns pass through, clashing ones are replaced.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator, Mapping
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import arrow_slices, aside, slices, text_or_empty

# Field numbers and wire types of the public sentencepiece schema.
NORMAL, UNKNOWN, BPE = 1, 2, 2
MEMORY = 200_000
SHORT = 32


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: Mapping[bytes, int]) -> bytes:
    """The serialised model; ranks must run from 0 without gaps and include all 256 bytes."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks have gaps or repeats")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a single byte has no rank")
    mapped = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _block(1, _block(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece("".join(mapped[b] for b in t), -float(i), NORMAL) for i, t in enumerate(tokens)]
    pieces.append(piece("<unk>", 0.0, UNKNOWN))
    trainer = _number(3, BPE) + _number(4, len(pieces)) + _number(40, len(tokens))
    # Identity: no rules, no blank in front, blanks neither merged nor escaped.
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


class Codec:
    """Encodes and decodes single texts."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        mapped = byte_characters()
        back = {ord(c): b for b, c in enumerate(mapped)}
        size = self._model.get_piece_size() - 1
        self._bytes = [bytes(back[ord(c)] for c in self._model.id_to_piece(i)) for i in range(size)]
        self._whole = {token: (i,) for i, token in enumerate(self._bytes)}
        self._latin = {b: c for b, c in enumerate(mapped)}
        self._split = regex.compile(pattern).findall
        self._known: dict[str, tuple[int, ...]] = {}

    def _encode_new(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        ids = self._whole.get(raw)
        if ids is None:
            ids = tuple(self._model.encode(raw.decode("latin-1").translate(self._latin), out_type=int))
        if len(piece) <= SHORT:
            if len(self._known) >= MEMORY:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        known, new = self._known.get, self._encode_new
        return list(chain.from_iterable(known(p) or new(p) for p in self._split(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))


def _mapped(docs: DataFrame, extra: str, ranks: Mapping[bytes, int], pattern: str, text: str, row, keep=True) -> DataFrame:
    """``docs`` plus columns that ``row(codec, text)`` gives as a tuple."""
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(ranks))
    added = T._parse_datatype_string(extra)
    docs, restore = aside(docs.drop(*[f.name for f in added]), *{"_bpe"} - {text})
    docs = docs.withColumn("_bpe", text_or_empty(text))
    if not keep:
        docs = docs.drop(text)
    schema = T.StructType([f for f in docs.schema if f.name != "_bpe"] + list(added))
    names = [f.name for f in added]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(model.value, pattern)
        for frame in slices(frames, "_bpe"):
            made = [row(codec, t) for t in frame["_bpe"]]
            out = frame.drop(columns="_bpe")
            for name, values in zip(names, zip(*made, strict=True), strict=True):
                out[name] = pd.Series(values, index=out.index, dtype=object)
            yield out

    return restore(docs.mapInPandas(run, schema))


def encode(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array of int), the tokens of the whole text, and their number ``n_tokens``."""

    def row(codec: Codec, t: str):
        ids = codec.encode(t)
        return ids, len(ids)

    return _mapped(docs, "ids array<int>, n_tokens long", ranks, pattern, text, row)


def decode(encoded: DataFrame, ranks: Mapping[bytes, int], ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary), the bytes of the ids; NULL ids count as none."""
    tokens = encoded.sparkSession.sparkContext.broadcast(sorted(ranks, key=ranks.__getitem__))
    schema = T.StructType([f for f in encoded.schema if f.name != "decoded"] + [T.StructField("decoded", T.BinaryType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = tokens.value
        for frame in frames:
            made = [b"" if x is None else b"".join(map(table.__getitem__, x)) for x in frame[ids]]
            yield frame.assign(decoded=pd.Series(made, index=frame.index, dtype=object))

    return encoded.drop("decoded").mapInPandas(run, schema)


def round_trip(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Adds the number and digest of the ids and the digest of the bytes they decode to.

    Encodes and decodes in one pass, so that neither ids nor texts leave the task; the text column is dropped.
    """
    import hashlib

    def row(codec: Codec, t: str):
        ids = codec.encode(t)
        joined = ",".join(map(str, ids)).encode()
        return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

    return _mapped(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string", ranks, pattern, text, row, keep=False)


def encode_checked(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``ids`` (array of int), ``n_tokens`` and ``round_trip``: whether
    the ids decode to the text's bytes.

    One pass in one worker: ids are held as packed 32-bit integers, a slice of texts at a time,
    and the decoded bytes are compared where they are made.
    """
    added = T._parse_datatype_string("ids array<int>, n_tokens long, round_trip boolean")
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(ranks))
    kept = docs.drop(text, *[f.name for f in added])
    schema = T.StructType([*kept.schema, *added])
    names = kept.columns
    given = docs.select(*[F.col(c) for c in names], text_or_empty(text).alias("_bpe_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model.value, pattern)
        for whole in batches:
            for batch in arrow_slices(whole, "_bpe_text"):
                made, same = [np.zeros(0, np.int32)], []
                for value in batch.column("_bpe_text"):
                    ids = codec.encode(value.as_py())
                    same.append(codec.decode(ids) == value.as_buffer().to_pybytes())
                    made.append(np.array(ids, np.int32))
                sizes = np.array([len(ids) for ids in made], np.int32)
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(np.concatenate(made)))
                columns = [batch.column(c) for c in names]
                columns += [ids, pa.array(sizes[1:].astype(np.int64)), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids", "n_tokens", "round_trip"])

    return given.mapInArrow(run, schema)
