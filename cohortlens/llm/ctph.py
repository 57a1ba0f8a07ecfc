"""Context-triggered piecewise hashing of texts.

A rolling hash over the last 7 bytes ends a chunk wherever it hits a residue of
the block size; each chunk adds one of 64 characters to the signature. A
fingerprint ``b:s:t`` holds the block size and the signatures for b and 2b, and b
grows with the text so that s has at most 64 characters and, where the text allows
it, 32. Two fingerprints are compared by edit distance at a block size they share.

Defined results: a NULL text counts as empty, the empty text's fingerprint is
``3::``; equal texts have equal fingerprints and likeness 1; texts whose block
sizes differ by more than a factor of two have likeness 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import aside, slices, text_or_empty
from cohortlens.sources.tables import written

WINDOW, SMALLEST, LONGEST = 7, 3, 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BASE = 0x01000193


def _rolling(data: bytes) -> np.ndarray:
    """A mixed hash of the last 7 bytes at each position."""
    bytes_ = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)
    hashed = bytes_.copy()
    weight = 1
    for back in range(1, min(WINDOW, len(bytes_))):
        weight = weight * _BASE & 0xFFFFFFFF
        hashed[back:] += bytes_[:-back] * np.uint32(weight)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x85EBCA6B)
    hashed ^= hashed >> np.uint32(13)
    return hashed


def _signature(hashed: np.ndarray, block: int) -> str:
    ends = np.flatnonzero(hashed % np.uint32(block) == block - 1)
    starts = np.concatenate(([0], ends + 1))
    starts = starts[starts < len(hashed)]
    if len(starts) > LONGEST:  # the rest is one chunk
        starts = starts[:LONGEST]
    sums = np.add.reduceat(hashed, starts, dtype=np.uint32)
    sums *= np.uint32(0xC2B2AE35)
    return ALPHABET[sums >> np.uint32(26)].tobytes().decode()


def fingerprint(text: str) -> str:
    data = text.encode()
    block = SMALLEST
    if not data:
        return f"{block}::"
    while block * LONGEST < len(data):
        block *= 2
    hashed = _rolling(data)
    first = _signature(hashed, block)
    while block > SMALLEST and len(first) < LONGEST // 2:
        block //= 2
        first = _signature(hashed, block)
    return f"{block}:{first}:{_signature(hashed, 2 * block)}"


def likeness(one: Column, other: Column) -> Column:
    """1 less the edit distance over the longer signature, the best of the shared block sizes."""
    (b1, s1, t1), (b2, s2, t2) = ([F.split(x, ":")[i] for i in range(3)] for x in (one, other))
    size1, size2 = b1.cast("long"), b2.cast("long")

    def alike(x: Column, y: Column) -> Column:
        longer = F.greatest(F.length(x), F.length(y))
        return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(x, y) / longer)

    return (
        F.when(one == other, 1.0)
        .when(size1 == size2, F.greatest(alike(s1, s2), F.when(F.length(t1) > 0, alike(t1, t2)).otherwise(0.0)))
        .when(size1 == 2 * size2, alike(s1, t2))
        .when(2 * size1 == size2, alike(t1, s2))
        .otherwise(0.0)
    )


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``fingerprint``, which replaces a column of this name; all others stay."""
    from pyspark.sql import types as T

    docs, restore = aside(docs.drop("fingerprint"), *{"_text"} - {text})
    docs = docs.withColumn("_text", text_or_empty(text))
    schema = T.StructType([f for f in docs.schema if f.name != "_text"] + [T.StructField("fingerprint", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "_text"):
            yield frame.drop(columns="_text").assign(fingerprint=[fingerprint(t) for t in frame["_text"]])

    return restore(docs.mapInPandas(run, schema))


EDITED = (
    "doc_id long, _key long, _order long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, next_fingerprint string, _text string, _first boolean, _last boolean"
)


def _edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint and that of an edited text.

    The edit replaces the last half (rounded down) by as much of the next document,
    in descending order of doc_id; the last document's next is the first. Documents
    with one doc_id are ordered by a hash of their text, a NULL doc_id is the least.

    One range exchange puts neighbours together; each task walks its rows once and
    leaves only the seams between tasks, two rows each, for a join on their order.
    """
    raw = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("_text"))
    keyed = raw.withColumns({"_key": F.xxhash64("_text"), "_order": F.monotonically_increasing_id()})
    order = ["doc_id", "_key", "_order"]
    parts = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    names = [c.split()[0] for c in EDITED.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Ascending order: a document's next one is the row before it.
        before, before_print, first = None, None, True
        held = None
        for frame in slices(frames, "_text"):
            out = []
            for doc_id, text, key, place in frame[["doc_id", "_text", "_key", "_order"]].itertuples(index=False):
                own = before_print if text == before else fingerprint(text)
                ids = (None if pd.isna(doc_id) else int(doc_id), key, place, len(text))
                if held is not None:
                    out.append(held)
                if first:
                    held = (*ids, None, own, None, None, text, True, False)
                else:
                    new = _edit(text, before)
                    held = (*ids, hashlib.sha256(new.encode()).hexdigest(), own, fingerprint(new), before_print)
                    held = (*held, None, False, False)
                before, before_print, first = text, own, False
            if out:
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
        if held is not None:
            held = (*held[:8], before, held[9], True)
            yield pd.DataFrame([held], columns=names).astype({"doc_id": "Int64"})

    walked = written(parts.mapInPandas(run, EDITED))
    seams = walked.filter("_first OR _last")
    # Two rows per task: their order alone goes through one window, their texts join after it.
    ids = seams.select(*order, "_first", "_last")
    whole = Window.partitionBy(F.lit(0))
    step = whole.orderBy(*order)
    linked = ids.select(
        *order,
        "_first",
        *[F.coalesce(F.lag(c).over(step), F.last(c).over(whole.orderBy(*order).rowsBetween(0, Window.unboundedFollowing))).alias(f"{c}_of") for c in ("_order",)],
    ).filter("_first")
    texts = seams.select(F.col("_order").alias("_order_of"), F.col("_text").alias("_before"), F.col("fingerprint").alias("_before_print"))
    open_rows = seams.filter("_first").join(linked.select("_order", "_order_of"), "_order").join(texts, "_order_of")
    mended = open_rows.select("doc_id", "n_chars", "fingerprint", "_text", "_before", "_before_print")

    def mend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "_text"):
            new = [_edit(t, b) for t, b in zip(frame["_text"], frame["_before"], strict=True)]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "n_chars": frame["n_chars"],
                    "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in new],
                    "fingerprint": frame["fingerprint"],
                    "edited_fingerprint": [fingerprint(t) for t in new],
                    "next_fingerprint": frame["_before_print"],
                }
            )

    columns = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    inner = walked.filter("NOT _first").select(*[c.split()[0] for c in columns.split(", ")])
    return inner.unionByName(mended.mapInPandas(mend, columns)).withColumns(
        {
            "near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")),
            "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint")),
        }
    )
