"""Best-fit decreasing packing of token sequences.

1. Texts are tokenised where they are read; a document's ids end with an end id. Only
   documents longer than a sequence are cut, into pieces of full length but for a first
   one that may be shorter.
2. Piece lengths are whole numbers up to the sequence length, so the corpus reaches the
   packer as one count per length, at most as many rows as a sequence has tokens.
3. Lengths are placed longest first, each piece in the open bin with the least room that
   holds it. A segment tree over the remaining capacities finds that room in logarithmic
   time. Pieces of one length are alike: best fit fills a chosen bin with them until
   there is no room for one more, so it is asked once for a run of bins with equal
   contents instead of once for each piece, and runs are what bins are kept as. Their
   number depends on the sequence length alone.
4. Each piece's place in the count of its length (its rank) names its bin and offset. Ranks
   come from the counts of the tasks that wrote the pieces and its number within its task.

Defined results: a NULL text counts as empty, and has the end id alone; rows are packed
one by one, also those that repeat a doc_id or have none; control strings of the
vocabulary inside a text are plain text; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.bpe import byte_characters
from cohortlens.llm.common import arrow_slices, table, text_or_empty
from cohortlens.llm.role_repair import arrow_schema
from cohortlens.sources.tables import written

VOCABULARY = "byte_bpe_50k.json"
LENGTH, END_ID = 1024, 2
# A rank is below this: lengths and ranks share one sorted key.
MOST_RANKS = 1 << 50
LONG_SPACE = re.compile(r"\s{500}")


class Capacities:
    """Segment tree over remaining capacities 0..top: where bins are open, and the tightest that fits."""

    def __init__(self, top: int):
        self._size = 1 << top.bit_length()
        self._open = [0] * (2 * self._size)  # number of runs of bins below each node

    def change(self, capacity: int, by: int) -> None:
        node = self._size + capacity
        while node:
            self._open[node] += by
            node //= 2

    def tightest(self, need: int) -> int | None:
        """The least capacity of at least ``need`` that has an open bin."""
        node = self._size + need
        if not self._open[node]:
            while node > 1 and (node & 1 or not self._open[node + 1]):
                node //= 2  # up, while there is nothing open to the right below the same parent
            if node <= 1:
                return None
            node += 1
            while node < self._size:
                node = 2 * node if self._open[2 * node] else 2 * node + 1
        return node - self._size


@dataclass(frozen=True)
class Run:
    """Pieces of one length with ranks from ``rank``, ``each`` to a bin from ``first`` on, behind ``offset`` tokens."""

    length: int
    rank: int
    first: int
    each: int
    offset: int


def place(counts: Iterable[tuple[int, int]], top: int = LENGTH) -> tuple[list[Run], int]:
    """Best-fit decreasing of pieces given as (length, count): the runs and the number of bins."""
    tree, bins = Capacities(top), 0
    runs: list[Run] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}  # capacity -> runs of bins (first, number)

    def keep(capacity: int, first: int, number: int) -> None:
        if capacity and number:
            open_bins.setdefault(capacity, []).append((first, number))
            tree.change(capacity, 1)

    for length, count in sorted(counts, reverse=True):
        rank = 0
        while rank < count:
            left = count - rank
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first, number = top, bins, -(-left // (top // length))
                bins += number
            else:
                first, number = open_bins[capacity].pop()
                tree.change(capacity, -1)
            each = capacity // length
            used = min(number, -(-left // each))
            keep(capacity, first + used, number - used)
            placed = min(left, used * each)
            full, rest = divmod(placed, each)
            keep(capacity - each * length, first, full)
            keep(capacity - rest * length, first + full, int(rest > 0))
            runs.append(Run(length, rank, first, each, top - capacity))
            rank += placed
    return runs, bins


def read_ranks(path: str) -> dict[bytes, int]:
    """The ids of a byte-level BPE tokenizers file by the bytes of their tokens, added tokens left out.

    Ids must rise with the order of merges, so that merging the pair of least id first is
    what the file says.
    """
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    vocabulary, added = data["model"]["vocab"], {t["content"] for t in data["added_tokens"]}
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in data["model"]["merges"]]
    if any(a >= b for a, b in pairwise(merged)):
        raise ValueError(f"the ids of {path} are not in the order of its merges")
    back = {c: b for b, c in enumerate(byte_characters())}
    return {bytes(back[c] for c in token): i for token, i in vocabulary.items() if token not in added}


class Encoder:
    """Token ids of texts by a byte-level BPE tokenizers file whose splitting ``pattern`` describes.

    Texts with very long runs of white space, which the encoder's own splitting cannot hold, are
    split here and encoded pre-token by pre-token.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        model = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        self._encode = model.encode_ordinary
        self._split = regex.compile(pattern).findall

    def __call__(self, text: str) -> np.ndarray:
        if LONG_SPACE.search(text):
            return np.fromiter(chain.from_iterable(map(self._encode, self._split(text))), "<u4")
        return np.array(self._encode(text), "<u4")


def cuts(n: int, top: int = LENGTH) -> list[int]:
    """Where the pieces of n tokens start: only the first is shorter than ``top``, if any."""
    return [0, *range(n - (n - 1) // top * top, n, top)]


def pieces(
    docs: DataFrame, path: str, pattern: str, top: int = LENGTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, part, nth[, ids]): ``nth`` counts the pieces of a
    length within the task ``part``, so both name a piece once the rows are written."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    extra = "piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(extra)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, seen = Encoder(path, pattern), TaskContext.get().partitionId(), np.zeros(top + 1, np.int64)
        to_arrow = arrow_schema(schema)
        for whole in batches:
            for batch in arrow_slices(whole, "text"):
                found = []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    ids = np.append(encode(text), np.uint32(end_id))
                    starts = cuts(len(ids), top)
                    for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                        own = ids[a:b]
                        crc = zlib.crc32(own.tobytes())
                        found.append((row, i, a, b - a, crc, part, int(seen[b - a]), *([own] if with_ids else [])))
                        seen[b - a] += 1
                columns = list(zip(*found, strict=True))
                ids_of = batch.column("doc_id").take(pa.array(columns[0], pa.int64()))
                arrays = [ids_of, *(pa.array(c, f.type) for c, f in zip(columns[1:], list(to_arrow)[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, schema=to_arrow)

    return rows.mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, pattern: str, top: int = LENGTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]), one per piece."""
    cut = written(pieces(docs, path, pattern, top, end_id, with_ids))
    per_task = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = written(per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = [(r["length"], r["n"]) for r in based.groupBy("length").agg(F.sum("n").alias("n")).collect()]  # <= top rows
    runs = sorted(place(counts, top)[0], key=lambda r: (r.length, r.rank))
    plan = {name: np.array([getattr(r, name) for r in runs], np.int64) for name in Run.__dataclass_fields__}
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    ranked = cut.join(based.select("length", "part", "base"), ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    ranked = ranked.drop("part", "nth", "base")
    added = T._parse_datatype_string("sequence_id long, offset long")
    schema = T.StructType([f for f in ranked.schema if f.name != "rank"] + list(added))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        keys = p["length"] * MOST_RANKS + p["rank"]
        for batch in frames:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * MOST_RANKS + rank, side="right") - 1
            sequence, nth = np.divmod(rank - p["rank"][at], p["each"][at])
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(p["first"][at] + sequence))
            yield out.append_column("offset", pa.array(p["offset"][at] + nth * length))

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return ranked.mapInArrow(run, schema).select(*columns)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences of pieces packed ``with_ids``: rows (sequence_id, ids, starts), where
    ``starts`` are the offsets at which pieces begin. A group holds one sequence's tokens."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = packed.groupBy("sequence_id").agg(placed.alias("pieces"))
    return grouped.select(
        "sequence_id",
        F.flatten(F.col("pieces.ids")).alias("ids"),
        F.col("pieces.offset").alias("starts"),
    )


def op12_best_fit(spark, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed into sequences of 1024 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
