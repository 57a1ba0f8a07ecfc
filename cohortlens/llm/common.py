"""Word splitting and table access shared by the operators."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space is the blank and tab to carriage return, nothing else.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\u000b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_column(text: Column) -> Column:
    """The words of a text as an array; empty for a text without any."""
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != F.lit(""))


def aside(docs: DataFrame, *reserved: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with its columns of reserved names renamed, and what gives them their names back."""
    taken = {c.lower() for c in docs.columns} | {r.lower() for r in reserved}
    renamed = {}
    for column in docs.columns:
        if column.lower() in {r.lower() for r in reserved}:
            free = f"{column}_given"
            while free.lower() in taken:
                free += "_"
            taken.add(free.lower())
            renamed[column] = free
    if not renamed:
        return docs, lambda out: out
    return docs.withColumnsRenamed(renamed), lambda out: out.withColumnsRenamed({v: k for k, v in renamed.items()})


def slices(frames: Iterator[pd.DataFrame], column: str, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Cuts batches so that a slice holds about ``chars`` characters, one row at least."""
    for frame in frames:
        sizes = frame[column].str.len().to_numpy()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > chars:
                yield frame.iloc[start:i]
                start, held = i, 0
            held += size
        if start < len(frame):
            yield frame.iloc[start:]


def arrow_slices(batch: pa.RecordBatch, column: str, size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``size`` bytes of a text column, one row at least."""
    ends = np.cumsum([0, *(len(t.as_buffer()) for t in batch.column(column))])
    start = 0
    while start < batch.num_rows:
        stop = max(bisect_left(ends, ends[start] + size) - 1, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


MOST_BITS = 1 << 28


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """One bit per residue of the keys (64-bit integers), for filters that may let too much pass.

    It grows with the number of keys up to ``MOST_BITS``, 32 MB, so it may be sent to
    all tasks; beyond that the filter only gets weaker. Bits are combined in the map
    tasks and reach the driver in words of 64. ``keys`` is read twice.
    """
    bits, count = 1 << 20, keys.count()
    while bits < 8 * count and bits < MOST_BITS:
        bits *= 2
    place = F.pmod(F.col(column), F.lit(bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 64) AS int))")
    words = keys.groupBy(F.floor(place / 64).cast("long").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (unsigned) may be among those of the bitmap."""
    at = keys & np.uint64(len(marks) * 64 - 1)
    return (marks[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
