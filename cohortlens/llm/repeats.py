"""Substring deduplication with repeated-phrase automata.

Every word of a document that lies in a window of ``WINDOW`` consecutive words whose
sequence also starts in a document with a smaller doc_id is removed.

1. Fingerprints: of the hashes of the 5-word pieces in a window the least stands for
   it (winnowing). Equal windows have equal fingerprints, so a window can recur only
   if its fingerprint does, in texts that differ. One exchange finds those.
2. Windows under recurring fingerprints are exchanged by hash; the least doc_id of
   each is its source, every other document that has it a follower. Which
   fingerprints recur travels as a bitmap of bounded size: a false hit sends a window
   too many, none is missed.
3. Followers are dealt to shards. A source sends each shard the passages that its
   followers need, runs of its recurring windows as text. A shard compiles the 7-word
   blocks of its passages into an Aho-Corasick automaton and streams its documents:
   every window holds a whole block, so the hits locate every occurrence, and the
   words of each located window are compared with the passages' windows.

Copies of a whole text need no windows: all but the least doc_id lose every word.

Defined results: a NULL text has no words; texts shorter than a window keep all
words; windows that recur only within one doc_id stay; rows with one doc_id and
different texts are one document for the choice of the source, and each is cut by the
others' smaller ids only; a NULL doc_id is larger than any other; other columns are
dropped. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import aside, bitmap, in_bitmap, slices, text_or_empty, words_column
from cohortlens.llm.skew import lookup_join
from cohortlens.sources.tables import written

WINDOW, PIECE, BLOCK = 13, 5, 7
SHARD_WORDS = 100_000
NO_ID = (1 << 63) - 1


class Hashes:
    """64-bit hashes of words and of runs of words, in a few numpy passes over a text.

    A word's hash sums its bytes' values, each times an own number for its place in the word.
    These numbers follow no rule that texts could match (powers of one number would: there
    are words of 1,024 letters and more that are equal under any of them). The hash of a run of
    words, 13 at most, is a difference of two prefix sums over word hashes weighted by powers,
    made independent of its place by the inverse weight (odd weights have one modulo 2^64).
    """

    _STEP = 0x9E3779B97F4A7C15

    def __init__(self):
        self._values = np.random.default_rng(64).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self._space = np.zeros(256, bool)
        self._space[[32, 9, 10, 11, 12, 13]] = True
        self._places = np.zeros(0, np.uint64)
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        for name, step in (("_weight", self._STEP), ("_inverse", pow(self._STEP, -1, 1 << 64))):
            setattr(self, name, np.cumprod(np.full(size, step, np.uint64)))

    @staticmethod
    def _mixed(x: np.ndarray) -> np.ndarray:
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def _place_numbers(self, size: int) -> np.ndarray:
        """An odd number for each place in a word, from a mix of the place."""
        if size > len(self._places):
            at = np.arange(1, max(size, 2 * len(self._places), 64) + 1, dtype=np.uint64) * np.uint64(self._STEP)
            self._places = self._mixed(self._mixed(at) * np.uint64(0x94D049BB133111EB)) | np.uint64(1)
        return self._places

    def __call__(self, data: bytes) -> np.ndarray:
        """The hash of each word of a text in UTF-8."""
        codes = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = ~self._space[codes]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        if not len(starts):
            return np.zeros(0, np.uint64)
        sizes = ends - starts
        first = np.cumsum(sizes) - sizes
        place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
        numbers = self._place_numbers(int(sizes.max()))
        weighted = self._values[codes[inside[1:-1].view(bool)]] * numbers[place]
        return self._mixed(np.add.reduceat(weighted, first))

    def _stretches(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(values) > len(self._weight):
            self._grow(2 * len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._weight[: len(values)], out=sums[1:])
        return self._mixed((sums[ends] - sums[starts]) * self._inverse[starts])

    def runs(self, words: np.ndarray, length: int) -> np.ndarray:
        """The hash of each run of ``length`` words."""
        starts = np.arange(max(len(words) - length + 1, 0))
        return self._stretches(words, starts, starts + length) + np.uint64(length)


def window_fingerprints(hashes: Hashes, words: np.ndarray) -> np.ndarray:
    """For each window the least hash of its pieces."""
    least = hashes.runs(words, PIECE)
    width, need = 1, WINDOW - PIECE + 1
    while width < need:
        step = min(width, need - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def split(text: str) -> list[bytes]:
    """The words in UTF-8; bytes are split at the blank and tab to carriage return only."""
    return text.encode().split()


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(_id().alias("doc_id"), text_or_empty().alias("text"))


def _digest(words: Iterable[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _base(rows: DataFrame) -> DataFrame:
    """Per row its words and the digest of all of them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [(len(w), _digest(w)) for w in map(split, frame["text"])]
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "n_words": [m[0] for m in made], "whole": [m[1] for m in made]}
            )

    return rows.mapInPandas(run, "doc_id long, n_words long, whole string")


def _fingerprints(rows: DataFrame) -> DataFrame:
    """Rows (fingerprint, node): node stands for the text, equal for its copies."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        hashes = Hashes()
        for frame in slices(frames, "text"):
            prints, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for text in frame["text"]:
                hashed = hashes(text.encode())
                if len(hashed) < WINDOW:
                    continue
                own = np.unique(window_fingerprints(hashes, hashed))
                prints.append(own)
                node = np.uint64(xxhash.xxh3_64_intdigest(hashed.tobytes())).astype(np.int64)
                nodes.append(np.full(len(own), node))
            yield pd.DataFrame({"print": np.concatenate(prints).view(np.int64), "node": np.concatenate(nodes)})

    return rows.mapInPandas(run, "print long, node long")


def _sorted_groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[pd.DataFrame, np.ndarray, object]]:
    """Batches of rows sorted by ``key`` with the mask of rows that begin a new key, and the key before."""
    before = None
    for frame in frames:
        if len(frame):
            keys = frame[key].to_numpy()
            begins = np.empty(len(keys), bool)
            begins[1:] = keys[1:] != keys[:-1]
            begins[0] = before is None or keys[0] != before
            yield frame, begins, before
            before = keys[-1]


def _recurring(prints: DataFrame) -> DataFrame:
    """Fingerprints that occur in more than one text.

    Each is combined within the map tasks first, so one in most documents is no load.
    """
    both = prints.groupBy("print").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    return both.filter("a <> b").select("print")


def _windows(rows: DataFrame, marks: np.ndarray) -> DataFrame:
    """Rows (window, doc_id): distinct windows of a document under recurring fingerprints."""
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for frame in slices(frames, "text"):
            found, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                hashed = hashes(text.encode())
                if len(hashed) < WINDOW:
                    continue
                hit = in_bitmap(shared.value, window_fingerprints(hashes, hashed))
                if hit.any():
                    own = np.unique(hashes.runs(hashed, WINDOW)[hit])
                    found.append(own)
                    ids.append(np.full(len(own), doc_id))
            yield pd.DataFrame({"window": np.concatenate(found).view(np.int64), "doc_id": np.concatenate(ids)})

    return rows.mapInPandas(run, "window long, doc_id long")


def _followers(windows: DataFrame) -> DataFrame:
    """Rows (doc_id, window, source) of documents that have a window of a smaller doc_id.

    Rows arrive sorted by window and doc_id; a task remembers one window's source.
    """
    dealt = windows.repartition("window").sortWithinPartitions("window", "doc_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = None
        for frame, begins, _ in _sorted_groups(frames, "window"):
            ids = frame["doc_id"].to_numpy()
            last = np.maximum.accumulate(np.where(begins, np.arange(len(ids)), -1))
            sources = np.where(last >= 0, ids[np.maximum(last, 0)], source if source is not None else 0)
            source = sources[-1]
            follows = ids > sources
            yield pd.DataFrame(
                {"doc_id": ids[follows], "window": frame["window"].to_numpy()[follows], "source": sources[follows]}
            )

    return dealt.mapInPandas(run, "doc_id long, window long, source long")


def _passages(words: list[bytes], windows: np.ndarray, wanted: np.ndarray) -> list[bytes]:
    """Runs of the wanted windows as text."""
    starts = np.flatnonzero(np.isin(windows, wanted))
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > 1) + 1
    return [b" ".join(words[run[0] : run[-1] + WINDOW]) for run in np.split(starts, cuts)]


def _may_be(ids: DataFrame) -> Column:
    """Whether a row's doc_id may be among ``ids`` (a written table); false only where it is not.

    Texts of which it is false need no exchange for a join with ``ids``.
    """
    shared = ids.sparkSession.sparkContext.broadcast(bitmap(ids, "doc_id"))

    @F.pandas_udf("boolean")
    def among(doc_ids: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, doc_ids.to_numpy().astype(np.uint64)))

    return among(_id())


def _to_shards(rows: DataFrame, followers: DataFrame, shards: int) -> DataFrame:
    """Rows (shard, kind, doc_id, text): passages of sources (kind 0), documents of followers (kind 1)."""
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    wanted = followers.select(F.col("source").alias("doc_id"), "window", F.col("doc_id").alias("_of"))
    wanted = (
        wanted.select("doc_id", F.struct(F.pmod(F.xxhash64("_of"), F.lit(shards)).cast("int").alias("shard"), "window").alias("w"))
        .groupBy("doc_id")
        .agg(F.collect_set("w").alias("w"))  # one exchange: a window once per shard that needs it
        .select("doc_id", F.col("w.shard").alias("to"), F.col("w.window").alias("wanted"))
    )
    own = followers.select("doc_id").distinct().withColumn("follows", shard)
    roles = wanted.join(own, "doc_id", "full_outer")
    ids = written(followers.select(F.explode(F.array("doc_id", "source")).alias("doc_id")).distinct())
    joined = rows.filter(_may_be(ids)).join(roles, "doc_id").select("doc_id", "text", "follows", "to", "wanted")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for frame in slices(frames, "text"):
            out = []
            for doc_id, text, follows, to, asked in frame.itertuples(index=False):
                if not pd.isna(follows):
                    out.append((int(follows), 1, doc_id, text))
                if asked is not None and len(asked):
                    words = split(text)
                    windows = hashes.runs(hashes(text.encode()), WINDOW)
                    to, asked = np.asarray(to), np.asarray(asked, np.int64).view(np.uint64)
                    for one in np.unique(to).tolist():
                        out += [(one, 0, doc_id, p.decode()) for p in _passages(words, windows, asked[to == one])]
            if out:
                yield pd.DataFrame(out, columns=["shard", "kind", "doc_id", "text"])

    return joined.mapInPandas(run, "shard int, kind int, doc_id long, text string")


class Phrases:
    """The passages of a shard: automaton of their blocks and the source of each of their windows."""

    def __init__(self):
        import ahocorasick

        self._automaton, self._sources = ahocorasick.Automaton(), {}
        self._ready = False

    def add(self, passage: str, source: int) -> None:
        """``passage``: words joined by one blank each."""
        words = passage.split(" ")
        starts = [0, *accumulate(len(w) + 1 for w in words)]
        for i in range(0, len(words) - BLOCK + 1, BLOCK):
            self._automaton.add_word(f" {passage[starts[i] : starts[i + BLOCK] - 1]} ", 0)
        known, get = self._sources, self._sources.get
        for begin, end in zip(starts, starts[WINDOW:], strict=False):
            key = passage[begin : end - 1]
            if get(key, NO_ID) >= source:
                known[key] = source

    def covered(self, joined: str, doc_id: int) -> np.ndarray:
        """Which words of a text, joined by one blank each, lie in a window of a smaller doc_id."""
        words = joined.split(" ")
        mask = np.zeros(len(words) + 1, np.int32)
        if len(words) >= WINDOW and self._sources:
            if not self._ready:
                self._automaton.make_automaton()
                self._ready = True
            starts = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], starts))
            ends = np.fromiter((end for end, _ in self._automaton.iter(f" {joined} ")), np.int64)
            # A hit ends at the blank behind a block; the block's first word is BLOCK words before.
            first = np.searchsorted(starts, ends) - BLOCK
            tried = np.unique((first[:, None] - np.arange(WINDOW - BLOCK + 1)).reshape(-1))
            tried = tried[(tried >= 0) & (tried + WINDOW <= len(words))]
            get, begins, stops = self._sources.get, starts[tried].tolist(), (starts[tried + WINDOW] - 1).tolist()
            held = [get(joined[b:e], doc_id) < doc_id for b, e in zip(begins, stops, strict=True)]
            gone = tried[np.array(held, bool)]
            np.add.at(mask, gone, 1)
            np.add.at(mask, gone + WINDOW, -1)
        return np.cumsum(mask[:-1]) > 0


def _stream(sharded: DataFrame, shards: int) -> DataFrame:
    """Per follower the number and digest of the words left."""
    dealt = sharded.repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, phrases = None, None
        for frame in frames:
            out = []
            for own, kind, doc_id, text in frame[["shard", "kind", "doc_id", "text"]].itertuples(index=False):
                if own != shard:
                    shard, phrases = own, Phrases()
                if kind == 0:
                    phrases.add(text, doc_id)
                    continue
                joined = b" ".join(split(text))
                gone = phrases.covered(joined.decode(), doc_id)
                kept = " ".join(compress(joined.decode().split(" "), (~gone).tolist()))
                out.append((doc_id, hashlib.sha256(joined).hexdigest(), int(gone.sum()), kept))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "whole", "n_removed", "kept"])

    return dealt.mapInPandas(run, "doc_id long, whole string, n_removed long, kept string")


def remove(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256, kept): ``kept`` is the text that is left where
    words were removed, NULL where all words stay."""
    rows = _rows(docs)
    base = written(_base(rows))
    marks = bitmap(written(_recurring(_fingerprints(rows))), "print")
    spark = docs.sparkSession
    followers = written(_followers(_windows(rows, marks)))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), followers.count() // SHARD_WORDS)
    cut = _stream(_to_shards(rows, followers, shards), shards).dropDuplicates(["doc_id", "whole"])
    groups = base.filter(F.col("n_words") >= WINDOW).groupBy("whole")
    firsts = written(groups.agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    known = lookup_join(base, firsts.filter("copies > 1"), "whole", "copies")
    copy = F.col("first").isNotNull() & (F.col("doc_id") > F.col("first"))
    joined = known.join(cut, ["doc_id", "whole"], "left")
    changed = F.coalesce(F.col("n_removed"), F.lit(0)) > 0
    return joined.select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256))
        .when(changed, F.sha2(F.col("kept"), 256))
        .otherwise(F.col("whole"))
        .alias("kept_sha256"),
        F.when(copy, F.lit("")).when(changed, F.col("kept")).alias("kept"),
        F.col("whole"),
    )


def apply(docs: DataFrame) -> DataFrame:
    """``docs`` with the words removed: a text that lost words is what is left, joined by one
    blank each, and ``n_chars``, if there, its length; other texts stay as they are, and so do
    all other columns, whatever their names.

    Only rows whose doc_id lost words somewhere are exchanged.
    """
    docs, restore = aside(docs, "_id", "_of", "_kept", "_whole")
    removed = remove(docs).filter("n_removed > 0").dropDuplicates(["doc_id", "whole"])
    changed = written(removed.select(F.col("doc_id").alias("_id"), F.col("whole").alias("_of"), F.col("kept").alias("_kept")))
    touched = _may_be(changed.select(F.coalesce("_id", F.lit(NO_ID)).alias("doc_id")))
    digest = F.sha2(F.array_join(words_column(text_or_empty()), " "), 256)
    joined = docs.filter(touched).withColumn("_whole", digest).join(
        changed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_whole") == F.col("_of")), "left"
    )
    new = {"text": F.coalesce("_kept", "text")}
    if "n_chars" in docs.columns:
        length = F.when(F.col("_kept").isNotNull(), F.length("_kept")).otherwise(F.col("n_chars"))
        new["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    cut = joined.withColumns(new).select(*docs.columns)
    return restore(cut.unionByName(docs.filter(~touched)))
