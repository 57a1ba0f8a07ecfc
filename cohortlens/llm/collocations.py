"""Phrase collocations by set-oriented mining (SETM) over occurrence relations.

An occurrence relation has a row (doc, at, phrase) for every place where a frequent phrase
of one length starts: ``doc`` numbers the document, ``at`` the word's place in it, and the
end of a piece takes a place of its own, so that places one apart are neighbours within one
piece.

1. Words are counted per language, combined in the map tasks. Frequent words get numbers,
   and one more pass gives the relation of their occurrences.
2. A merge-join of the relation with itself, dealt and sorted by document and place, on (doc,
   adjacent place) gives the occurrences of phrases one word longer whose first and last part
   are frequent. They are persisted in that order; a phrase is the pair of its parts' numbers,
   which is exact.
3. Those are counted by phrase; a semi-join with the frequent ones gives the next relation.

So no occurrence of a phrase that cannot be frequent goes on. Lists of frequent phrases are
broadcast only while they have at most ``BROADCAST_ROWS`` rows; beyond that their join with
the occurrences is a shuffle, in which keys with more than a partition's share are broadcast
alone (``skew.lookup_join``).

Every part of a frequent phrase is frequent itself, so the counts of both sides of each cut
are in the lists. A score is floor(1000 a n / (l r)) in decimals of 38 digits, which hold it
for up to 10^17 words a language. A phrase is redundant if a longer one around it is as
frequent; then one that is longer by one word is.

Defined results: a NULL text has no words; NULL languages are ``und``; rows are counted one by
one, repeated ones too; words are compared as they are but for A-Z in lower case; ties are
broken by the phrase's UTF-8 bytes; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import table, text_or_empty
from cohortlens.llm.skew import lookup_join
from cohortlens.sources.tables import written

# What ends a piece; a blank or tab parts words.
ENDS = "[.,;:!?\\n\\x0B\\f\\r]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, LONGEST, TOP = 100, 5, 2000
BROADCAST_ROWS = 1 << 20


def _tokens(docs: DataFrame) -> DataFrame:
    """Rows (doc, at, lang, word); a piece's end is the word of one line break."""
    text = F.regexp_replace(F.translate(text_or_empty(), UPPER, LOWER), ENDS, " \n ")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), lang, F.split(text, "[ \\t]+").alias("words"))
    return rows.select("doc", "lang", F.posexplode("words").alias("at", "word")).withColumn("at", F.col("at").cast("long"))


def _is_word() -> Column:
    return ~F.col("word").isin("", "\n")


def _numbered(groups: DataFrame) -> DataFrame:
    """The groups, persisted under numbers of their own."""
    return written(groups.withColumn("phrase", F.monotonically_increasing_id()))


def _looked_up(occurrences: DataFrame, groups: DataFrame, on: list[str], rows: str) -> DataFrame:
    """Occurrences (doc, at, phrase) of the listed groups."""
    if groups.count() <= BROADCAST_ROWS:
        found = occurrences.join(F.broadcast(groups.select(*on, "phrase")), on)
    else:
        key = F.struct(*on)
        listed = groups.select(key.alias("_key"), "phrase", F.col(rows))
        found = lookup_join(occurrences.withColumn("_key", key), listed, "_key", rows).filter("phrase IS NOT NULL")
    return found.select("doc", "at", "phrase")


def _longer(relation: DataFrame) -> DataFrame:
    """Rows (doc, at, head, tail) where a phrase of the relation starts one place before another.

    One exchange deals the relation by document; each task sorts its part and merges it
    with itself, a place against the next one, holding the last row of a batch.
    """
    dealt = relation.repartition("doc").sortWithinPartitions("doc", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tuple(np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            new = (batch.column(c).to_numpy() for c in ("doc", "at", "phrase"))
            doc, at, phrase = (np.concatenate(pair) for pair in zip(held, new, strict=True))
            if len(doc):
                next_to = np.flatnonzero((doc[1:] == doc[:-1]) & (at[1:] == at[:-1] + 1))
                columns = doc[next_to], at[next_to], phrase[next_to], phrase[next_to + 1]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "at", "head", "tail"])
                held = doc[-1:], at[-1:], phrase[-1:]

    return dealt.mapInArrow(run, "doc long, at long, head long, tail long")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, n), and per length the frequent phrases: (lang, words, f, phrase, head, tail)."""
    tokens = _tokens(docs.select("text", "lang"))
    counted = written(tokens.filter(_is_word()).groupBy("lang", "word").agg(F.count("*").alias("f")))
    sizes = written(counted.groupBy("lang").agg(F.sum("f").alias("n")))
    none = F.lit(None).cast("long")
    groups = _numbered(counted.filter(F.col("f") >= least))
    levels = [groups.select("lang", F.array("word").alias("words"), "f", "phrase", none.alias("head"), none.alias("tail"))]
    found = _looked_up(tokens, groups, ["lang", "word"], "f")
    for length in range(2, longest + 1):
        occurrences = written(_longer(found))
        often = occurrences.groupBy("head", "tail").agg(F.count("*").alias("f")).filter(F.col("f") >= least)
        before = levels[-1]
        heads = before.select(F.col("phrase").alias("head"), "lang", "words")
        tails = before.select(F.col("phrase").alias("tail"), F.element_at("words", -1).alias("_last"))
        named = written(often).join(heads, "head").join(tails, "tail")
        words = F.concat("words", F.array("_last")).alias("words")
        groups = _numbered(named.select("lang", words, "f", "head", "tail"))
        levels.append(groups.select("lang", "words", "f", "phrase", "head", "tail"))
        if length < longest:
            found = _looked_up(occurrences, groups, ["head", "tail"], "f")
    return sizes, levels


def _scored(sizes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Rows (lang, words, a, l, r, n, score): each candidate with its lowest-scoring cut."""
    counts = reduce(DataFrame.unionByName, [x.select("lang", "words", "f") for x in levels])
    candidates = reduce(DataFrame.unionByName, [x.select("lang", "words", F.col("f").alias("a")) for x in levels[1:]])
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    left = F.slice("words", F.lit(1), F.col("k"))
    right = F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))
    of = lambda words, f: counts.select("lang", F.col("words").alias(words), F.col("f").alias(f))
    both = cut.withColumns({"_left": left, "_right": right})
    both = both.join(of("_left", "l"), ["lang", "_left"]).join(of("_right", "r"), ["lang", "_right"]).join(sizes, "lang")
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    above = (whole("a") * whole("n")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", above.cast("decimal(38,0)"), (whole("l") * whole("r")).cast("decimal(38,0)")).cast("long")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_best")
    chosen = both.groupBy("lang", "words", "a", "n").agg(best)
    return chosen.select("lang", "words", "a", "_best.l", "_best.r", "n", "_best.score")


def _redundant(levels: list[DataFrame]) -> DataFrame:
    """Candidates (lang, words) inside a phrase longer by one word that is as frequent."""
    out = []
    for shorter, longer in zip(levels[1:], levels[2:], strict=False):
        part = longer.select("f", F.explode(F.array("head", "tail")).alias("phrase")).distinct()
        out.append(shorter.join(part, ["phrase", "f"], "left_semi").select("lang", "words"))
    return reduce(DataFrame.unionByName, out)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score), at most ``top`` a language; ``longest`` is 3 at least.

    The best of each language are chosen within a hash part first, so a language is not one task.
    """
    sizes, levels = mine(docs, least, longest)
    kept = _scored(sizes, levels).join(_redundant(levels), ["lang", "words"], "left_anti")
    named = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "n", "score")
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    parted = named.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = parted.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    best = first.filter(F.col("_place") <= top).drop("_part", "_place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_setm(spark, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))
