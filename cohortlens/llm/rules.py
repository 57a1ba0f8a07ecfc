"""Quality rules: a threshold table compiled into Spark projections.

A rule is a row (name, measure, comparison, bound). ``measures`` derives all
counts of a text with built-in functions; ``apply_rules`` turns the table into
one boolean column per rule. No Python runs on a row.

Defined results: a NULL text counts as empty; an empty text has zero counts and
fails ``few_words``; rows are independent, so repeated rows and an empty table
need no care; other columns pass through, a clashing one is replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACES, aside, text_or_empty, words_column

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is for that it with as was on are by be this from at or an a "
    "der die das und in zu den von ist mit sich des auf für nicht als auch dem im ein eine einer "
    "le la les de des et un une du en que est pour qui dans sur par pas au avec il elle "
    "el la los las de del y en que un una por con para es se al lo como su"
).split()


@dataclass(frozen=True)
class Rule:
    """Fails a text whose measure is ``<`` or ``>`` the bound. Base rules fail it outright."""

    name: str
    measure: str
    comparison: str
    bound: float
    base: bool = False


RULES = (
    Rule("few_words", "n_words", "<", 10, base=True),
    Rule("repeats", "repeat_percent", ">", 20, base=True),
    Rule("short_words", "mean_word_length", "<", 2),
    Rule("long_words", "mean_word_length", ">", 15),
    Rule("symbols", "symbols_per_word", ">", 0.3),
    Rule("no_stop_words", "stop_word_share", "<", 0.02),
    Rule("repeated_lines", "dup_line_share", ">", 0.5),
    Rule("shouting", "upper_pairs_per_word", ">", 0.5),
)


def _without(text: str, characters: str) -> Column:
    """``text`` less the characters; one plain replacement each beats a translation table."""
    return functools.reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, F.col(text))


def _covered(hits: Column) -> Column:
    """Words covered by windows that start at the sorted positions ``hits``."""
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))

    def add(acc, p):
        end = p + F.lit(WINDOW)
        return F.struct((acc["total"] + end - F.greatest(p, acc["end"])).alias("total"), end.alias("end"))

    return F.aggregate(hits, start, add, lambda acc: acc["total"]).cast("long")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus its counts and ratios.

    Repeated windows are found by their 64-bit hashes: where all hashes of a text
    differ, nothing more is done, else they are sorted and neighbours compared.
    """
    own = ("_text", "_words", "_windows", "_again", "_sorted", "_hits", "_lines")
    docs, restore = aside(docs, *{*own} - {text})
    raw = text_or_empty(text)
    step = docs.withColumn("_text", raw).withColumn("_words", words_column(F.col("_text")))
    step = step.withColumn("n_words", F.size("_words").cast("long"))
    at = lambda i: F.xxhash64(*[F.get("_words", i + F.lit(k)) for k in range(WINDOW)])
    starts = F.when(F.col("n_words") > WINDOW, F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW))
    step = step.withColumn("_windows", F.transform(starts, at))
    step = step.withColumn("_again", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    pairs = F.when(F.col("_again"), F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_sorted", F.sort_array(pairs))
    same = lambda s, j: (s["h"] == F.get("_sorted", j - 1)["h"]) | (s["h"] == F.get("_sorted", j + 1)["h"])
    step = step.withColumn("_hits", F.sort_array(F.transform(F.filter("_sorted", same), lambda s: s["i"])))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != F.lit(""))
    step = step.withColumn("_lines", lines)
    stop = F.filter("_words", lambda w: w.isin(STOP_WORDS))
    n = F.greatest(F.col("n_words"), F.lit(1))
    step = step.withColumns(
        {
            "word_chars": F.length(_without("_text", SPACES)).cast("long"),
            "n_symbols": (F.length("_text") - F.length(_without("_text", SYMBOLS))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(_covered(F.col("_hits")), F.lit(0).cast("long")),
            "n_stop_words": F.size(stop).cast("long"),
            "n_upper_pairs": F.regexp_count("_text", F.lit("[A-Z][A-Z]")).cast("long"),
        }
    )
    step = step.withColumns(
        {
            "repeat_percent": F.col("n_repeat_words") * 100 / n,
            "mean_word_length": F.col("word_chars") / n,
            "symbols_per_word": F.col("n_symbols") / n,
            "upper_pairs_per_word": F.col("n_upper_pairs") / n,
            "stop_word_share": F.col("n_stop_words") / n,
            "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        }
    )
    return restore(step.drop(*own))


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Adds the measures, ``base_failed``, ``kept`` and ``failed``, the names of the failed rules."""
    compared = {
        r.name: F.col(r.measure) < F.lit(r.bound) if r.comparison == "<" else F.col(r.measure) > F.lit(r.bound)
        for r in rules
    }
    failed = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in compared.items()]), lambda x: x.isNotNull())
    base = F.arrays_overlap("failed", F.array(*[F.lit(r.name) for r in rules if r.base]))
    out = measures(docs, text).withColumn("failed", failed)
    return out.withColumns({"base_failed": base, "kept": F.size("failed") == 0})
