"""Mixing sources to target weights by soft domain membership.

A naive Bayes classifier, fitted on the rows of a labelled table, gives every
document a posterior over domains. Nonnegative rates are then fitted so that the
expected tokens of each domain, rate x tokens x posterior summed over documents,
meet a target: least squares by projected gradient, where one step is one
aggregation over a compact table and one expression per document. DataFrame
functions only, no Python on rows.

Writing q_k for the share of tokens in domain k and S_k for its expected share under
the rates, a step is rate <- max(least, rate - sum_k p_k (S_k - t_k) / q_k), least = 0 or 1. This is the
gradient step of 1/2 sum_k (S_k - t_k)^2 / q_k in the metric of tokens; its largest
curvature is 1, so the step length is 1.

Defined results: a NULL text counts as empty; a text without a known word has the
prior as posterior; a document without tokens takes part in no sum and gets the rate
of its posterior; rows equal in doc_id and text share one row and count each (column
``n_rows``); a domain without tokens cannot be raised and is left out of the step; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import aside, text_or_empty, words_column
from cohortlens.sources.tables import written


@dataclass(frozen=True)
class Mixing:
    """``targets``: weight of each domain, scaled to sum 1. ``budget``: expected tokens as a
    multiple of the given ones; None takes the least for which no domain has to shrink, and no rate
    is below 1 then, so that every document stays. Targets that no rates meet within
    ``tolerance`` are approached in least squares, with a warning; not to come to rest within
    ``steps`` is an error.
    The classifier is fitted on at most ``fit_rows`` labelled rows, chosen by a hash of
    their ids, and knows their ``vocabulary`` most frequent words; ``evidence`` bounds the
    number of words that a posterior may rest on, so that long texts stay soft."""

    targets: Mapping[str, float] = field(default_factory=lambda: {"de": 0.25, "en": 0.25, "es": 0.25, "fr": 0.25})
    domain: str = "lang"
    budget: float | None = 1.0
    fit_rows: int = 5_000
    vocabulary: int = 2_000
    evidence: float = 20.0
    steps: int = 40
    tolerance: float = 1e-4

    @property
    def domains(self) -> list[str]:
        return sorted(self.targets)

    @property
    def weights(self) -> list[float]:
        total = sum(self.targets.values())
        return [self.targets[d] / total for d in self.domains]


def _words(text: Column) -> Column:
    """The runs of letters in lower case: marks between words say nothing about a domain."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}]+"), lambda w: w != F.lit(""))


def classifier(docs: DataFrame, labels: DataFrame, mixing: Mixing) -> tuple[DataFrame, list[float]]:
    """Per word the log-likelihood of each domain (at most ``vocabulary`` rows), and the log priors."""
    order = F.xxhash64("doc_id")
    ids = labels.select("doc_id").filter("doc_id IS NOT NULL").orderBy(order, "doc_id").limit(mixing.fit_rows)
    rows = docs.select("doc_id", text_or_empty().alias("_text"), F.col(mixing.domain).alias("_domain"))
    fitted = rows.filter(F.col("_domain").isin(mixing.domains)).join(F.broadcast(ids), "doc_id")
    in_domain = [F.count_if(F.col("_domain") == d) for d in mixing.domains]
    found = fitted.agg(F.array(*in_domain)).first()[0]
    total = sum(found) + len(found)
    priors = [math.log((n + 1) / total) for n in found]
    each = fitted.select("_domain", F.explode(_words(F.col("_text"))).alias("word"))
    counted = each.groupBy("word").agg(*[c.alias(f"n{k}") for k, c in enumerate(in_domain)], F.count("*").alias("n"))
    top = written(counted.orderBy(F.desc("n"), "word").limit(mixing.vocabulary))
    sums = top.agg(F.array(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)) + F.count("*") for k in range(len(in_domain))])).first()[0]
    logs = [F.log((F.col(f"n{k}") + 1) / F.lit(max(s, 1))).alias(f"l{k}") for k, s in enumerate(sums)]
    return top.select("word", *logs), priors


def posteriors(docs: DataFrame, model: DataFrame, priors: list[float], mixing: Mixing) -> DataFrame:
    """Rows (doc_id, text_key, n_rows, n_tokens, p): one per distinct document and text."""
    k = range(len(priors))
    text = text_or_empty()
    keyed = docs.select(
        "doc_id",
        F.xxhash64(text).alias("text_key"),
        F.size(words_column(text)).cast("long").alias("n_tokens"),
        _words(text).alias("_words"),
    )
    # The empty word marks a row; it also keeps texts without words.
    marked = keyed.select(
        "doc_id",
        "text_key",
        "n_tokens",
        F.explode(F.concat(F.array(F.lit("")), F.col("_words"))).alias("word"),
    )
    joined = marked.join(F.broadcast(model), "word", "left")
    sums = joined.groupBy("doc_id", "text_key", "n_tokens").agg(
        F.count_if(F.col("word") == "").alias("n_rows"),
        F.count("l0").alias("_hits"),
        *[F.coalesce(F.sum(f"l{i}"), F.lit(0.0)).alias(f"_s{i}") for i in k],
    )
    hits = F.col("_hits") / F.col("n_rows")
    share = F.lit(mixing.evidence) / F.greatest(hits, F.lit(mixing.evidence)) / F.col("n_rows")
    logits = F.array(*[F.lit(priors[i]) + F.col(f"_s{i}") * share for i in k])
    powers = F.transform("_logits", lambda x: F.exp(x - F.array_max("_logits")))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return (
        sums.withColumn("_logits", logits)
        .withColumn("_powers", powers)
        .withColumn("_total", total("_powers"))
        .withColumn("p", F.transform("_powers", lambda x: x / F.col("_total")))
        .select("doc_id", "text_key", "n_rows", "n_tokens", "p")
    )


def _rate(start: float, steps: list[list[float]], least: float) -> Column:
    """The rate after the steps so far, each a list of (S_k - t_k) / q_k, projected on ``least`` or more."""
    if not steps:
        return F.lit(start)
    history = F.array(*[F.array(*[F.lit(x) for x in step]) for step in steps])

    def move(rate: Column, step: Column) -> Column:
        along = sum((F.get("p", F.lit(i)) * F.get(step, F.lit(i)) for i in range(len(steps[0]))), F.lit(0.0))
        return F.greatest(F.lit(least), rate - along)

    return F.aggregate(history, F.lit(start), move)


def rates(docs: DataFrame, labelled: DataFrame, labels: DataFrame, mixing: Mixing = Mixing()) -> DataFrame:
    """Adds ``rate`` to the rows of ``posteriors``; ``labelled`` holds the texts of the labelled rows.

    Each step brings one row to the driver, the expected tokens of each domain.
    """
    model, priors = classifier(labelled, labels, mixing)
    soft = written(posteriors(docs, model, priors, mixing))
    k = range(len(priors))
    weight = F.col("n_rows") * F.col("n_tokens")
    mass = lambda rate: F.array(*[F.coalesce(F.sum(weight * F.get("p", F.lit(i)) * rate), F.lit(0.0)) for i in k])
    given = soft.agg(mass(F.lit(1.0))).first()[0]
    total = sum(given)
    if not total:
        return soft.withColumn("rate", F.lit(1.0))
    share = [g / total for g in given]
    budget, least = mixing.budget, 0.0
    if budget is None:
        least = 1.0
        budget = max(s / w for s, w in zip(share, mixing.weights, strict=True) if w > 0)
    targets = [budget * w for w in mixing.weights]
    steps: list[list[float]] = []
    before = None
    while True:
        got = [x / total for x in soft.agg(mass(_rate(budget, steps, least))).first()[0]]
        apart = lambda other: max(abs(x - y) for x, y in zip(got, other, strict=True)) / budget  # noqa: B023, E731
        if apart(targets) <= mixing.tolerance:
            break
        if before and apart(before) <= mixing.tolerance / 100:
            warnings.warn(f"nearest to the targets {targets} of {mixing.domains} is {got}", stacklevel=2)
            break
        if len(steps) == mixing.steps:
            raise ValueError(f"targets {targets} of {mixing.domains}: still moving after {mixing.steps} steps, at {got}")
        before = got
        steps.append([(g - t) / s if s > 0 else 0.0 for g, t, s in zip(got, targets, share, strict=True)])
    return soft.withColumn("rate", _rate(budget, steps, least))


def draw(docs: DataFrame, rated: DataFrame) -> DataFrame:
    """``docs`` in the mix: each row as often as its rate says, the fraction by a hash of its key. All its columns stay."""
    docs, restore = aside(docs, "_key", "_id", "_of", "_rate", "_copies", "_copy")
    keyed = docs.withColumn("_key", F.xxhash64(text_or_empty()))
    rate = rated.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_of"), F.col("rate").alias("_rate"))
    joined = keyed.join(rate, keyed["doc_id"].eqNullSafe(rate["_id"]) & (keyed["_key"] == rate["_of"]))
    chance = F.pmod(F.xxhash64("doc_id", "_key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = (F.floor("_rate") + (chance < F.col("_rate") - F.floor("_rate")).cast("int")).cast("int")
    times = joined.withColumn("_copies", copies).filter("_copies > 0")
    repeated = times.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return restore(repeated.select(*[F.col(c) for c in docs.columns]))
