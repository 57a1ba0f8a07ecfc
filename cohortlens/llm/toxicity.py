"""Toxicity by a gap-weighted subsequence kernel and a support vector machine.

The kernel of two strings counts the triples of letters that they share in order;
up to ``GAP`` letters may stand between two letters of a triple, each at a cost.
So an insult with inserted characters, a changed letter or another ending stays
near the plain one. Letters are folded: case, accents and digits that stand for
letters do not matter, and a run of single letters, with blanks or
signs between them, counts as one word.

A Nyström map over landmark words turns the kernel into a short feature vector, on
which a linear machine with squared hinge loss is fitted. As map and machine are
linear in the triples, the fitted model is one weight per triple, and scoring a
text is a table lookup per position. Kernel and machine work on single words, not on
sentences as the dealt method does: no triple runs over a word gap, and the decision
value of a text is that of its highest word. So an insult of several harmless words,
negation and the number of insults have no effect. A logistic curve turns the value
into a score.

Words are taken to carry their document's label. In a toxic document most are
harmless, so the fit goes in rounds, seeded by the pieces whose document counts are the
strongest evidence (log-likelihood ratio): the words that score highest in each
toxic document are positive examples, words of clean documents are negative, the hardest
first; the positive ones enter with disguised variants too. The sample is bounded by ``Fit.toxic`` and ``Fit.clean`` documents, chosen by
a hash of their ids.

Defined results: a NULL or empty text scores as a text without any triple; long
texts are read whole; rows are independent; without labels of both classes every
text scores 0; repeated or conflicting labels of a document count as they stand.
"""

from __future__ import annotations

import heapq
import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import aside, slices, text_or_empty

GAP, DECAY = 2, 0.6
PATTERNS = [(a, b, DECAY ** (a + b - 2)) for a in range(1, GAP + 2) for b in range(1, GAP + 2)]
TRIPLES = 1 << 15
REACH = 2 * (GAP + 1)
_BEGIN = 30
LIMIT = 4.0
# Signed root of the log-likelihood ratio from which a word of both classes counts as a toxic one.
SURE = 2.0
# Digits read as letters.
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_SPELLED = re.compile(r"(?<!\w)(?:\w[\x20.*_-]){2,}\w(?!\w)")
_JOINS = str.maketrans("", "", " .*_-")


def _code(point: int) -> int:
    """0 between words, 1-26 letters, 27 digits, 28 other signs, 29 other letters, 30 a word's begin."""
    char = chr(point)
    if char == "\x01":
        return _BEGIN
    if char == " ":
        return 0
    base = unicodedata.normalize("NFKD", _LOOKALIKE.get(char, char).casefold())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 if base.isdigit() else 29 if base.isalpha() else 28


CODES = np.array([_code(p) for p in range(0x250)] + [29], np.int32)


def letters(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts in a row, and where each text begins.

    Words are set apart by more blanks than a triple can span.
    """
    blank = " " * (GAP + 1)
    made = []
    for text in texts:
        joined = _SPELLED.sub(lambda m: m[0].translate(_JOINS), text)
        made.append(blank + "\x01" + _SPACES.sub(blank + "\x01", joined.replace("\x01", "\x02").strip(" \t\n\x0b\x0c\r")) if joined else "")
    sizes = [len(m) for m in made]
    points = np.frombuffer("".join([*made, " " * REACH]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return CODES[np.minimum(points, 0x250)], np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64)


def triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each gap pattern the triple that begins at each position, and its weight."""
    size = len(codes) - REACH
    first, second = codes << 10, codes << 5
    for a, b, weight in PATTERNS:
        yield first[:size] | second[a : size + a] | codes[a + b : size + a + b], weight


def decisions(texts: Sequence[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """The decision value of each text's highest word; that of no word is the bias."""
    codes, starts = letters(texts)
    values = np.zeros(max(len(codes) - REACH, 0), np.float32)
    for index, weight in triples(codes):
        values += weights[index] * np.float32(weight)
    words = np.flatnonzero(codes[: len(values)] == _BEGIN)
    out = np.full(len(texts), bias)
    if len(words):
        sums = np.add.reduceat(values, words)
        owner = np.searchsorted(starts, words, side="right") - 1
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[first]] = np.maximum.reduceat(sums, first) + bias
    return out


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of a fit."""

    toxic: int = 1000
    clean: int = 2500
    landmarks: int = 192
    negatives: int = 8000
    rounds: int = 4
    likely: int = 12
    others: int = 40
    cost: float = 10.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        z = self.slope * np.clip(decisions(texts, self.weights, self.bias), -LIMIT, LIMIT) + self.offset
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-z))


class _Words:
    """Kernel features of a list of words, as entries sorted by word."""

    def __init__(self, words: list[str]):
        codes, starts = letters(words)
        owner = np.searchsorted(starts, np.arange(len(codes) - REACH), side="right") - 1
        parts = []
        for index, weight in triples(codes):
            real = (index >> 10 > 0) & (index >> 5 & 31 > 0) & (index & 31 > 0)
            parts.append((owner[real], index[real], np.full(real.sum(), weight, np.float32)))
        word, self.index, self.weight = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(word, kind="stable")
        self.word, self.index, self.weight = word[order], self.index[order], self.weight[order]
        self.size = len(words)

    def dense(self, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros((len(chosen), TRIPLES), np.float32)
        for row, word in enumerate(chosen):
            lo, hi = np.searchsorted(self.word, (word, word + 1))
            np.add.at(out[row], self.index[lo:hi], self.weight[lo:hi])
        return out

    def kernel(self, chosen: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
        """Kernel values of the chosen words with the landmarks (dense features)."""
        columns = np.ascontiguousarray(landmarks.T)
        lo, hi = np.searchsorted(self.word, chosen), np.searchsorted(self.word, chosen + 1)
        out = np.zeros((len(chosen), landmarks.shape[0]), np.float32)
        for row, (a, b) in enumerate(zip(lo, hi, strict=True)):
            if b > a:
                out[row] = self.weight[a:b] @ columns[self.index[a:b]]
        return out


def _machine(z: np.ndarray, y: np.ndarray, share: np.ndarray, cost: float) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.hstack([z, np.ones((len(z), 1))]).astype(np.float64)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        xa = x[active] * share[active, None]
        new = np.linalg.solve(ridge + cost * xa.T @ x[active], cost * xa.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def _logistic(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt's smoothed logistic fit, by damped Newton steps."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([f, np.ones(len(f))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + 1e-6 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _disguised(word: str, chance: np.random.Generator) -> list[str]:
    """The word with signs between its letters, with a letter inserted, with one doubled."""
    at = int(chance.integers(1, max(len(word), 2)))
    other = chr(97 + int(chance.integers(26)))
    return [".-*_"[chance.integers(4)].join(word), word[:at] + other + word[at:], word[:at] + word[at - 1 :]]


def _grams(word: str) -> set[str]:
    marked = "^" + word
    return {marked[i : i + 4] for i in range(max(1, len(marked) - 3))}


def _evidence(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Signed root of the log-likelihood ratio for a piece in so many documents: a piece seen once gives little."""
    share = (toxic + clean) / (n_toxic + n_clean)
    ratio = 0.0
    for n, size in ((toxic, n_toxic), (clean, n_clean)):
        for count, expected in ((n, size * share), (size - n, size * (1 - share))):
            if count:
                ratio += count * math.log(count / expected)
    return math.copysign(math.sqrt(max(2 * ratio, 0.0)), toxic * n_clean - clean * n_toxic)


def _round(
    words: list[str], bags: list[np.ndarray], labels: np.ndarray, score: np.ndarray, told: np.ndarray, first: bool, settings: Fit, chance
) -> tuple[np.ndarray, float]:
    """One fit on the words that the scores so far suggest: weights of the triples, bias."""
    features = _Words(words)
    none = np.zeros(0, np.int64)
    clean = np.unique(np.concatenate([none, *[b for b, t in zip(bags, labels, strict=True) if not t]]))
    toxic = [b for b, t in zip(bags, labels, strict=True) if t and len(b)]
    # At first the words near a document's best guess, then those the machine takes for positive.
    least = [score[b].max() - 1 if first else min(score[b].max(), 0.5) for b in toxic]
    found = np.concatenate([none, *[b[score[b] >= m] for b, m in zip(toxic, least, strict=True)]])
    positive, times = np.unique(found, return_counts=True)
    # A word that clean documents hold too is positive only if it is far commoner in toxic ones.
    keep = told[positive] | ~np.isin(positive, clean)
    if keep.any():
        positive, times = positive[keep], times[keep]
    clean = np.setdiff1d(clean, positive[told[positive]])
    hard = clean[np.argsort(-score[clean], kind="stable")[: settings.negatives // 2]]
    rest = chance.permutation(clean)[: settings.negatives // 2]
    negative = np.union1d(hard, rest)
    # Landmarks: the commonest positive words, one of each of some documents, hard and other clean words.
    quarter = settings.landmarks // 4
    top = positive[np.argsort(-times, kind="stable")[:quarter]]
    best = np.array([b[np.argmax(score[b])] for b in toxic], np.int64)
    marks = np.unique(np.concatenate([top, chance.permutation(best)[:quarter], hard[:quarter], rest[:quarter]]))
    phi = features.dense(marks)
    values, vectors = np.linalg.eigh((phi @ phi.T).astype(np.float64))
    good = values > values.max() * 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    disguised = [v for i in positive for v in _disguised(words[i], chance)]
    kernels = [features.kernel(np.concatenate([positive, negative]), phi)]
    kernels.append(_Words(disguised).kernel(np.arange(len(disguised)), phi))
    z = np.concatenate(kernels) @ root
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative)), np.ones(len(disguised))])
    plain = times / times.sum()
    share = np.concatenate([plain, np.full(len(negative), 1 / max(len(negative), 1)), np.repeat(plain, 3) / 6])
    fitted = _machine(z, y, share * len(y) / 2, settings.cost)
    weights = (phi.T @ (root @ fitted[:-1])).astype(np.float32)
    index = np.arange(TRIPLES)
    weights[(index >> 10 == 0) | (index >> 5 & 31 == 0) | (index & 31 == 0)] = 0
    return weights, float(fitted[-1])


def fit_sample(texts: Sequence[str], toxic: Sequence[int], settings: Fit = Fit()) -> Model:
    """Fits on labelled texts in memory."""
    labels = np.asarray(toxic, bool)
    if labels.all() or not labels.any():
        return Model(np.zeros(TRIPLES, np.float32), 0.0, 0.0, -np.inf)
    whole = [sorted({sys.intern(w.strip(".,;:!?\"'()").lower()) for w in _SPACES.split(t)} - {""}) for t in texts]
    # First guess: the four-letter pieces that tell toxic documents best, by the evidence they give and not by their odds alone.
    seen = [Counter(), Counter()]
    for bag, label in zip(whole, labels, strict=True):
        seen[int(label)].update(set().union(*map(_grams, bag)))
    n_clean, n_toxic = int((~labels).sum()), int(labels.sum())
    worth = {g: _evidence(n, seen[0][g], n_toxic, n_clean) for g, n in seen[1].items()}
    guess = lambda w: max(worth.get(g, -9.0) for g in _grams(w))
    held = [Counter(), Counter()]
    for bag, label in zip(whole, labels, strict=True):
        held[int(label)].update(bag)
    tells = lambda w: held[1][w] > 1 and _evidence(held[1][w], held[0][w], n_toxic, n_clean) > SURE
    chance = np.random.default_rng(settings.seed)
    # Some words stand for a document: its likeliest, a few others, and later those that score highest.
    chosen = []
    for bag in whole:
        others = chance.choice(len(bag), min(len(bag), settings.others), replace=False) if bag else ()
        chosen.append({*heapq.nlargest(settings.likely, bag, key=guess), *[bag[k] for k in others]})
    weights, bias = np.zeros(TRIPLES, np.float32), 0.0
    for turn in range(settings.rounds):
        if turn:
            for bag, own in zip(whole, chosen, strict=True):
                own.update(bag[k] for k in np.argsort(-decisions(bag, weights, bias), kind="stable")[:3])
        words = sorted(set().union(*chosen))
        at = {w: i for i, w in enumerate(words)}
        score = decisions(words, weights, bias) if turn else np.array([guess(w) for w in words])
        bags = [np.array(sorted(at[w] for w in own), np.int64) for own in chosen]
        told = np.array([tells(w) for w in words], bool)
        weights, bias = _round(words, bags, labels, score, told, turn == 0, settings, chance)
    best = np.array([decisions([t], weights, bias)[0] for t in texts])
    slope, offset = _logistic(np.clip(best, -LIMIT, LIMIT), labels.astype(float))
    return Model(weights, bias, slope, offset)


def sample(docs: DataFrame, labels: DataFrame, settings: Fit = Fit()) -> list:
    """The bounded training sample: ids are chosen first, then only their texts are read."""
    order = F.xxhash64(F.col("doc_id"), F.lit(settings.seed))
    ids = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL")

    def some(label: int, n: int) -> DataFrame:
        return ids.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(n)

    chosen = some(1, settings.toxic).unionByName(some(0, settings.clean))
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[2], r[1]))


def fit(docs: DataFrame, labels: DataFrame, settings: Fit = Fit()) -> Model:
    """Fits on a bounded sample of the labelled documents."""
    rows = sample(docs, labels, settings)
    return fit_sample([r[1] for r in rows], [r[2] for r in rows], settings)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels no fit may see."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``, which replace columns of these names; all others stay."""
    from pyspark.sql import types as T

    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs, restore = aside(docs.drop("score"), "_text")
    docs = docs.withColumn("_text", text_or_empty())
    schema = T.StructType([f for f in docs.schema if f.name != "_text"] + [T.StructField("score", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, "_text", 1_000_000):
            yield frame.drop(columns="_text").assign(score=shared.value.scores(list(frame["_text"])))

    return restore(docs.mapInPandas(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
