"""Toxicity: non-negative positive-unlabelled learning.

A linear classifier in numpy is trained from confirmed toxic documents (P) and
unlabelled text (U: any document, toxic ones among them). With the class prior
``pi`` the risk of calling text clean is estimated as the risk on U minus ``pi``
times the risk on P; where that estimate turns negative, the step is taken
against it (the non-negative estimator), so that the model can't learn to call
its own training examples clean.

Features of a document are its distinct words and their prefixes of
``PREFIXES`` letters, hashed to ``2**FEATURE_BITS`` places. For each, the rate
in clean text follows from the rates in U and P and the class prior (what is left
of U without ``pi`` times P, not below zero); features that are significantly more
frequent in P are kept, scaled by their log ratio, and the risk is minimised
over their weights. A word's features are remembered, so scoring looks each
word up once.

Training uses a sample, bounded by ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
documents of at most ``MAX_CHARS`` characters, taken by hash of doc_id from rows
that aren't held out; features are made on the executors. The class prior is the
share of toxic ids among all labelled documents that aren't held out (and not over-long), in the sample or not;
labels of other ids, as in a label table shared by several corpora, change nothing. Of near copies in P or U
one is used. Scoring covers every whole text, in Arrow batches.

Defined results: an empty or null text has the score of the bias alone; rows
are scored one by one, so repeated rows agree; a null doc_id is not held out and
has no label; without toxic examples or unlabelled text every score is 0; an empty table gives an
empty result. Labels, lang, source and doc_id are never part of a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import prepare, text_of, written

FEATURE_BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
#: A feature is kept if clean text would give its toxic documents by chance with probability exp(-EVIDENCE) at most.
EVIDENCE = 18.0
MAX_POSITIVE, MAX_UNLABELLED, MAX_CHARS = 3000, 9000, 100_000
STEPS, RATE, DECAY, BACK = 200, 0.02, 1e-3, 0.1
#: A clean document called toxic counts as much as so many toxic ones missed when the cut is set.
FALSE_ALARM = 2.0
#: A document is predicted toxic from this score on.
CUT = 0.7
#: Folds of doc_id; this one is never trained on.
FOLDS, HELD_FOLD = 3, 1
CACHE_WORDS = 300_000

_WORDS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Hashed features of one word: itself and its prefixes."""
    found = [f"{word}$"] + [word[:n] for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) >> (32 - FEATURE_BITS) for f in found]


class Words:
    """Distinct words of texts, with something remembered for each word."""

    def __init__(self, make):
        self._make, self._known = make, {}

    def of(self, text: str) -> list:
        words = set(_WORDS.findall(text.lower()))
        if len(self._known) > CACHE_WORDS:
            self._known.clear()
        known, out = self._known, []
        for w in words:
            value = known.get(w)
            if value is None:
                value = known[w] = self._make(w)
            out.append(value)
        return out


def _features(words: Words, text: str) -> np.ndarray:
    """Sorted distinct features of a text."""
    return np.unique(np.array([i for found in words.of(text) for i in found], dtype=np.int32))


class Examples:
    """Documents as flat arrays of distinct features."""

    def __init__(self, rows: list[np.ndarray]):
        self.flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
        self.sizes = np.array([len(r) for r in rows], dtype=np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    def only(self, kept: np.ndarray) -> Examples:
        """These documents with the features ``kept`` (sorted), numbered by their place there."""
        place = np.minimum(np.searchsorted(kept, self.flat), max(0, len(kept) - 1))
        hit = kept[place] == self.flat if len(kept) else np.zeros(len(self.flat), dtype=bool)
        out = Examples([])
        out.flat = place[hit]
        out.sizes = np.bincount(np.repeat(np.arange(len(self)), self.sizes)[hit], minlength=len(self))
        return out

    def batch(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of some documents, and the position in ``docs`` of each."""
        ends = np.cumsum(self.sizes)
        sizes = self.sizes[docs]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return (self.flat[np.repeat(ends[docs] - sizes, sizes) + within], np.repeat(np.arange(len(docs)), sizes))


def without_copies(rows: list[np.ndarray]) -> list[int]:
    """The first of each group of rows with the same four smallest hashed features: copies would count as evidence."""
    first: dict[tuple, int] = {}
    for i, row in enumerate(rows):
        mixed = np.sort((row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))[:4]
        first.setdefault(tuple(mixed.tolist()), i)
    return list(first.values())


class Model:
    """Bias, and weights of the kept features (sorted)."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, bias: float):
        self.kept, self.weights, self.bias = kept, weights, bias
        self._weight = dict(zip(kept.tolist(), weights.tolist()))

    def word(self, word: str) -> list[int]:
        return [f for f in word_features(word) if f in self._weight]

    def score(self, texts: list[str], words: Words) -> np.ndarray:
        """Scores (0 to 1) of texts; ``words`` remembers :meth:`word`."""
        found = [sorted({f for fs in words.of(t) for f in fs}) for t in texts]
        return _sigmoid(np.array([self.bias + sum(self._weight[f] for f in fs) for fs in found]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def kept_features(positive: Examples, unlabelled: Examples, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Features significantly more frequent in toxic than in clean text, and their log ratios."""
    size = 1 << FEATURE_BITS
    k = np.bincount(positive.flat, minlength=size).astype(float)
    u = np.bincount(unlabelled.flat, minlength=size).astype(float)
    n_p, n_u = len(positive), len(unlabelled)
    clean = np.maximum(0.0, u / n_u - prior * k / n_p) / (1 - prior)  # the class-prior correction
    expected = n_p * (clean + 1 / n_u)
    more = np.flatnonzero(k > expected)
    chance = k[more] * np.log(k[more] / expected[more]) - (k[more] - expected[more])  # Chernoff bound of a Poisson tail
    kept = more[chance >= EVIDENCE]
    ratio = np.log((k[kept] + 1) / (n_p + 2)) - np.log((clean[kept] * n_u * (1 - prior) + 1) / (n_u * (1 - prior) + 2))
    return kept, np.maximum(ratio, 0.0)


def best_cut(g_p: np.ndarray, g_u: np.ndarray, prior: float) -> float:
    """The output above which calling a text toxic makes fewest errors, estimated from P, U and the prior.

    Of U, ``prior`` times the share of P above the cut is toxic; what is above it besides is clean text.
    """
    cuts = np.unique(np.concatenate((g_p, g_u)))
    cuts = np.append((cuts[1:] + cuts[:-1]) / 2, cuts[-1] + 1.0)
    hit = 1 - np.searchsorted(np.sort(g_p), cuts) / len(g_p)
    called = 1 - np.searchsorted(np.sort(g_u), cuts) / len(g_u)
    errors = prior * (1 - hit) + FALSE_ALARM * np.maximum(0.0, called - prior * hit)
    best = cuts[errors <= errors.min() + 1e-12]
    return float(best[len(best) // 2])


def train(positive: Examples, unlabelled: Examples, prior: float) -> Model:
    """Adam on the non-negative risk with the logistic loss."""
    kept, ratio = kept_features(positive, unlabelled, prior)
    positive, unlabelled = positive.only(kept), unlabelled.only(kept)
    size = len(kept)
    w = np.append(np.ones(size), np.log(prior / (1 - prior)))  # the last is the bias
    x = np.append(ratio, 1.0)
    m, v = np.zeros(size + 1), np.zeros(size + 1)

    def outputs(ex: Examples, docs: np.ndarray):
        idx, owner = ex.batch(docs)
        return np.bincount(owner, weights=(w * x)[idx], minlength=len(docs)) + w[-1], (idx, owner)

    def gradient(parts, factor: np.ndarray) -> np.ndarray:
        idx, owner = parts
        g = np.bincount(idx, weights=factor[owner] * x[idx], minlength=size + 1).astype(float)  # empty input counts in int
        g[-1] += factor.sum()
        return g

    all_p, all_u = np.arange(len(positive)), np.arange(len(unlabelled))
    for step in range(1, STEPS + 1):
        gu, pu = outputs(unlabelled, all_u)
        gp, pp = outputs(positive, all_p)
        su, sp = _sigmoid(gu), _sigmoid(gp)
        clean = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        clean_gradient = gradient(pu, su / len(su)) - gradient(pp, prior * sp / len(sp))
        if clean >= 0:
            g = clean_gradient + gradient(pp, prior * (sp - 1) / len(sp))
        else:  # the estimate of a loss can't be negative: step back
            g = -BACK * clean_gradient
        g[:-1] += DECAY * (w[:-1] - 1.0)
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        np.maximum(w[:-1], 0.0, out=w[:-1])  # kept features speak for toxicity
    g_p, g_u = (outputs(ex, np.arange(len(ex)))[0] for ex in (positive, unlabelled))
    shift = np.log(CUT / (1 - CUT)) - best_cut(g_p, g_u, prior)
    return Model(kept, w[:-1] * ratio, float(w[-1] + shift))


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fold that is never trained on."""
    fold = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_FOLD, F.lit(False))


def _collected(texts: DataFrame) -> Examples:
    """A bounded sample's features, made on the executors; one of each group of copies."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(word_features)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"],
                                "packed": [zlib.compress(_features(words, t).tobytes(), 1) for t in pdf["text"]]})

    rows = texts.select("id", "text").mapInPandas(run, "id long, packed binary").collect()
    rows.sort(key=lambda r: (r["id"], bytes(r["packed"])))
    found = [np.frombuffer(zlib.decompress(r["packed"]), dtype=np.int32) for r in rows]
    return Examples([found[i] for i in without_copies(found)])


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from rows that aren't held out; None without toxic examples or unlabelled text."""
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), text_of(docs).alias("text"))
    texts = texts.filter(~held_out(F.col("id")) & (F.length("text") <= MAX_CHARS))
    marks = labels.select(labels["doc_id"].cast("long").alias("id"), labels["toxic"].cast("long").alias("toxic"))
    marks = written(marks.filter(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
                    .groupBy("id").agg(F.max("toxic").alias("toxic")).join(texts.select("id"), "id", "left_semi"), "marks")
    # samples by a hash of the id; what is broadcast has MAX_POSITIVE or MAX_UNLABELLED rows at most
    toxic_ids = marks.filter("toxic = 1").orderBy(F.xxhash64("id"), "id").limit(MAX_POSITIVE)
    positive = _collected(texts.join(F.broadcast(toxic_ids), "id"))
    share = min(1.0, 2.0 * MAX_UNLABELLED / max(1, docs.count()))
    some = docs.select(docs["doc_id"].cast("long").alias("id")).filter(
        F.col("id").isNotNull() & ~held_out(F.col("id"))
        & (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))))
    any_ids = some.distinct().orderBy(F.xxhash64("id", F.lit(6)), "id").limit(MAX_UNLABELLED)
    unlabelled = _collected(texts.join(F.broadcast(written(any_ids, "unlabelled")), "id"))
    if not len(positive) or not len(unlabelled):
        return None
    prior = marks.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    return train(positive, unlabelled, min(0.9, max(0.001, prior)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    prepare(spark)
    model = fit(docs, labels)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = spark.sparkContext.broadcast((model.kept, model.weights, model.bias))  # 2**FEATURE_BITS at most

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = Model(*shared.value)
            words = Words(own.word)
            for pdf in batches:
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": own.score(pdf["text"].tolist(), words)})

        scored = rows.mapInPandas(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
