"""Toxicity: a factorization machine over hashed terms.

The score of a text is a bias, a weight per term, and a learned interaction of every pair of its
terms, computed from short factor vectors in time linear in the terms. Terms are lower-cased words
and word beginnings, hashed, chosen by the number of their texts only, so that terms which count only
together take part; each text is scaled to length 1. The machine is fitted on a bounded sample of labelled rows, in the order of a hash of their ids, so any partitioning gives the same machine. A part
of the sample is kept back at first: it says after which epoch to stop and where the cut between the classes lies. Scoring is one
narrow pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from math import log, sqrt
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import held_out, map_lists, training_ids

#: Labelled rows per class that are learnt from, at most.
TRAINING_ROWS = 4000
HASH_BITS = 22
#: Terms that enter the machine are in so many training texts at least.
MIN_TEXTS = 3
FACTORS, EPOCHS, RATE, RIDGE = 4, 12, 0.1, 2e-3
DECISION = 0.5
#: One of so many training rows is kept back to stop by and to find the cut.
KEPT_BACK = 4
#: Learning stops after so many epochs that separate them no better.
PATIENCE = 2
#: Words whose terms a task remembers at once.
CACHE_WORDS = 200_000

_STRIP = ".,;:!?()[]{}<>\"'`*#$%&|-_=+/\\~^@"
_BEGINNINGS = (4, 5, 6)


def terms_of(word: str) -> tuple[int, ...]:
    """Hashes of a raw word and of its beginnings; none for punctuation."""
    word = word.strip(_STRIP)
    if not word:
        return ()
    mask = (1 << HASH_BITS) - 1
    own = [crc32(b"w" + word.encode("utf-8", "replace")) & mask]
    return tuple(own + [crc32(b"p" + word[:k].encode("utf-8", "replace")) & mask for k in _BEGINNINGS if len(word) >= k])


class TermCache(dict):
    """Raw word -> those of its terms that ``known`` holds (all terms without it); emptied when it is full."""

    def __init__(self, known: dict[int, int] | None = None):
        self.known = known

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        terms = terms_of(word)
        if self.known is not None:
            terms = tuple(self.known[t] for t in terms if t in self.known)
        self[word] = terms
        return terms

    def terms(self, text: str | None) -> list[int]:
        """The distinct terms of a whole text."""
        found: set[int] = set()
        for word in set((text or "").lower().split()):
            found.update(self[word])
        return sorted(found)


def _share(at) -> float:
    """The value of each term of a text: its terms have length 1 together, so long texts do not drown in pairs."""
    return 1 / sqrt(max(len(at), 1))


@dataclass(frozen=True)
class Machine:
    """Bias, weight and factors per known term."""

    known: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, at) -> float:
        if not len(at):
            return self.bias
        v = self.factors[at] * _share(at)
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return self.bias + float(self.weights[at].sum()) * _share(at) + pairs

    def score(self, at: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(at), -30, 30))))


def _chosen(samples: list[np.ndarray]) -> dict[int, int]:
    """The terms of at least MIN_TEXTS texts; which of them count, alone or in pairs, the machine learns."""
    if not samples:
        return {}
    seen = np.zeros(1 << HASH_BITS, np.int32)
    for at in samples:
        seen[at] += 1
    return {int(t): k for k, t in enumerate(np.flatnonzero(seen >= MIN_TEXTS))}


def _epochs(known: dict[int, int], rows: list[np.ndarray], labels: np.ndarray) -> Iterator[Machine]:
    """Adaptive gradient steps on the logistic loss: the machine after each epoch, its arrays still in use."""
    rng = np.random.default_rng(7)
    n = len(known)
    w, v = np.zeros(n), rng.normal(0, 0.05, (n, FACTORS))
    gw, gv, gb = np.full(n, 1e-2), np.full((n, FACTORS), 1e-2), 1e-2
    ones = float(labels.mean())
    bias = log(ones / (1 - ones))
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at = rows[k]
            x = _share(at)
            own = x * v[at]
            total = own.sum(axis=0)
            out = bias + x * w[at].sum() + 0.5 * float((total**2 - (own**2).sum(axis=0)).sum())
            error = 1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels[k]
            gb += error * error
            bias -= RATE * error / np.sqrt(gb)
            if len(at):
                dw = error * x + RIDGE * w[at]
                dv = error * x * (total - own) + RIDGE * v[at]
                gw[at] += dw * dw
                gv[at] += dv * dv
                w[at] -= RATE * dw / np.sqrt(gw[at])
                v[at] -= RATE * dv / np.sqrt(gv[at])
        yield Machine(known, bias, w, v)


def train(samples: list[np.ndarray], labels: np.ndarray, rate_of_ones: float) -> Machine:
    """A machine learnt from all rows, for as many epochs as separate rows that were kept back at first best.

    The bias is moved so that a score of DECISION is where the kept-back rows, weighted to the true rate of label 1, have the
    largest F1. Without kept-back rows of both classes it is moved to the true rate after the last epoch.
    """
    known = _chosen(samples)
    rows = [np.array(sorted(known[t] for t in at.tolist() if t in known), int) for at in samples]
    back = np.zeros(len(rows), bool)
    for k in (0, 1):
        back[np.flatnonzero(labels == k)[KEPT_BACK - 1 :: KEPT_BACK]] = True
    ones = float(labels.mean())
    epochs, move = EPOCHS, log(rate_of_ones / (1 - rate_of_ones)) - log(ones / (1 - ones))
    if labels[back].any() and (labels[back] == 0).any():
        least = -1.0
        learnt, kept = np.flatnonzero(~back), np.flatnonzero(back)
        for number, machine in enumerate(_epochs(known, [rows[k] for k in learnt], labels[learnt]), 1):
            raw = np.array([machine.raw(rows[k]) for k in kept])
            area = _area(raw, labels[kept])
            if area > least:
                least, epochs, move = area, number, -_cut(raw, labels[kept], rate_of_ones)
            elif number >= epochs + PATIENCE:
                break
    machine = next(islice(_epochs(known, rows, labels), epochs - 1, None))
    return Machine(known, machine.bias + move, machine.weights, machine.factors)


def _area(raw: np.ndarray, labels: np.ndarray) -> float:
    """The share of pairs of either class that are in order; ties count half."""
    values, at, times = np.unique(raw, return_inverse=True, return_counts=True)
    rank = (np.cumsum(times) - (times - 1) / 2)[at]
    ones = int(labels.sum())
    return float((rank[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones)))


def _cut(raw: np.ndarray, labels: np.ndarray, rate_of_ones: float) -> float:
    """The raw score from which on label 1 is said, midway between two rows, with the largest F1 at the true rate."""
    order = np.argsort(-raw, kind="stable")
    weight = np.where(labels == 1, rate_of_ones / labels.mean(), (1 - rate_of_ones) / (1 - labels.mean()))[order]
    right = np.cumsum(weight * (labels[order] == 1))
    f1 = 2 * right / (np.cumsum(weight) + right[-1])
    raw = raw[order]
    last = np.append(raw[:-1] > raw[1:], True)  # a cut never parts rows of one score
    k = int(np.argmax(np.where(last, f1, -1)))
    return float((raw[k] + raw[k + 1]) / 2 if k + 1 < len(raw) else raw[k] - 1)


def _all_terms(docs: DataFrame) -> DataFrame:
    def make():
        cache = TermCache()
        return lambda rows: {"doc_id": rows["doc_id"], "label": rows["label"], "terms": [cache.terms(text) for text in rows["text"]]}

    return map_lists(docs.select("doc_id", "label", "text"), make, "doc_id long, label int, terms array<int>")


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Machine:
    """Fit on up to TRAINING_ROWS labelled rows of either class that are not held out; of several texts of one id the smallest counts.

    Without rows of both classes the machine has no terms and scores the smoothed share of label 1.
    """
    chosen = training_ids(labels, label, TRAINING_ROWS)
    # At most 2 * TRAINING_ROWS ids: a proven bound for the broadcast.
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    rows = sorted(_all_terms(rows).collect(), key=lambda row: (crc32(b"order %d" % row["doc_id"]), row["doc_id"]))
    found = [(row["label"], np.array(row["terms"], np.int64)) for row in rows]
    counts = {r["label"]: r["count"] for r in labels.where(~held_out()).groupBy(F.col(label).alias("label")).count().collect()}
    share = (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
    y = np.array([a for a, _ in found], int)
    if not len(y) or y.min() == y.max():
        return Machine({}, log(share / (1 - share)), np.zeros(0), np.zeros((0, FACTORS)))
    return train([b for _, b in found], y, share)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null texts count as empty and score the bias; rows with a null or repeated doc_id keep their own row; other columns
    are not read; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    machine = fit_toxicity(docs, labels)

    def make():
        cache = TermCache(machine.known)
        return lambda rows: {"doc_id": rows["doc_id"], "score": [machine.score(cache.terms(text)) for text in rows["text"]]}

    scored = map_lists(docs, make, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= DECISION).cast("int").alias("predicted"))
