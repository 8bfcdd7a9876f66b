"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text is read once, for a narrow table of statistics. The class means and covariances are sums
over all training rows, added up by Spark. Each class covariance is shrunk towards the pooled one and
that one towards its diagonal. The score is the difference of the class log densities, both read off
the Mahalanobis distance with Cholesky factors that are computed once and sent with the task, then
calibrated by logistic regression on binned differences of the training rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log, log1p

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import held_out, map_lists
from feedlake.session import landed

FEATURES = (
    "words", "word_length", "symbols", "exclamations", "capitals", "digits", "bars", "stops",
    "distinct", "top_word", "repeated_pairs", "stutter", "duplicate_lines", "lines", "entropy", "wide",
)
#: Weight of the pooled covariance in each class covariance, and of the diagonal in the pooled one.
CLASS_SHRINKAGE = 0.2
DIAGONAL_SHRINKAGE = 0.05
#: Bins of the calibration: log-density differences are clipped to this range and rounded to this step.
CLIP, STEP = 60.0, 0.25
DECISION = 0.3

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; a null text counts as empty."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, size = len(words), len(data)
    chars = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = lambda k, of: log(1e-3 + k / of) if of else log(1e-3)
    counts = Counter(words)
    pairs = list(zip(words, words[1:]))
    p = chars[chars > 0] / size if size else np.ones(1)
    return [
        log1p(n),
        log1p((size - int(chars[32] + chars[9:14].sum())) / n) if n else 0.0,
        share(int(chars[_SYMBOLS].sum()), size),
        share(int(chars[33]), size),
        share(int(chars[65:91].sum()), size),
        share(int(chars[48:58].sum()), size),
        share(int(chars[124]), size),
        share(int(chars[46] + chars[44]), size),
        share(len(counts), n),
        share(max(counts.values(), default=0), n),
        share(len(pairs) - len(set(pairs)), len(pairs)),
        share(sum(a == b for a, b in pairs), len(pairs)),
        share(len(lines) - len(set(lines)), len(lines)),
        share(len(lines), n),
        float(-(p * np.log(p)).sum()),
        share(int(chars[128:].sum()), size),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics, one row per document."""

    def make():
        return lambda rows: {"doc_id": rows["doc_id"], "x": [statistics(text) for text in rows["text"]]}

    return map_lists(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class means and inverse Cholesky factors with their log determinants, priors, and the calibration line."""

    means: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0, row by row."""
        density = []
        for mean, factor, log_det in zip(self.means, self.whiten, self.log_dets):
            z = (x - mean) @ factor.T
            density.append(-0.5 * (np.einsum("ij,ij->i", z, z) + log_det))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        line = self.slope * np.clip(self.difference(x), -CLIP, CLIP) + self.offset
        return 1 / (1 + np.exp(-line))


@dataclass(frozen=True)
class Constant:
    """Stands in where the training rows lack one of the classes: the smoothed share of class 1."""

    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def _moments(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products per class, added up where the rows are; two rows reach the driver."""
    d = len(FEATURES)
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(F.col("x")[i]) for i in range(d)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in upper]
    out = {}
    for row in rows.groupBy("label").agg(F.count("*"), F.array(*sums), F.array(*products)).collect():
        square = np.zeros((d, d))
        for (i, j), value in zip(upper, row[3]):
            square[i, j] = square[j, i] = value
        out[int(row[0])] = (row[1], np.array(row[2]), square)
    return out


def _discriminant(moments) -> Discriminant:
    means, covs, counts = [], [], []
    for k in (0, 1):
        n, total, square = moments[k]
        mean = total / n
        means.append(mean)
        counts.append(n)
        covs.append(square / n - np.outer(mean, mean))
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / sum(counts)
    pooled = (1 - DIAGONAL_SHRINKAGE) * pooled + DIAGONAL_SHRINKAGE * np.diag(np.diag(pooled)) + 1e-3 * np.eye(len(pooled))
    whiten, log_dets = [], []
    for n, cov in zip(counts, covs):
        weight = CLASS_SHRINKAGE + (1 - CLASS_SHRINKAGE) * len(pooled) / (n + len(pooled))  # few rows lean on the pool
        factor = np.linalg.cholesky((1 - weight) * cov + weight * pooled)
        whiten.append(np.linalg.inv(factor))
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Discriminant(tuple(means), tuple(whiten), tuple(log_dets))


def _calibrated(model: Discriminant, bins: list[tuple[float, int, int]]) -> Discriminant:
    """Slope and offset by Newton steps of a ridge logistic regression over (difference, label, count)."""
    x, y, n = (np.array(v, float) for v in zip(*bins))
    theta = np.array([0.1, 0.0])
    design = np.column_stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (n * (y - p)) - 1e-2 * theta
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta += step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return Discriminant(model.means, model.whiten, model.log_dets, float(max(theta[0], 1e-3)), float(theta[1]))


def _differences(rows: DataFrame, model: Discriminant) -> DataFrame:
    def make():
        def step(batch):
            d = np.clip(model.difference(np.array(batch["x"], float)), -CLIP, CLIP)
            return {"bin": np.round(d / STEP).astype(int).tolist(), "label": batch["label"]}

        return step

    return map_lists(rows.select("x", "label"), make, "bin int, label int").groupBy("bin", "label").count()


def fit_quality(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant | Constant:
    """Fit on all labelled rows of ``stats`` that are not held out. Ids with both labels are left out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"), F.max(label).alias("_high")).where("label = _high")
    rows = landed(stats.sparkSession, stats.join(known.select("doc_id", "label"), "doc_id"), "quality-training")
    moments = _moments(rows)
    n = [moments[k][0] if k in moments else 0 for k in (0, 1)]
    if min(n) < 2:
        return Constant((n[1] + 1) / (sum(n) + 2))
    model = _discriminant(moments)
    bins = [(r["bin"] * STEP, r["label"], r["count"]) for r in _differences(rows, model).collect()]
    return _calibrated(model, bins)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null texts count as empty and are scored like any text; rows with a null or repeated doc_id keep their own row
    (a null id hashes as empty text); other columns are not read. An empty table gives an empty result; without labels of both
    classes every score is the smoothed share of label 1.
    """
    stats = landed(docs.sparkSession, document_statistics(docs), "quality-statistics")
    model = fit_quality(stats, labels)

    def make():
        def step(rows):
            return {"doc_id": rows["doc_id"], "score": model.score(np.array(rows["x"], float)).tolist()}

        return step

    scored = map_lists(stats, make, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= DECISION).cast("int").alias("predicted"))
