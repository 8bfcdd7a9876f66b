"""Quality rules: a linear-chain conditional random field over the lines of a text.

Every line gets a few statistics; the field weighs them per state (content, boilerplate) and weighs
each step from one state to the next. Viterbi decoding finds the best labelling of the whole text,
and the share of its words that stand in content lines decides whether the text is kept. The
weights are fitted by maximum likelihood on the lines of a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import map_lists, map_whole, training_ids

#: Labelled documents per class whose lines the field is fitted on, at most; longer ones are cut into sequences of so many lines.
TRAINING_ROWS, SEQUENCE_LINES = 1500, 400
STEPS, RATE, RIDGE = 150, 0.3, 1e-3
#: A text is kept if content lines hold this share of its words.
CONTENT_SHARE = 0.5

LINE_FEATURES = 11
_SYMBOLS = "#*$%&|<>"


def line_statistics(lines: list[str]) -> np.ndarray:
    """One row per line that holds a word: a bias, length, word shape, symbols, capitals, repeats, ending."""
    seen: set[str] = set()
    out = []
    for line in lines:
        words = line.split()
        n, size = len(words), max(len(line), 1)
        upper, lower = sum(map(str.isupper, words)), len(set(words))
        out.append((
            1.0, min(log1p(n), 5.0) / 5, min(sum(map(len, words)) / max(n, 1), 20) / 10,
            min(20 * sum(map(line.count, _SYMBOLS)) / size, 3.0), min(20 * line.count("!") / size, 3.0),
            upper / max(n, 1), 1 - lower / max(n, 1), min(10 * sum(a == b for a, b in zip(words, words[1:])) / max(n, 1), 3.0),
            1.0 if line in seen else 0.0, 1.0 if line.rstrip().endswith((".", "?", "!", ":")) else 0.0,
            min(20 * line.count("|") / size, 3.0),
        ))
        seen.add(line)
    return np.array(out, float).reshape(-1, LINE_FEATURES)


@dataclass(frozen=True)
class Field:
    """``emit[f, s]`` weighs feature f in state s, ``step[s, t]`` a step from s to t; state 1 is content."""

    emit: np.ndarray
    step: np.ndarray

    def labels(self, x: np.ndarray) -> np.ndarray:
        """The best state of every line (Viterbi)."""
        score = x @ self.emit
        if not len(score):
            return np.zeros(0, int)
        (a, b), (aa, ab), (ba, bb) = score[0].tolist(), self.step[0].tolist(), self.step[1].tolist()
        back = []
        for e0, e1 in score[1:].tolist():
            from0, from1 = a + aa >= b + ba, a + ab >= b + bb  # a tie stays with boilerplate
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = e0 + (a + aa if from0 else b + ba), e1 + (a + ab if from1 else b + bb)
        at = 1 if b > a else 0
        path = [at]
        for pair in reversed(back):
            at = pair[at]
            path.append(at)
        return np.array(path[::-1], int)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _gradient(x: np.ndarray, length: np.ndarray, y: np.ndarray, emit: np.ndarray, step: np.ndarray):
    """Observed minus expected feature counts of padded texts: x [n, t, f], every line of text i in state y[i]."""
    n, t, _ = x.shape
    score = x @ emit
    live = np.arange(t)[None, :] < length[:, None]
    ahead, behind = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    ahead[:, 0] = score[:, 0]
    for k in range(1, t):
        moved = _log_sum(ahead[:, k - 1, :, None] + step[None], 1) + score[:, k]
        ahead[:, k] = np.where(live[:, k, None], moved, ahead[:, k - 1])
    for k in range(t - 2, -1, -1):
        moved = _log_sum(step[None] + (score[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
        behind[:, k] = np.where(live[:, k + 1, None], moved, 0.0)
    total = _log_sum(ahead[:, -1], 1)
    at = np.exp(ahead + behind - total[:, None, None]) * live[..., None]
    seen = np.eye(2)[y][:, None, :] * live[..., None]
    d_emit = np.einsum("ntf,nts->fs", x, seen - at)
    d_step = np.zeros((2, 2))
    for k in range(1, t):
        pair = ahead[:, k - 1, :, None] + step[None] + (score[:, k] + behind[:, k])[:, None, :] - total[:, None, None]
        d_step -= (np.exp(pair) * live[:, k, None, None]).sum(axis=0)
    steps = np.maximum(length - 1, 0)
    d_step[0, 0] += steps[y == 0].sum()
    d_step[1, 1] += steps[y == 1].sum()
    return d_emit, d_step


def train(texts: list[np.ndarray], labels: np.ndarray) -> Field:
    """Maximum likelihood by adaptive gradient steps; both classes weigh the same, texts are batched by length."""
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    batches = []
    for a in range(0, len(order), 256):
        part = order[a : a + 256]
        size = max(len(texts[k]) for k in part)
        x = np.zeros((len(part), size, LINE_FEATURES))
        for row, k in enumerate(part):
            x[row, : len(texts[k])] = texts[k]
        batches.append((x, np.array([len(texts[k]) for k in part]), labels[part]))
    emit, step = np.zeros((LINE_FEATURES, 2)), np.zeros((2, 2))
    ge, gs = np.full_like(emit, 1e-6), np.full_like(step, 1e-6)
    lines = max(sum(map(len, texts)), 1)
    for _ in range(max(3, STEPS // max(len(batches), 1))):
        for x, length, y in batches:
            de, ds = _gradient(x, length, y, emit, step)
            de, ds = de / lines - RIDGE * emit, ds / lines - RIDGE * step
            ge += de * de
            gs += ds * ds
            emit += RATE * de / np.sqrt(ge)
            step += RATE * ds / np.sqrt(gs)
    return Field(emit, step)


def _split(text: str | None) -> list[str]:
    """The lines of a text that hold a word."""
    return [line for line in (text or "").split("\n") if line.encode("utf-8", "replace").split()]


def fit_lines(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Field:
    """Fit on a bounded sample of labelled documents: lines of label 0 count as boilerplate, of label 1 as content.

    Held-out ids are left out. Without documents of both classes all weights are zero but for one that favours
    content, so nothing is rejected on the field's word.
    """
    chosen = training_ids(labels, label, TRAINING_ROWS)

    def make():
        def step(rows):
            out = {"label": [], "x": []}
            for label, text in zip(rows["label"], rows["text"]):
                x = line_statistics(_split(text)).astype(np.float32)
                for at in range(0, len(x), SEQUENCE_LINES):
                    out["label"].append(label)
                    out["x"].append(x[at : at + SEQUENCE_LINES].tobytes())
            return out

        return step

    # At most 2 * TRAINING_ROWS ids: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    found = map_lists(rows.select("label", "text"), make, "label int, x binary").collect()
    texts = [np.frombuffer(r["x"], np.float32).reshape(-1, LINE_FEATURES).astype(float) for r in found]
    y = np.array([r["label"] for r in found], int)
    full = [k for k, x in enumerate(texts) if len(x)]
    texts, y = [texts[k] for k in full], y[full]
    if not len(y) or y.min() == y.max():
        emit = np.zeros((LINE_FEATURES, 2))
        emit[0, 1] = 1.0
        return Field(emit, np.zeros((2, 2)))
    return train(texts, y)


@dataclass(frozen=True)
class Verdict:
    """The counts of the base rules, the content share by the field, and both verdicts."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    content_share: float
    kept: bool


def _repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0
    for k, window in enumerate(windows):
        if counts[window] > 1:
            total += k + 3 - max(covered, k)
            covered = k + 3
    return total


def judge(text: str | None, field: Field) -> Verdict:
    """Base rules and field over a whole text; a null text counts as empty and fails the base rules."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()  # splits at the same six characters as the contract
    n = len(words)
    lines = _split(text)
    repeats = _repeat_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    share = 0.0
    if n:
        sizes = np.array([len(line.encode("utf-8", "replace").split()) for line in lines])
        share = float(sizes[field.labels(line_statistics(lines)) == 1].sum() / n)
    return Verdict(
        n, len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeats,
        failed, share, not failed and share >= CONTENT_SHARE,
    )


def judge_documents(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, the base counts, base_failed, content_share and kept of every document.

    One narrow pass. Null texts count as empty; rows with a null or repeated doc_id keep their own row; other columns are
    not read; an empty table gives an empty result.
    """

    def make():
        def step(rows):
            found = [judge(text, field) for text in rows["text"]]
            return {"doc_id": rows["doc_id"]} | {name: [getattr(v, name) for v in found] for name in Verdict.__dataclass_fields__}

        return step

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, content_share double, kept boolean"
    )
    return map_lists(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def keep_documents(docs: DataFrame, field: Field) -> DataFrame:
    """The documents that are kept, all their columns unchanged."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            return batch.filter(pa.array([judge(text, field).kept for text in texts], pa.bool_()))

        return step

    return map_whole(docs, make)
