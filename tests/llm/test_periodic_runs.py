"""Periodic runs against a search over all periods, and the report on odd tables."""

import random
import time
from hashlib import sha256

import numpy as np
import pytest

from feedlake.llm.common import read
from feedlake.llm.periodic_runs import find_runs, kept_places, least_pair, planted_repeat, run_report, text_runs

SF = "/root/testdata/sf0.001"


def slow_runs(words, least_words=6, least_repeats=4):
    """Per period the maximal stretches of words that many apart and equal; the smallest period of each stretch."""
    found = {}
    for q in range(1, len(words) // least_repeats + 1):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            length = at + q - start
            if length >= max(least_words, least_repeats * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        words = [rnd.randrange(rnd.choice((1, 2, 3, 6))) for _ in range(rnd.randrange(60))]
        for _ in range(rnd.randrange(3)):
            unit = words[: rnd.randrange(1, 6)] or [1]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = unit * rnd.randrange(2, 9)
        assert find_runs(np.array(words, np.int64)) == slow_runs(words), words


def test_other_least_values():
    words = [1, 2] * 3 + [9]
    assert find_runs(np.array(words), 4, 3) == slow_runs(words, 4, 3) == [(0, 6, 2)]
    assert least_pair(4, 3) == 3
    with pytest.raises(ValueError):
        find_runs(np.array(words), 4, 2)


@pytest.mark.parametrize("words", [[7] * 200_000, [1, 2, 3] * 60_000 + [4], [*range(500), *range(500)] * 100])
def test_long_periodic_texts_take_no_quadratic_time(words):
    begun = time.time()
    runs = find_runs(np.array(words))
    assert time.time() - begun < 60
    q = len(set(words)) if words[-1] != 4 else 3
    q = 500 if len(set(words)) == 500 else q
    assert (0, len(words) - (words[-1] == 4), q) in runs


def test_kept_places():
    assert kept_places(8, [(1, 6, 1)]).tolist() == [0, 1, 7]
    assert kept_places(3, []).tolist() == [0, 1, 2]


def expected(rows):
    out = []
    for doc_id, text in rows:
        words = planted_repeat(doc_id, (text or "").encode().split())
        runs = slow_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        held = {k for s, n, q in runs for k in range(s + q, s + n)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in held)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        milli = 1000 * best[1] // best[2] if runs else None
        out.append((doc_id, len(runs), *best, milli, sha256(lines).hexdigest(), sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_report_of_the_whole_table(spark):
    docs = read(spark, SF, "documents")
    got = [tuple(r) for r in run_report(docs).collect()]
    assert sorted(got, key=repr) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert run_report(docs).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_odd_rows_and_clashing_columns(spark):
    texts = ["", None, "a", "x " * 7, "a b a b a b a b\tc", "é é é é é é é é é é", " \n\r\x0b\x0c\t ", "x " * 7]
    rows = [(k if k != 2 else None, t) for k, t in enumerate(texts)] + [(3, "x " * 7), (3, "y")]
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, start int, runs string")
    assert sorted((tuple(r) for r in run_report(docs).collect()), key=repr) == expected(rows)
    assert run_report(docs.limit(0)).collect() == []


def test_text_runs_gives_the_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "so very very very very very very good")], "doc_id long, text string")
    row = text_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 6, 1)] and row["collapsed"] == "so very good"
