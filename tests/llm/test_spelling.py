"""Spelling groups against a comparison of all words, on the whole smallest table and on random words."""

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest

from feedlake.llm.common import read
from feedlake.llm.spelling import near_pairs, pivots, spelling_groups, spelling_report, word_counts

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def slow_groups(counts):
    near = {word: [] for word in counts}
    lengths = {}
    for word in counts:
        lengths.setdefault(len(word), []).append(word)
    for n, some in lengths.items():
        for a, b in [*combinations(some, 2), *((a, b) for a in some for b in lengths.get(n + 1, ()))]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda w: (-counts[w], w))
            if counts[best] >= 2 * counts[word]:
                form[word] = best
    out = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, len(near[word]), counts[form[word]] if word in form else None))
    return sorted(out)


def slow_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_report_of_the_whole_table(spark):
    docs = read(spark, SF, "documents")
    got = spelling_report(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = slow_groups(slow_counts([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert sum(w[1] is not None for w in want) > 20
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("seed", range(4))
def test_random_words_with_many_near_ones(spark, seed):
    rnd = random.Random(seed)
    letters = "abé" if seed % 2 else "abcdefgh"
    counts = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(5, 9))): rnd.choice((3, 4, 9, 10, 50)) for _ in range(400)}
    for word in list(counts)[:150]:
        k = rnd.randrange(len(word))
        counts.setdefault(word[:k] + rnd.choice(letters) + word[k + rnd.randrange(2) :], 3)
    counts = {w: n for w, n in counts.items() if len(w) >= 5}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in spelling_groups(frame).collect()) == slow_groups(counts)


def test_chains_lead_to_their_last_form(spark):
    words = [("aaaaaaaaaa"[:k] + "b" * (10 - k), 3 * 2**k) for k in range(11)]
    got = {r["word"]: r["root"] for r in spelling_groups(spark.createDataFrame(words, "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 10}


def test_pairs_come_once(spark):
    frame = spark.createDataFrame([("colour", 9), ("color", 4), ("colours", 2), ("xxxxxx", 1)], "word string, n long")
    assert sorted(tuple(r) for r in near_pairs(frame).collect()) == [("color", "colour", 4, 9), ("colour", "colours", 9, 2)]


@pytest.mark.parametrize("seed", range(50))
def test_pivots_are_the_cheapest_disjoint_grams(seed):
    rnd = random.Random(seed)
    places = sorted(rnd.sample(range(9), rnd.randrange(3, 7)))
    costs = [rnd.randrange(9) for _ in places]
    cost = dict(zip(places, costs))
    got = pivots(places, costs)
    assert got[1] - got[0] >= 2
    assert sum(cost[p] for p in got) == min(cost[a] + cost[b] for a, b in combinations(places, 2) if b - a >= 2)


def test_odd_rows_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (None, "Straße straße STRASSE"), (3, "hello " * 4), (3, "hello " * 4), (4, "hellos hellos hellos"), (5, "héllo héllo HéLLO 123 éééééé"), (6, "× ÷ " * 5), (7, "hell0 " * 9)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    assert sorted(tuple(r) for r in spelling_report(docs).collect()) == slow_groups(slow_counts(rows))
    assert spelling_report(docs.limit(0)).collect() == []
    assert {r["word"] for r in word_counts(docs).collect()} >= {"hell", "×"}
