"""Periodic runs of words by maximal pairs in the LCP-interval tree.

A run is a stretch of words with smallest period q that is at least LEAST_REPEATS * q (and LEAST_WORDS) long and that no
neighbouring word extends. Then the stretch without its last q words and the one without its first q words are a
maximal pair: equal, q apart, with different words on their left and on their right. So the runs of a text
are those of its maximal pairs whose distance is small against their length, and nothing has to be extended.

The pairs come from the suffix array of the text, walked bottom-up as a tree of LCP intervals. An interval holds the
places of its suffixes in text order, each with the class of its left word, and takes the smaller of its
children's lists into the largest. A pair of classes counts where two children meet. Of all places to the right of one,
only the next has the smallest distance; a farther one within reach would have that smaller distance as a
period as well. So only neighbours in the merged list are looked at, n log n of them in all.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import map_lists
from feedlake.llm.shingles import WordHashes, combined

LEAST_WORDS, LEAST_REPEATS = 6, 4
#: Places of a block of a sorted list.
_BLOCK = 512

Run = tuple[int, int, int]  # start, length, period


def least_pair(least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS) -> int:
    """The least length of the maximal pair of a run: a run has one period more, and the pair ``least_repeats - 1`` of them."""
    return -(-least_words * (least_repeats - 1) // least_repeats)


class Places:
    """Text places in ascending order, in blocks, so that taking one in does not move all others."""

    def __init__(self, place: int):
        self.blocks, self.n = [[place]], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def _block(self, place: int) -> int:
        """The block that holds ``place`` or would take it."""
        low, high = 0, len(self.blocks) - 1
        while low < high:
            middle = (low + high + 1) // 2
            if self.blocks[middle][0] <= place:
                low = middle
            else:
                high = middle - 1
        return low

    def add(self, place: int) -> None:
        k = self._block(place)
        block = self.blocks[k]
        block.insert(bisect_left(block, place), place)
        self.n += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[k : k + 1] = [block[:_BLOCK], block[_BLOCK:]]

    def around(self, place: int) -> tuple[int | None, int | None]:
        """The neighbours of a place in the list."""
        k = self._block(place)
        block = self.blocks[k]
        at = bisect_left(block, place)
        before = block[at - 1] if at else (self.blocks[k - 1][-1] if k else None)
        after = block[at + 1] if at + 1 < len(block) else (self.blocks[k + 1][0] if k + 1 < len(self.blocks) else None)
        return before, after


def numbers(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal words alike."""
    known = dict.fromkeys(words)
    for k, word in enumerate(known):
        known[word] = k
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """The places of a sequence in the order of what follows them, by ranks over doubled lengths."""
    n, step = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    while True:
        key = rank * (n + 2)
        key[: n - step] += rank[step:]
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        rank[order] = np.cumsum(new)
        step *= 2
        if new.all() or step >= n:
            return order


def common_prefixes(ids: list[int], order: list[int]) -> list[int]:
    """How many words each suffix shares with the one before it in ``order``; 0 for the first."""
    n = len(ids)
    rank = [0] * n
    for r, at in enumerate(order):
        rank[at] = r
    out, shared = [0] * n, 0
    for at in range(n):
        if rank[at]:
            other = order[rank[at] - 1]
            stop = n - max(at, other)
            while shared < stop and ids[at + shared] == ids[other + shared]:
                shared += 1
            out[rank[at]] = shared
            shared = max(shared - 1, 0)
        else:
            shared = 0
    return out


def find_runs(ids: np.ndarray, least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS) -> list[Run]:
    """All runs of a sequence of numbers as (start, length, period), by start, then period. At least 3 repeats can be asked for."""
    if least_repeats < 3:
        raise ValueError("two occurrences of a pair tell nothing of its smallest period below three repeats")
    n = len(ids)
    if n < least_words:
        return []
    words = ids.tolist()
    order = suffix_array(ids).tolist()
    shared = common_prefixes(words, order)
    least = least_pair(least_words, least_repeats)
    found: set[Run] = set()

    def pair(i: int | None, j: int | None, length: int) -> None:
        if i is None or j is None:
            return
        period = j - i
        if least_repeats * period > length + period or length + period < least_words:
            return
        if i and words[i - 1] == words[j - 1]:  # the same class of left words
            return
        if j + length < n and words[i + length] == words[j + length]:  # one child, not two
            return
        found.add((i, length + period, period))

    def closed(length: int, children: list[Places]) -> Places:
        whole = max(children, key=lambda c: c.n)
        fresh = [place for child in children if child is not whole for place in child]
        for place in fresh:
            whole.add(place)
        for place in fresh:
            before, after = whole.around(place)
            pair(before, place, length)
            pair(place, after, length)
        return whole

    open_intervals: list[tuple[int, list[Places]]] = []
    current = Places(order[0])
    for r in range(1, n + 1):
        length = shared[r] if r < n else 0
        if length < least:
            length = 0
        while open_intervals and open_intervals[-1][0] > length:
            depth, children = open_intervals.pop()
            current = closed(depth, [*children, current])
        if r == n:
            break
        if length:
            if open_intervals and open_intervals[-1][0] == length:
                open_intervals[-1][1].append(current)
            else:
                open_intervals.append((length, [current]))
        current = Places(order[r])
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_places(n: int, runs: list[Run]) -> np.ndarray:
    """The places of ``n`` words that no run holds after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.flatnonzero(np.cumsum(edges[:n]) == 0)


Change = Callable[[int | None, list[bytes]], list[bytes]]


def text_runs(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """doc_id, the runs of its words (array of start, length, period) and the text without their repeats.

    Words are what the six ASCII white-space characters leave; ``collapsed`` joins the kept ones by one space. ``change`` may
    give other words for those of a row, by its doc_id. One pass over the rows, nothing shuffled, one text in memory
    at a time beside its Arrow batch. Null and empty texts have no words, no runs and an empty collapsed text.
    Null and repeated doc_ids keep their own rows; other columns are not read; an empty table gives an empty result.
    """

    def make():
        hashes = WordHashes()

        def runs_of(words: list[bytes]) -> list[Run]:
            # Every run repeats a stretch of so many words; without such a repeat the tree has no interval that counts.
            found = np.sort(combined(hashes.of(words), least_pair()))
            return find_runs(numbers(words)) if (found[1:] == found[:-1]).any() else []

        def step(rows):
            out = {"doc_id": rows["doc_id"], "runs": [], "collapsed": []}
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                words = (text or "").encode().split()
                if change is not None:
                    words = change(doc_id, words)
                runs = runs_of(words)
                kept = [words[k] for k in kept_places(len(words), runs)] if runs else words
                out["runs"].append([dict(zip(("start", "length", "period"), run)) for run in runs])
                out["collapsed"].append(b" ".join(kept).decode())
            return out

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_lists(rows, make, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted_repeat(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the runs query: where crc32 of the id leaves no remainder by 10, the words from a place on repeat.

    A null id changes nothing.
    """
    from zlib import crc32

    if doc_id is None or not words:
        return words
    code = crc32(str(doc_id).encode())
    if code % 10:
        return words
    n, seed = len(words), code // 10
    first = seed % n
    period = 1 + (n - first) // (3 + seed % 8)
    return [*words[:first], *(words[first + k % period] for k in range(n - first))]


def run_report(docs: DataFrame, change: Change | None = planted_repeat) -> DataFrame:
    """Per document the number of runs, the longest one (ties: smallest start, then period) and digests of all runs and of
    the collapsed text. Without a run the four columns of the longest are null and the digests are those of the
    empty list and of the whole text.
    """
    found = text_runs(docs, change)
    best = F.expr("array_min(transform(runs, r -> struct(-r.length as length, r.start as start, r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        (-F.col("_best.length")).alias("length"), F.col("_best.period").alias("period"),
        F.expr("-1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
