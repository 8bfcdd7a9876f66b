"""Best-fit packing: the plan against a packer that takes piece by piece, places, ids and odd tables."""

import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedlake.llm.best_fit import best_fit_report, matched, pack_best_fit, places, plan, slots
from feedlake.llm.common import read

SF = "/root/testdata/sf0.001"


def one_by_one(lengths, capacity):
    """The number of sequences that best fit needs, piece by piece, the longest first."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - length)
    return len(gaps)


def random_lengths(rnd, capacity):
    kind = rnd.randrange(4)
    low, high = [(1, capacity), (capacity // 3, capacity), (1, capacity // 3), (capacity // 2 - 3, capacity // 2 + 3)][kind]
    return [rnd.randint(low, high) for _ in range(rnd.randrange(1, 120))]


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_and_holds_every_piece_once(seed):
    rnd = random.Random(seed)
    for capacity in (12, 100, 4096):
        lengths = random_lengths(rnd, capacity)
        counts = Counter(lengths)
        made = plan(counts, capacity)
        held = Counter()
        for some in made:
            assert some.n > 0 and sum(length * copies for length, copies in some.content) <= capacity
            for length, copies in some.content:
                held[length] += copies * some.n
        assert held == counts
        assert sum(some.n for some in made) == one_by_one(lengths, capacity)

        table, seen, filled = slots(made), Counter(), defaultdict(list)
        for length in lengths:
            sequence, offset = places(np.array([length]), np.array([seen[length]]), table)
            seen[length] += 1
            filled[int(sequence[0])].append((int(offset[0]), length))
        assert sorted(filled) == list(range(sum(some.n for some in made)))
        for pieces in filled.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length


def test_long_pieces_are_matched_with_the_longest_that_fits():
    got = {some.content: some.n for some in matched({70: 2, 60: 3, 40: 4, 35: 1, 30: 9}, 100)}
    assert got == {((70, 1),): 2, ((60, 1), (40, 1)): 3, ((40, 1), (35, 1)): 1}


def test_plan_is_bounded_however_many_pieces_there_are():
    counts = {length: 10**9 + length for length in range(1, 4097)}
    made = plan(counts)
    assert len(made) < 60_000
    total = sum(length * n for length, n in counts.items())
    assert sum(some.n for some in made) * 4096 < 1.001 * total


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(rows, docs, tokenizer):
    """Pieces hold each document's ids in a row, sequences have no holes and are not too long."""
    want = Counter()
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            own = ids[start : start + 4096]
            want[doc_id, piece, start, len(own), crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == one_by_one([r["length"] for r in rows], 4096)


def test_report_of_the_whole_table(spark, tokenizer):
    docs = read(spark, SF, "documents")
    check(best_fit_report(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], tokenizer)


def test_odd_rows_and_clashing_columns(spark, tokenizer):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same words"), (3, "same words"), (3, "other"), (None, None), (4, "long words " * 5000)]
    docs = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, length int, part int")
    check(best_fit_report(docs).collect(), rows, tokenizer)
    assert best_fit_report(docs.limit(0)).collect() == []


def test_pieces_bring_their_ids(spark, tokenizer):
    docs = spark.createDataFrame([(1, "a fox and a hen " * 9)], "doc_id long, text string")
    rows = sorted(pack_best_fit(docs, capacity=16, end_id=7).collect(), key=lambda r: r["start"])
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows]).tolist()
    assert ids == [*tokenizer.encode("a fox and a hen " * 9, add_special_tokens=False).ids, 7]
    assert max(r["length"] for r in rows) == 16
