"""Benchmark decontamination: rare n-gram seeds find passages, word alignment scores them.

Every text is read once, and those of its n-grams that a bit table of fixed size takes for an item's are kept beside it. Of each
item's n-grams the rarer ones serve as seeds, by the number of documents that hold them; a join on the seed brings documents and
items together, whatever the number of either. N-grams are taken as they stand and with their middle word left out, on both
sides, so an item of which every third word was replaced or deleted, or which has a word more after every second, still shares
some. Around the seeds that a document shares with an item, Smith-Waterman over words finds the best local alignment, so edited
and paraphrased copies score as well as exact ones.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import map_lists
from feedlake.llm.shingles import WordHashes, combined
from feedlake.session import landed

GRAM = 4
#: An n-gram is a seed unless it is in more documents than this many times the median of its item's n-grams.
RARE_TIMES = 8
MATCH, MISMATCH, GAP = 2, -1, -1
#: A document is contaminated from this share of the score that the whole item would get.
LEAST_SHARE = 0.5
#: Bits of a hash that name a place in the table of item n-grams, and those of them that name a part of it. The table has 8 MB
#: whatever the number of items; where it is full, more n-grams are kept beside the texts and the join drops them.
TABLE_BITS, PART_BITS = 26, 11

_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score of two word sequences (as hashes), and the words [start, end) of ``text`` that it covers.

    One row of the matrix at a time; gaps along the row are a running maximum.
    """
    m = len(text)
    slope = GAP * np.arange(m + 1)
    row, came = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best, span = 0, (0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        down = row[1:] + GAP
        new, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
        new[1:] = np.maximum(np.maximum(diagonal, down), 0)
        origin[1:] = np.where(new[1:] == 0, origin[1:], np.where(diagonal >= down, came[:-1], came[1:]))
        level = new - slope
        top = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == top, np.arange(m + 1), 0))
        row, came = top + slope, origin[source]
        k = int(row.argmax())
        if row[k] > best:
            best, span = int(row[k]), (int(came[k]), k)
    return best, *span


def _grams(words: np.ndarray, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the n-grams of a word sequence; those of GRAM words also with one word left out in the middle."""
    plain = combined(words, size) if len(words) >= size else np.zeros(0, np.uint64)
    at = np.arange(len(plain))
    if size < GRAM or len(words) <= GRAM:
        return plain, at
    half = GRAM // 2
    n = len(words) - GRAM
    # Both halves of each gapped n-gram side by side, hashed as if they were neighbours.
    wide = np.stack([words[k + (k >= half) : k + (k >= half) + n] for k in range(GRAM)], axis=1).reshape(-1)
    return np.concatenate([plain, combined(wide, GRAM)[::GRAM]]), np.concatenate([at, np.arange(n)])


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score (share of the item's full score), first_word and n_words of every contaminated document and item.

    Null and empty texts and items match nothing; a null doc_id or item_id keeps its rows; repeated rows are reported again;
    an item of fewer than GRAM words is one n-gram. Empty tables give an empty result.
    """
    return _leaks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)


LEAK = "item_id long, score double, first_word int, n_words int"


def _items(benchmark: DataFrame) -> DataFrame:
    """The distinct items with words: item (a number), item_id, words (hashes), and the n-grams by which they may be found."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()

    def make():
        cache = WordHashes()

        def step(rows):
            own = [cache.of(words_of(text)) for text in rows["text"]]
            found = [_grams(w, min(GRAM, len(w))) if len(w) else (w, w) for w in own]
            return {
                "item": rows["item"], "item_id": rows["item_id"], "words": [w.view(np.int64).tolist() for w in own],
                "grams": [g.view(np.int64).tolist() for g, _ in found], "places": [p.tolist() for _, p in found],
            }

        return step

    schema = "item long, item_id long, words array<long>, grams array<long>, places array<int>"
    rows = map_lists(rows.withColumn("item", F.monotonically_increasing_id()), make, schema)
    return landed(benchmark.sparkSession, rows.where("size(words) > 0"), "benchmark-items")


def _table(grams: DataFrame) -> np.ndarray:
    """The bit table of all n-grams of the items; its parts are put together by tasks, so that only its bytes reach the driver."""
    within = TABLE_BITS - PART_BITS
    place = F.shiftrightunsigned("gram", 64 - TABLE_BITS)
    parts = grams.groupBy(F.shiftright(place, within).cast("int").alias("part")).agg(
        F.collect_set(F.pmod(place, F.lit(1 << within)).cast("int")).alias("bits")
    )

    def pack(rows):
        out = []
        for bits in rows["bits"]:
            part = np.zeros(1 << within, bool)
            part[bits] = True
            out.append(np.packbits(part).tobytes())
        return {"part": rows["part"], "bits": out}

    table = np.zeros((1 << PART_BITS, (1 << within) // 8), np.uint8)
    for row in map_lists(parts, lambda: pack, "part int, bits binary").collect():
        table[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return table.reshape(-1)


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The leaks; ``doc_id`` may be a key of any type."""
    spark = docs.sparkSession
    key = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    items = _items(benchmark)
    places = items.select("item", F.explode(F.arrays_zip("grams", "places")).alias("g")).select(
        "item", F.col("g.grams").alias("gram"), F.col("g.places").alias("place")
    )
    short = sorted(r["n"] for r in items.select(F.size("words").alias("n")).where(F.col("n") < GRAM).distinct().collect())
    shared = spark.sparkContext.broadcast((_table(places), short))  # fixed size

    def search():
        cache, (table, sizes) = WordHashes(), shared.value

        def step(rows):
            out = {"row": [], "doc_id": [], "text": [], "hits": []}
            for row, doc_id, text in zip(rows["row"], rows["doc_id"], rows["text"]):
                own = cache.of(words_of(text))
                grams = np.concatenate([_grams(own, size)[0] for size in (*sizes, GRAM)])
                bit = grams >> np.uint64(64 - TABLE_BITS)
                hit = grams[(table[bit >> np.uint64(3)] >> (np.uint8(7) - (bit & np.uint64(7)).astype(np.uint8))) & 1 == 1]
                if len(hit):
                    for name, value in zip(out, (row, doc_id, text, np.unique(hit).view(np.int64).tolist())):
                        out[name].append(value)
            return out

        return step

    # A number of each row, fixed by being landed; a text that many rows share is no hot key this way.
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    near = landed(spark, map_lists(rows, search, f"row long, {key}, text string, hits array<long>"), "benchmark-near")
    hits = near.select("row", F.explode("hits").alias("gram"))
    held = places.join(hits.groupBy("gram").count(), "gram")
    # N-grams of an item that no document holds count as 0 in its median, which is taken as 1 at least.
    found = held.groupBy("item").agg(F.sort_array(F.collect_list("count"), asc=False).alias("found"))
    middle = items.select("item", F.size("grams").alias("n")).join(found, "item").select("item", _median("found", "n").alias("middle"))
    seeds = held.join(middle, "item").where(F.col("count") <= RARE_TIMES * F.greatest("middle", F.lit(1.0)))
    pairs = hits.join(seeds.select("gram", "item", "place"), "gram").groupBy("row", "item").agg(
        F.sort_array(F.collect_list(F.struct("gram", "place"))).alias("seeds")  # those of one item
    )
    pairs = pairs.join(items.select("item", "item_id", "words"), "item").drop("item")
    return map_lists(near.drop("hits").join(pairs, "row"), _score, f"{key}, {LEAK}")


def _median(found: str, n: str) -> Column:
    """The median of ``n`` numbers of which ``found``, in descending order, are those above 0."""
    at = lambda k: F.coalesce(F.get(found, k.cast("int")), F.lit(0))
    return (at(F.floor((F.col(n) - 1) / 2)) + at(F.floor(F.col(n) / 2))) / 2


def _score():
    cache, last = WordHashes(), [None, None]

    def step(rows):
        out = {"doc_id": [], "item_id": [], "score": [], "first_word": [], "n_words": []}
        for row, doc_id, text, seeds, item_id, words in zip(*(rows[c] for c in ("row", "doc_id", "text", "seeds", "item_id", "words"))):
            if last[0] != row:
                last[:] = row, cache.of(words_of(text))
            item = np.array(words, np.int64).view(np.uint64)
            share, start, end = _aligned(last[1], item, seeds)
            if share >= LEAST_SHARE:
                for name, value in zip(out, (doc_id, item_id, share, start, end - start)):
                    out[name].append(value)
        return out

    return step


def _aligned(own: np.ndarray, item: np.ndarray, seeds: list[dict]) -> tuple[float, int, int]:
    """The best aligned share and place of an item, over the stretches of the text around its seeds (ascending)."""
    gram = np.array([s["gram"] for s in seeds], np.int64)
    place = np.array([s["place"] for s in seeds], np.int64)
    grams, at = _grams(own, min(GRAM, len(item)))
    grams = grams.view(np.int64)
    first, after = np.searchsorted(gram, grams, "left"), np.searchsorted(gram, grams, "right")
    held = np.nonzero(after > first)[0]
    full, reach = MATCH * len(item), len(item)
    stretches: list[list[int]] = []
    for start in sorted({int(at[k] - p) for k in held for p in place[first[k] : after[k]]}):
        if not stretches or start - reach // 2 > stretches[-1][1]:
            stretches.append([start - reach // 2, 0])
        stretches[-1][1] = start + reach + reach // 2
    best = (0.0, 0, 0)
    for low, high in stretches:
        low = max(low, 0)
        score, start, end = align(item, own[low:high])
        if score / full > best[0]:
            best = (score / full, low + start, low + end)
    return best


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, all their columns unchanged.

    Each row is judged by its own text, so rows with a null or repeated doc_id stay or go like others; null texts stay; an empty
    table stays empty.
    """
    digest = F.md5(docs["text"].cast("binary"))
    found = _leaks(docs.select(digest.alias("doc_id"), "text"), benchmark)
    bad = landed(docs.sparkSession, found.select(F.col("doc_id").alias("leak")).distinct(), "benchmark-leaks")
    return docs.join(bad, digest == bad["leak"], "left_anti")
