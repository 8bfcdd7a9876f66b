"""Spelling variants of a corpus' words by pivotal grams.

Two words are near if one edit (an inserted, deleted or replaced character) makes one the other. Bigrams are ordered by
how many words hold them, rarest first. A word's prefix is its three first bigrams in that order, with all places of the
third; its pivots are two disjoint ones of them, chosen by dynamic programming for the least number of words
that hold them. One edit spares one of the pivots. If the prefix of word r ends no later in the order than that of
a near word s, the spared pivot is therefore among the grams of s's prefix. So pivots are looked up in an index of prefixes.

Position limits make the index lists short. An edit right of the first pivot leaves all before it as it was, so the
gram stands at the same place and the words agree up to it; of what follows, they agree in the first or in the second half,
as the edit is in one of them only. An edit left of the second pivot is the same in words read backwards. One of the
two holds for any edit, as the pivots are disjoint. So the index key is the agreed text and the length of s, and what meets
in a list agrees in more than half of its letters. Every pair met is verified by its edit distance.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedlake.llm.common import map_lists
from feedlake.session import landed, ship_package

LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
#: Letters of a word; A-Z are lower-cased first. Their pairs, about 8,000, bound the table of grams.
LETTERS = "A-Za-zÀ-ÿ"
#: Grams that one edit can touch at most, and grams of a prefix: one more than that.
GRAM, PREFIX = 2, 3
#: Different words that a task counts before it hands the counts on.
COUNTED = 300_000

Change = Callable[[int | None], Callable[[str], str]]


def lowered(text: str) -> str:
    """``text`` with A-Z in lower case and all other characters as they are."""
    return text.encode().lower().decode()


def word_counts(docs: DataFrame, change: Change | None = None, least_chars: int = 1, least_count: int = 1) -> DataFrame:
    """word and n, its number of occurrences in all whole texts, for words of at least so many characters and occurrences.

    Words are maximal runs of LETTERS, A-Z lower-cased. ``change`` gives, by doc_id, a function that says what a word of that
    row counts as. Tasks hand on partial counts, so a frequent word is one row a task. Null texts have no words;
    null and repeated doc_ids count with their own rows; other columns are not read; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    target = to_arrow_schema(StructType.fromDDL("word string, n long"))

    def run(batches):
        words, counts = re.compile(f"[{LETTERS}]+"), {}

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=target)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(words.findall(lowered(text.as_py() or "")))
                as_counted = change(doc_id) if change and found else None
                for word, n in found.items():
                    word = as_counted(word) if as_counted else word
                    if len(word) >= least_chars:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) > COUNTED:
                    yield sent()
                    counts.clear()
        if counts:
            yield sent()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def pivots(places: list[int], costs: list[int], wanted: int = 2) -> tuple[int, ...]:
    """The ``wanted`` disjoint grams of least total cost among ``places`` (ascending), of equals the first ones.

    Row k of the table holds the best choice of k grams among the first places, for every number of them.
    """
    table: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] * (len(places) + 1)]
    for _ in range(wanted):
        row: list[tuple[int, tuple[int, ...]] | None] = [None]
        for place, cost in zip(places, costs):
            before = table[-1][bisect_right(places, place - GRAM)]
            taken = None if before is None else (before[0] + cost, (*before[1], place))
            row.append(min((x for x in (row[-1], taken) if x is not None), default=None))
        table.append(row)
    return table[-1][-1][1]


def agreed(word: str, place: int, length: int) -> Iterator[str]:
    """What ``word`` and a near word of ``length`` agree in, if a gram at ``place`` is in both and the edit is right of it: the
    text up to the gram's end and the first half of the other word's rest, or its second half. A word asked with its
    own length gives its index keys.
    """
    head, rest = word[: place + GRAM], word[place + GRAM :]
    half = (length - len(head)) // 2
    if half <= len(rest):
        yield f"{head}{rest[:half]}:{place},{length}"
    if 0 < length - len(head) - half <= len(rest):
        yield f"{head}~{rest[len(head) + half - length :]}:{place},{length}"


def _keys(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[str], list[str]]:
    """The order of the last gram of the word's prefix, its keys as one that looks up, and its index keys."""
    grams = [order[word[k : k + GRAM]] for k in range(len(word) - 1)]
    last = sorted(rank for rank, _ in grams)[PREFIX - 1]
    places = [k for k, (rank, _) in enumerate(grams) if rank <= last]
    first, second = pivots(places, [grams[k][1] for k in places])
    back, end = word[::-1], len(word) - GRAM
    asked = [f">{key}" for n in range(len(word) - 1, len(word) + 2) for key in agreed(word, first, n)]
    asked += [f"<{key}" for n in range(len(word) - 1, len(word) + 2) for key in agreed(back, end - second, n)]
    held = [f">{key}" for k in places for key in agreed(word, k, len(word))]
    held += [f"<{key}" for k in places for key in agreed(back, end - k, len(word))]
    return last, asked, held


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, n_a and n_b for every pair of near words, once, with a before b. ``words`` holds distinct words of at least four
    characters (beyond that, of any length) and their n, and is read twice.

    The driver sees the number of words per bigram only, at most the square of the letters. Lists of the index are joined,
    not collected; a long one is split by Spark's skew handling, as no list has to be seen as a whole.
    """
    spark = words.sparkSession
    grams = F.explode(F.expr("transform(sequence(1, length(word) - 1), k -> substring(word, k, 2))")).alias("gram")
    counts = words.select(grams).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    ranked = sorted((row["n"], row["gram"]) for row in counts)
    order = spark.sparkContext.broadcast({gram: (rank, n) for rank, (n, gram) in enumerate(ranked)})

    def make():
        def step(rows):
            out = {"word": [], "n": [], "last": [], "key": [], "asked": []}
            for word, n in zip(rows["word"], rows["n"]):
                last, asked, held = _keys(word, order.value)
                keys = [*map(xxhash.xxh3_64_intdigest, asked), *map(xxhash.xxh3_64_intdigest, held)]
                out["key"] += [key - (1 << 63) for key in keys]
                out["asked"] += [True] * len(asked) + [False] * len(held)
                for name, value in (("word", word), ("n", n), ("last", last)):
                    out[name] += [value] * len(keys)
            return out

        return step

    rows = landed(spark, map_lists(words, make, "word string, n long, last int, key long, asked boolean"), "spelling-keys")
    r, s = rows.where("asked").alias("r"), rows.where("not asked").alias("s")
    met = r.join(s, F.expr("r.key = s.key and r.last <= s.last and r.word <> s.word")).where("levenshtein(r.word, s.word, 1) = 1")
    ends = [("a", "word", "r", "s"), ("b", "word", "s", "r"), ("n_a", "n", "r", "s"), ("n_b", "n", "s", "r")]
    return met.select(*[F.expr(f"if(r.word < s.word, {x}.{c}, {y}.{c}) as {name}") for name, c, x, y in ends]).distinct()


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word: its number of near words, the most frequent of them (of equals
    the first in code-point order) if it occurs ``ratio`` times as often at least, and where following forms leads to.

    As counts grow by ``ratio`` at least from a word to its form, chains have no cycles and are short; roots are found by
    doubling steps, a few joins of the words that have a form.
    """
    spark = words.sparkSession
    words = landed(spark, words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words).select(F.inline(F.expr(
        "array(struct(a as word, b as near, n_a as n, n_b as near_n), struct(b as word, a as near, n_b as n, n_a as near_n))"
    )))
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    form = F.expr(f"if(-best.less >= {ratio} * n, best.near, null)")
    found = words.join(best, "word", "left").withColumn("form", form).withColumn("form_n", F.expr("if(form is null, null, -best.less)"))
    found = landed(spark, found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n"), "spelling-forms")

    ends, moved = found.where("form is not null").select("word", F.col("form").alias("root")), True
    while moved:
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        step = landed(spark, ends.join(on, "root", "left").select("word", F.coalesce("_on", "root").alias("root"), "_on"), "spelling-roots")
        ends, moved = step.drop("_on"), bool(step.where("_on is not null").limit(1).count())
    found = found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def with_slips(doc_id: int | None) -> Callable[[str], str]:
    """Where 97 divides the crc32 of "<doc_id>:<word>", the word without the character at that crc32 modulo its length. A
    null id counts as an empty one.
    """
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def counted_as(word: str) -> str:
        code = crc32(word.encode(), start)
        if code % 97:
            return word
        at = code % len(word)
        return word[:at] + word[at + 1 :]

    return counted_as


def spelling_report(docs: DataFrame) -> DataFrame:
    """The groups of the words of all whole texts, of LEAST_CHARS characters and LEAST_COUNT occurrences at least."""
    return spelling_groups(word_counts(docs, with_slips, LEAST_CHARS, LEAST_COUNT))
