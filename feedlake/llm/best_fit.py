"""Best-fit packing of whole documents by large-item matching.

Of documents above a third of the capacity at most two share a sequence, so they are matched: the longest with the
longest that still fits beside it. Shorter documents then go, longest first, into the fullest sequence that takes them.

How long the pieces are is all that the packing depends on, and there are no more lengths than the capacity. So it is
planned on the counts of the lengths, a table of a fixed size whatever the corpus: what best fit does with one piece it
does with all alike, and the plan has classes of sequences with the same content, a few for every length. A piece then
finds its place from its number among the pieces of its length. The result is that of one packer that sees the whole
corpus, while no task holds more than its own rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedlake.llm.tokens import word_encoder
from feedlake.session import landed, ship_package, sized

CAPACITY, END_ID = 4096, 1

CUT = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"
#: Numbers of pieces of one length stay below this power of two.
_RANK_BITS = 46


@dataclass
class Sequences:
    """``n`` sequences with the same content: (length, copies) in the order of their places."""

    n: int
    content: tuple[tuple[int, int], ...]


def matched(counts: dict[int, int], capacity: int) -> list[Sequences]:
    """Pieces above a third of ``capacity``, each length matched with the longest that fits beside it.

    As no three fit together, this is best fit, and no packing of these pieces needs fewer sequences.
    """
    left = {length: n for length, n in counts.items() if 3 * length > capacity and n}
    lengths, out = sorted(left), []
    while lengths:
        long = lengths[-1]
        k = bisect_left(lengths, capacity - long + 1) - 1
        mate = lengths[k] if k >= 0 else None
        if mate == long and left[long] == 1:  # no piece of that length beside itself
            mate = lengths[k - 1] if k else None
        if mate is None:
            n = left[long]
            out.append(Sequences(n, ((long, 1),)))
        elif mate == long:
            n = left[long] // 2
            out.append(Sequences(n, ((long, 2),)))
            left[long] -= n
        else:
            n = min(left[long], left[mate])
            out.append(Sequences(n, ((long, 1), (mate, 1))))
            left[mate] -= n
            if not left[mate]:
                lengths.remove(mate)
        left[long] -= n
        if not left[long]:
            lengths.remove(long)
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Sequences]:
    """The sequences that take ``counts`` pieces of each length: matched long pieces, then the others by best fit.

    A piece goes into the fullest sequence that takes it, and so do its equals until that one is too full; all sequences
    of a class fill alike, but for one that gets what is left. A class that takes pieces has less than half of its gap
    afterwards, so the work is bounded by the capacity.
    """
    by_gap: dict[int, list[Sequences]] = {}
    gaps: list[int] = []

    def put(some: Sequences) -> None:
        gap = capacity - sum(length * copies for length, copies in some.content)
        if gap not in by_gap:
            by_gap[gap] = []
            insort(gaps, gap)
        by_gap[gap].append(some)

    for some in matched(counts, capacity):
        put(some)
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(gaps, length)
            if k < len(gaps):
                gap = gaps[k]
                some = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[k]
            else:
                gap, some = capacity, Sequences(left, ())  # new sequences, as many as it takes
            copies = gap // length
            full = min(some.n, left // copies)
            rest = min(left - full * copies, copies) if full < some.n else 0
            for n, taken in ((full, copies), (int(rest > 0), rest)):
                if n:
                    put(Sequences(n, (*some.content, (length, taken))))
            untouched = some.n - full - int(rest > 0)
            if untouched and some.content:
                put(Sequences(untouched, some.content))
            left -= full * copies + rest
    return [some for gap in gaps for some in by_gap[gap]]


def slots(sequences: list[Sequences]) -> np.ndarray:
    """A row per class and length: key of the first piece (length and its number), copies, first sequence, offset; by key."""
    taken: dict[int, int] = {}
    rows, first = [], 0
    for some in sequences:
        offset = 0
        for length, copies in some.content:
            number = taken.get(length, 0)
            rows.append(((length << _RANK_BITS) + number, copies, first, offset))
            taken[length] = number + copies * some.n
            offset += length * copies
        first += some.n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def places(lengths: np.ndarray, numbers: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and numbers among their equals."""
    key = (lengths << _RANK_BITS) + numbers
    first, copies, sequence, offset = table[np.searchsorted(table[:, 0], key, "right") - 1].T
    nth = key - first
    return sequence + nth // copies, offset + nth % copies * lengths


def cut_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, make_encoder=word_encoder) -> DataFrame:
    """The pieces of all documents, landed: CUT columns, ``ids`` little-endian 32 bits, ``nth`` the number of a piece among
    those of its length in its write task ``part``. Only documents beyond ``capacity`` have more than one piece.
    """
    ship_package(docs.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(CUT))

    def run(batches):
        encoder, part = make_encoder(), TaskContext.get().partitionId()
        end, seen = end_id.to_bytes(4, "little"), {}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.ids(text.as_py()) + end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + capacity)]
                    length = len(own) // 4
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    rows.append((doc_id, piece, start, length, own, part, nth))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return landed(docs.sparkSession, rows.mapInArrow(run, CUT), "best-fit-pieces")


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Landed pieces with ``sequence_id`` and ``offset`` in place of ``part`` and ``nth``.

    The driver sees one count per length. A piece's number among all of its length is the one within its task and the
    count of the tasks before; those counts, one per task and length, are broadcast if few.
    """
    spark = pieces.sparkSession
    counts = landed(spark, pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "best-fit-counts")
    sizes = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    table = spark.sparkContext.broadcast(slots(plan(sizes, capacity)))  # bounded by the capacity
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    found = pieces.join(sized(counts.select("part", "length", before.alias("before"))), ["part", "length"])
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    found = found.select(*kept, (F.col("before") + F.col("nth")).alias("_number"))
    schema = StructType([*(found.schema[c] for c in kept), *StructType.fromDDL("sequence_id long, offset long")])
    target = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            lengths, numbers = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_number"))
            where = places(lengths, numbers, table.value) if batch.num_rows else (lengths, numbers)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, *map(pa.array, where)], schema=target)

    return found.mapInArrow(run, schema)


def pack_best_fit(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, make_encoder=word_encoder) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id and offset of every piece.

    Every document gets ``end_id`` at its end; a null text counts as empty and is that id alone. Null and repeated doc_ids
    keep their own rows; other columns are not read; an empty table gives an empty result.
    """
    return placed(cut_documents(docs, capacity, end_id, make_encoder), capacity)


def best_fit_report(docs: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return placed(cut_documents(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
