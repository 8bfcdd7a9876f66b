"""Bounded-space online packing of documents into token windows.

Each task keeps a fixed number of open windows. A document's whole windows go out at once; its rest goes
into the open window that it fills best. If it fits none, the fullest window is topped up with the head of the
rest where that is long enough, sent out, and a new one opened. The windows that tasks leave open are merged in a
tree: a few tasks' leftovers go through the same packer, level by level, so that no task ever sees more
than the open windows of FAN_IN others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.tokens import byte_encoder, ids_of_each
from feedlake.session import scratch_dir, ship_package

WINDOW, OPEN, FAN_IN = 1024, 32, 8
#: A document is cut to fill a window's gap only if both pieces have so many ids.
LEAST_PIECE = 16
END_ID = 0
#: Ids that a task holds for its output before it sends them.
SENT_IDS = 500_000

PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_NAMES = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


class Packer:
    """Places pieces into at most ``OPEN`` windows; ``out`` and ``open_windows`` hold (doc_id, start, doc_tokens, ids) lists."""

    def __init__(self, first_id: int, window: int = WINDOW, most_open: int = OPEN):
        self.next_id, self.window, self.most_open = first_id, window, most_open
        self.open: list[tuple[int, list]] = []  # (ids in the window, its pieces)
        self.out: list[tuple] = []
        self.held = 0  # ids in ``out``

    def add(self, doc_id, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        at = 0
        while len(ids) - at >= self.window:
            self.emit([(doc_id, start + at, doc_tokens, ids[at : at + self.window])])
            at += self.window
        rest = ids[at:]
        start += at
        while len(rest):
            fits = [k for k, (n, _) in enumerate(self.open) if n + len(rest) <= self.window]
            if fits:
                k = max(fits, key=lambda k: self.open[k][0])
                n, pieces = self.open[k]
                pieces.append((doc_id, start, doc_tokens, rest))
                self.open[k] = (n + len(rest), pieces)
                if n + len(rest) == self.window:
                    self.emit(self.open.pop(k)[1])
                return
            if len(self.open) < self.most_open:
                self.open.append((len(rest), [(doc_id, start, doc_tokens, rest)]))
                return
            n, pieces = self.open.pop(max(range(len(self.open)), key=lambda k: self.open[k][0]))
            gap = self.window - n
            if gap >= LEAST_PIECE and len(rest) - gap >= LEAST_PIECE:
                pieces.append((doc_id, start, doc_tokens, rest[:gap]))
                start, rest = start + gap, rest[gap:]
            self.emit(pieces)

    def emit(self, pieces: list, sequence: bool = True) -> None:
        """Send out the pieces of a window; without ``sequence`` as leftovers that have no place yet."""
        offset = 0
        for doc_id, start, doc_tokens, ids in pieces:
            place = (self.next_id, offset) if sequence else (None, None)
            self.out.append((doc_id, start, len(ids), doc_tokens, *place, ids.astype("<u4", copy=False).tobytes()))
            offset += len(ids)
        self.next_id += sequence
        self.held += offset

    def sent(self) -> pa.RecordBatch:
        """What is in ``out``, as one batch of PIECE columns and ``open``; ``out`` is empty then."""
        columns = list(zip(*self.out))
        arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.binary()])]
        is_open = pa.array([int(x is None) for x in columns[4]], pa.int32())
        self.out, self.held = [], 0
        return pa.RecordBatch.from_arrays([*arrays, is_open], names=[*_NAMES, "open"])


def packed_batches(batches, packer: Packer, encoder, last: bool):
    """The pieces of ``batches``, sent whenever SENT_IDS are held, however many rows a batch has: of whole documents (doc_id,
    text) with an ``encoder``, of leftovers (doc_id, start, doc_tokens, ids) without. ``last``: what stays open is placed too.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def pieces(batch):
        if encoder:
            for doc_id, own in zip(batch.column(0), ids_of_each(encoder, (text.as_py() for text in batch.column(1)))):
                ids = np.frombuffer(own + end, "<u4")
                yield doc_id.as_py(), 0, len(ids), ids
        else:
            for doc_id, start, doc_tokens, ids in zip(*batch.columns):
                yield doc_id.as_py(), start.as_py(), doc_tokens.as_py(), np.frombuffer(ids.as_py(), "<u4")

    for batch in batches:
        for piece in pieces(batch):
            packer.add(*piece)
            if packer.held >= SENT_IDS:
                yield packer.sent()
    for _, left in packer.open:
        packer.emit(left, sequence=last)
    if packer.out:
        yield packer.sent()


def _packed(rows: DataFrame, level: int, last: bool, encode: bool, make_encoder, folder: str) -> DataFrame:
    """One level of the tree, written to ``folder`` by whether pieces have a place (``open=0``) or are leftovers."""

    def run(batches):
        packer = Packer((level << 56) + (TaskContext.get().partitionId() << 32))
        yield from packed_batches(batches, packer, make_encoder() if encode else None, last)

    rows.mapInArrow(run, PIECE + ", open int").write.partitionBy("open").option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(PIECE + ", open int").parquet(folder)


def pack_documents(docs: DataFrame, make_encoder=byte_encoder) -> DataFrame:
    """The pieces of all documents with their places: PIECE columns, ``ids`` as little-endian 32 bits.

    Every document gets END_ID at its end; a null text counts as empty and is that id alone. Null and repeated doc_ids
    keep their own rows; other columns are not read; an empty table gives an empty result. Nothing is shuffled;
    every level is written once and read from there.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    level, tasks, placed = 0, None, []
    while tasks != 1:
        if level:
            left = done.where("open = 1").select("doc_id", "start", "doc_tokens", "ids")
            tasks = max(1, -(-len(left.inputFiles()) // FAN_IN))  # a task leaves one file of leftovers at most
            rows = left.coalesce(tasks)
        done = _packed(rows, level, tasks == 1, level == 0, make_encoder, scratch_dir(spark, f"packing-{level}"))
        placed.append(done.where("open = 0").drop("open"))
        level += 1
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def packing_report(docs: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return pack_documents(docs).select(*_NAMES[:-1], F.crc32("ids").alias("ids_crc32"))
