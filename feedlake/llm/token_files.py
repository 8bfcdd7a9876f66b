"""Token ids in bit-packed files.

A file holds shards: ``part`` (files in id order), ``before`` (ids of the part before the shard), ``doc_ids`` and
``doc_ends`` (ids of the shard up to each document's end), ``width`` (bits of an id), ``offsets`` (where each
block of BLOCK ids begins) and ``data``: the ids, each in ``width`` bits, low bits first. Any block is found
by its offset and unpacked on its own. The shards are rows of Parquet files written by Spark, so that its
commit protocol makes lost or repeated tasks harmless and any store that Spark reaches will do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedlake.llm.common import map_lists
from feedlake.llm.tokens import word_encoder
from feedlake.session import scratch_dir, ship_package

#: Ids of a block; a multiple of 8, so that every block begins at a byte.
BLOCK = 4096
#: A shard ends with the document that brings it to so many ids.
SHARD_IDS = 1 << 18
SCHEMA = "part int, before long, doc_ids array<long>, doc_ends array<long>, width int, offsets array<long>, data binary"


def bits_for(vocabulary: int) -> int:
    """The least bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids at ``width`` bits each, filled up with zeros to a multiple of eight ids."""
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(groups), width), np.uint8)
    for k in range(8):
        for byte in range(k * width // 8, (k * width + width - 1) // 8 + 1):
            shift = k * width - 8 * byte
            moved = groups[:, k] << np.uint64(shift) if shift >= 0 else groups[:, k] >> np.uint64(-shift)
            out[:, byte] |= (moved & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def unpack_bits(data: bytes, width: int, n: int, first: int = 0) -> np.ndarray:
    """``n`` ids from id ``first`` on, a multiple of 8."""
    rows = np.frombuffer(data, np.uint8)[first // 8 * width : -(-(first + n) // 8) * width].reshape(-1, width)
    out = np.zeros((len(rows), 8), np.uint32)
    for k in range(8):
        value = np.zeros(len(rows), np.uint64)
        for byte in range(k * width // 8, (k * width + width - 1) // 8 + 1):
            shift = 8 * byte - k * width
            part = rows[:, byte].astype(np.uint64)
            value |= part << np.uint64(shift) if shift >= 0 else part >> np.uint64(-shift)
        out[:, k] = value & np.uint64((1 << width) - 1)
    return out.reshape(-1)[:n]


def read_ids(data: bytes, width: int, offsets: list[int], start: int, end: int) -> np.ndarray:
    """The ids from ``start`` to ``end`` of a shard, unpacking only the blocks that hold them."""
    if end <= start:
        return np.zeros(0, np.uint32)
    first, last = start // BLOCK, (end - 1) // BLOCK
    stop = offsets[last + 1] if last + 1 < len(offsets) else len(data)
    ids = unpack_bits(data[offsets[first] : stop], width, end - first * BLOCK)
    return ids[start - first * BLOCK :]


def write_token_files(docs: DataFrame, folder: str, end_id: int = 2, make_encoder=word_encoder) -> None:
    """Encode every whole text and write the ids to files below ``folder`` in ascending doc_id order (null first).

    Texts, not ids, are dealt out by ranges of doc_id, so each is encoded once, where it is written. Rows that repeat a
    doc_id follow each other in the order of a hash of their texts.
    """
    spark = docs.sparkSession
    ship_package(spark)
    target = to_arrow_schema(StructType.fromDDL(SCHEMA))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def write(batches):
        encoder = make_encoder()
        width = bits_for(max(encoder.vocabulary, end_id + 1))
        end, part, before = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        ids, ends, chunks, total = [], [], [], 0

        def shut():
            packed = pack_bits(np.frombuffer(b"".join(chunks), "<u4"), width)
            row = {
                "part": part, "before": before, "doc_ids": ids, "doc_ends": ends, "width": width,
                "offsets": list(range(0, len(packed), BLOCK // 8 * width)), "data": packed,
            }
            return pa.RecordBatch.from_pylist([row], schema=target)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = encoder.ids(text.as_py()) + end
                chunks.append(own)
                total += len(own) // 4
                ids.append(doc_id)
                ends.append(total)
                if total >= SHARD_IDS:
                    yield shut()
                    before += total
                    ids, ends, chunks, total = [], [], [], 0
        if ids:
            yield shut()

    rows.mapInArrow(write, SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian 32 bits) of every document in the files."""
    files = spark.read.schema(SCHEMA).parquet(folder)
    # One sum per part: the driver sees as many rows as there were write tasks.
    sizes = files.groupBy("part").agg(F.sum(F.element_at("doc_ends", -1)).alias("n"))
    starts, before = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in sizes.collect()):
        starts.append((part, before))
        before += n
    begin = F.broadcast(spark.createDataFrame(starts, "part int, part_start long"))

    def make():
        def step(rows):
            out = {"doc_id": [], "start": [], "n_tokens": [], "ids": []}
            for begin, before, doc_ids, ends, width, offsets, data in zip(*rows.values()):
                ids = read_ids(data, width, offsets, 0, ends[-1]).astype("<u4").tobytes()  # each block once
                starts = [0, *ends[:-1]]
                out["doc_id"] += doc_ids
                out["start"] += [begin + before + start for start in starts]
                out["n_tokens"] += [end - start for start, end in zip(starts, ends)]
                out["ids"] += [ids[4 * start : 4 * end] for start, end in zip(starts, ends)]
            return out

        return step

    columns = ["part_start", "before", "doc_ids", "doc_ends", "width", "offsets", "data"]
    return map_lists(files.join(begin, "part").select(columns), make, "doc_id long, start long, n_tokens long, ids binary")


def token_file_report(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from files written for it.

    Null texts count as empty and have the end id alone. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "token-files")
    write_token_files(docs, folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
