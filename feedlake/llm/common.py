"""What the corpus operators share: table reads, Arrow mapping and scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedlake.llm.tokens import forget
from feedlake.session import ship_package

Lists = dict[str, list]

#: Bytes of rows that a task turns into Python values at once.
BATCH_BYTES = 4 << 20
#: The words of a text, as the contracts of the word operators define them.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches of about BATCH_BYTES and of one row at least; those without rows are skipped.

    A batch of 10,000 long texts has tens of MB, and Python's copies of it and what goes back to the JVM as much again.
    """
    for batch in batches:
        rows = max(1, batch.num_rows * BATCH_BYTES // max(batch.nbytes, BATCH_BYTES))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_lists(df: DataFrame, make: Callable[[], Callable[[Lists], Lists]], schema: str) -> DataFrame:
    """Map Arrow batches, as lists by column name, to lists of the columns of ``schema`` (a DDL string).

    ``make`` is called once per partition, so what it builds (models, caches) is shared by the
    batches of that partition; they come in ``small_batches``.
    """
    ship_package(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        forget()
        step = make()
        for batch in small_batches(batches):
            out = step(batch.to_pydict())
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def map_whole(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Map Arrow batches to batches of the same columns: rows may go and values change, columns stay."""
    ship_package(df.sparkSession)

    def run(batches):
        forget()
        step = make()
        for batch in small_batches(batches):
            yield step(batch)

    return df.mapInArrow(run, df.schema)


def with_column(batch: pa.RecordBatch, name: str, values: list) -> pa.RecordBatch:
    """``batch`` with the values of one column replaced."""
    at = batch.schema.get_field_index(name)
    arrays = list(batch.columns)
    arrays[at] = pa.array(values, batch.schema.field(at).type)
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves no remainder by 5: those rows are never learnt from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_ids(labels: DataFrame, label: str, bound: int, learn_all: bool = False) -> DataFrame:
    """Up to ``bound`` labelled ids of either class, the first ones in the order of a hash of the id.

    Ids that carry several rows or both labels are left out; so are held-out ids, unless ``learn_all``.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if not learn_all:
        rows = rows.where(~held_out())
    rows = rows.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_high"))
    rows = rows.where("label = _high").select("doc_id", "label")
    parts = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for k in (0, 1)]
    return parts[0].unionByName(parts[1])
