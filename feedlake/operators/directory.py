"""Rows stored in key order with the place of every file's first row, so that any page opens only the files that hold it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paging import _orderable

_FILES = "file string, n_rows long, first_row long"
#: Rows of a file; a page of usual size lies in one or two files.
FILE_ROWS = 1 << 20


def land_directory(df: DataFrame, key: Sequence[str], folder: str, file_rows: int = FILE_ROWS) -> None:
    """Store ``df`` below ``folder`` in the order of ``key`` and then of the other columns, with the directory of its files.

    Rows are dealt out by sampled ranges and sorted within them, equal rows by their number, so no task holds more than its
    range. The directory has one row per file; its running sum of row counts is the only step over all files.
    """
    spark = df.sparkSession
    order = [*map(F.col, key), *_orderable(df)]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "_row").sortWithinPartitions(*order, "_row").drop("_row")
    rows.withColumn("_place", F.monotonically_increasing_id()).write.option("maxRecordsPerFile", file_rows).parquet(f"{folder}/rows")
    stored = spark.read.schema(T.StructType([*df.schema, T.StructField("_place", T.LongType())])).parquet(f"{folder}/rows")
    files = stored.select(F.col("_metadata.file_path").alias("file"), "_place").groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.min("_place").alias("_first"))
    before = F.sum("n_rows").over(Window.orderBy("_first")) - F.col("n_rows")
    files.select("file", "n_rows", before.alias("first_row")).coalesce(1).write.parquet(f"{folder}/files")


def directory_size(spark: SparkSession, folder: str) -> int:
    """The number of rows of a stored directory, from its files' counts."""
    return spark.read.schema(_FILES).parquet(f"{folder}/files").agg(F.sum("n_rows")).first()[0] or 0


def directory_page(spark: SparkSession, folder: str, schema: T.StructType, offset: int, limit: int) -> DataFrame:
    """Rows ``[offset, offset + limit)`` of a stored directory, in its order. Only the files that hold them are opened.

    A page beyond the end is empty.
    """
    held = (F.col("first_row") < offset + limit) & (F.col("first_row") + F.col("n_rows") > offset)
    files = spark.read.schema(_FILES).parquet(f"{folder}/files").where(held).orderBy("first_row").collect()  # those of one page
    if not files or limit <= 0:
        return spark.createDataFrame([], schema)
    parts = []
    for row in files:
        place = F.col("_metadata.row_index") + row["first_row"]
        parts.append(spark.read.schema(schema).parquet(row["file"]).select("*", place.alias("_place")))
    page = parts[0]
    for part in parts[1:]:
        page = page.union(part)
    return page.where(F.col("_place").between(offset, offset + limit - 1)).orderBy("_place").drop("_place")
