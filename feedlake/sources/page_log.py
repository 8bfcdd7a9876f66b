"""Landed page logs in any file format that Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HEADER = (
    ("request_key", T.StringType()), ("attempt", T.IntegerType()), ("offset", T.LongType()), ("status", T.IntegerType()),
    ("version_digest", T.StringType()), ("n_values", T.IntegerType()),
)


def read_page_log(spark: SparkSession, path: str, record: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """The page log below ``path`` with records of type ``record``.

    A narrow ``record`` keeps the other fields from being read (columnar files) or parsed (JSON). Logs
    without ``n_values``, ``attempt`` or ``status`` get them filled in. In JSON a record that does not
    fit fails the query unless ``options`` say otherwise.
    """
    fields = [T.StructField(name, dtype) for name, dtype in _HEADER] + [T.StructField("values", T.ArrayType(record))]
    reader = spark.read.format(fmt).schema(T.StructType(fields)).options(**{"mode": "FAILFAST", **options})
    filled = {"attempt": F.lit(1), "status": F.lit(200), "n_values": F.coalesce(F.size("values"), F.lit(0))}
    return reader.load(path).withColumns({name: F.coalesce(name, value) for name, value in filled.items()})
