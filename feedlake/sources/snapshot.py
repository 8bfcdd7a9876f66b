"""A table kept up by deltas, stored so that a delta rewrites only the parts that it touches.

Rows lie in parts: one per scope, or a fixed number of key buckets. A run writes the parts that it changes under a folder of its own,
then publishes which run holds each part. Readers of the version before are not disturbed, a run that dies
publishes nothing, and of two runs at once the second builds on the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import apply_delta
from .versions import Versions

_PARTS = "_part string, folder string"
_NO_SCOPE = "none"


class Snapshot:
    """The table below ``root``, of ``schema``. Parts are scopes (column ``scope``) or ``buckets`` buckets of ``key``.

    ``deleted`` names a boolean column that marks rows saying that their key is gone.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, scope: str | None = None, key: Sequence[str] = (),
        buckets: int = 64, deleted: str | None = None,
    ) -> None:
        if bool(scope) == bool(key):
            raise ValueError("a snapshot has either a scope column or key columns")
        self._spark, self._root, self._schema = spark, root.rstrip("/"), schema
        self._scope, self._key, self._buckets, self._deleted = scope, list(key), buckets, deleted
        self._versions = Versions(spark, f"{self._root}/published")

    def read(self) -> DataFrame:
        """All rows in force, without marks of deletion."""
        rows = self._rows(self._parts(self._versions.latest()[1]))
        return rows.where(~F.coalesce(F.col(self._deleted), F.lit(False))) if self._deleted else rows

    def replace(self, delta: DataFrame, read: DataFrame, run_id: str) -> None:
        """Put the rows of ``delta`` in place of all rows of the scopes in ``read`` (columns: the scope), which is what a read of
        changed scopes asks for; scopes that came back empty lose their rows. A rerun under the same ``run_id`` changes nothing.
        """
        if self._done(run_id):
            return
        refreshed = read.select(self._part().alias("_part")).distinct()
        folder = f"data/run={run_id}"
        wanted = delta.withColumn("_part", self._part()).join(refreshed, "_part", "left_semi").drop("_part")
        written = self._write(wanted, folder)

        def make(number: int, current: dict | None) -> tuple[dict, None]:
            kept = self._parts(current).join(refreshed, "_part", "left_anti")
            return self._publishable(kept.unionByName(written), run_id, number), None

        self._versions.commit(make)

    def merge(self, delta: DataFrame, order: Sequence[str], run_id: str) -> None:
        """Apply ``delta`` by key, the last row in ``order`` being the one in force.

        Only buckets that hold a key of the delta are read and written. Marks of deletion stay in the files, so that an older
        row that comes late does not bring its key back. A rerun changes nothing.
        """
        touched = delta.select(self._part().alias("_part")).distinct()

        def make(number: int, current: dict | None) -> tuple[dict | None, None]:
            if self._done(run_id):
                return None, None
            parts = self._parts(current)
            old = self._rows(parts.join(touched, "_part", "left_semi"))
            folder = f"data/run={run_id}-{number + 1}"
            written = self._write(apply_delta(old, delta.select(old.columns), self._key, order), folder)
            return self._publishable(parts.join(touched, "_part", "left_anti").unionByName(written), run_id, number), None

        self._versions.commit(make)

    def _part(self) -> Column:
        if self._scope:  # any text as a folder name; a null scope is a scope
            return F.coalesce(F.md5(F.col(self._scope).cast("string").cast("binary")), F.lit(_NO_SCOPE))
        return F.pmod(F.xxhash64(*self._key), F.lit(self._buckets)).cast("string")

    def _write(self, rows: DataFrame, folder: str) -> DataFrame:
        """Write ``rows`` by part, a large part in several files, and say which parts there are."""
        parted = rows.select(self._schema.fieldNames()).withColumn("_part", self._part())
        parted.hint("rebalance", F.col("_part")).write.mode("overwrite").partitionBy("_part").parquet(f"{self._root}/{folder}")
        whole = T.StructType([*self._schema, T.StructField("_part", T.StringType())])
        found = self._spark.read.schema(whole).parquet(f"{self._root}/{folder}").select("_part").distinct()
        return found.withColumn("folder", F.lit(folder))

    def _publishable(self, parts: DataFrame, run_id: str, number: int) -> dict:
        listing = f"parts/{run_id}-{number + 1}"
        parts.coalesce(1).write.mode("overwrite").parquet(f"{self._root}/{listing}")  # one narrow row a part
        return {"run": run_id, "parts": listing}

    def _parts(self, content: dict | None) -> DataFrame:
        if content is None:
            return self._spark.createDataFrame([], _PARTS)
        return self._spark.read.schema(_PARTS).parquet(f"{self._root}/{content['parts']}")

    def _done(self, run_id: str) -> bool:
        return any(content["run"] == run_id for _, content in self._versions.history())

    def _rows(self, parts: DataFrame) -> DataFrame:
        paths = [f"{self._root}/{row['folder']}/_part={row['_part']}" for row in parts.collect()]  # one a part
        empty = self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*paths) if paths else empty
