"""State versions in a folder: every commit is a new version that builds on the one before."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.state import STATE_SCHEMA
from .versions import Versions


class StateStore:
    """Reads the last published state, and publishes new versions.

    A version is written in full before it is published, so a run that dies half-way leaves the earlier one in force.
    Several writers may commit at once: each change is applied to the state that it follows.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")
        self.versions = Versions(spark, f"{self._root}/published")

    def load(self) -> DataFrame:
        """The state in force: empty before the first commit, which means a full load."""
        return self._state(self.versions.latest()[1])

    def commit(self, change: Callable[[DataFrame], DataFrame], run_id: str) -> None:
        """Put ``change`` of the state in force into force. If another run commits meanwhile, its state is changed instead."""

        def make(number: int, current: dict | None) -> tuple[dict, None]:
            folder = f"versions/{run_id}-{uuid.uuid4().hex}"
            change(self._state(current)).write.parquet(f"{self._root}/{folder}")
            return {"run": run_id, "state": folder}, None

        self.versions.commit(make)

    def publish(self, state: DataFrame, run_id: str) -> None:
        """Put ``state`` into force, whatever was before."""
        self.commit(lambda _: state, run_id)

    def runs(self) -> list[str]:
        """The runs that have committed, in order."""
        return [content["run"] for _, content in self.versions.history()]

    def _state(self, content: dict | None) -> DataFrame:
        if content is None:
            return self._spark.createDataFrame([], STATE_SCHEMA)
        return self._spark.read.schema(STATE_SCHEMA).parquet(f"{self._root}/{content['state']}")
