"""The page source as a stream, whose offset says for every scope how many of its rows have been read and of which digest.

At the start of a batch each scope is asked for its digest and its length; the length is found by asking for single rows
at doubled places, then between them, a few small requests. A scope that still has the digest it was read with goes on where it
stopped, another one starts over. Since the ends are known, the rows between are requested by several tasks. Spark notes
the offsets before a batch and commits them after it, so a batch that was cut off is read again for the same rows.

Landed pages carry their batch as ``run``; :func:`feedlake.operators.paging.whole_scopes` joins them to whole scopes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..errors import ReadError, check_status
from ..operators.paging import NOT_MODIFIED
from ..session import ship_package
from ..sources.page_source import CONDITION_HEADER, FAILED, NEVER_MATCHES, RAW_PAGES, read_scope
from ..sources.requests import Fetch, PageRequest, ScopeRequest

#: Scopes whose lengths are asked for at once; ``fetch`` has to bear that.
PROBES = 16
#: Rows that one task requests of a scope.
TASK_ROWS = 50_000


@dataclass
class _Part(InputPartition):
    scope: ScopeRequest
    digest: str | None
    last: bool


class PageStreamReader(DataSourceStreamReader):
    """Offsets ``{scope: [rows, digest]}``; a scope that has not changed since its stored digest has no entry."""

    def __init__(self, fetch: Fetch, scopes: Sequence[ScopeRequest], task_rows: int) -> None:
        self._fetch = fetch
        self._scopes = {scope.request_key: scope for scope in scopes}
        self._task_rows = task_rows
        self._found: dict[str, tuple[int, str | None]] = {}  # the ends that were found last

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        with ThreadPoolExecutor(PROBES) as pool:
            ends = list(pool.map(self._end, self._scopes.values()))
        return {key: list(end) for key, end in zip(self._scopes, ends, strict=True) if end is not None}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        parts: list[InputPartition] = []
        for key, (rows, digest) in end.items():
            scope = self._scopes.get(key)
            read, known = start.get(key, (0, None))
            first = read if digest is not None and digest == known else 0
            if scope is None or (first == rows and key in start):
                continue
            bounds = [*range(first, rows, self._task_rows), rows]
            for low, high in zip(bounds, bounds[1:] or [rows], strict=False):
                parts.append(_Part(replace(scope, start_offset=low, stop_offset=high), digest, high == rows))
        return parts

    def read(self, partition: _Part) -> Iterator[tuple]:
        scope = partition.scope
        for row in read_scope(self._fetch, replace(scope, stored_digest=None)) if scope.start_offset < scope.stop_offset else ():
            status, digest, n = row[3], row[4], row[5]
            if status == FAILED:
                raise ReadError(f"a page of {scope.request_key!r} could not be read: {row[9]}", offset=row[2])
            if digest != partition.digest or not n:  # the scope has changed meanwhile: the next batch starts it over
                return
            yield row
        if partition.last:
            yield (scope.request_key, scope.attempt, scope.stop_offset, 200, partition.digest, 0, None, "[]", None, None)

    def _ask(self, scope: ScopeRequest, offset: int, condition: str | None) -> tuple[int, str | None, bool]:
        headers = {CONDITION_HEADER: condition or NEVER_MATCHES} if scope.conditional else {}
        answer = self._fetch(PageRequest(scope.path, {**scope.params, "from": offset, "count": 1}, headers))
        check_status(answer.status)
        digest = answer.body.get("versionDigest") or None
        return answer.status, digest if scope.conditional else None, bool(answer.body.get("values"))

    def _end(self, scope: ScopeRequest) -> tuple[int, str | None] | None:
        status, digest, found = self._ask(scope, 0, scope.stored_digest)
        if status == NOT_MODIFIED:
            return None
        if not found:
            return 0, digest
        low, high = 0, scope.count  # a row stands at ``low``; none at ``high`` once the first loop ends
        rows, known = self._found.get(scope.request_key, (0, None))
        if rows and digest is not None and digest == known and self._ask(scope, rows - 1, None)[2]:
            low, high = rows - 1, rows  # an unchanged scope is looked at where it ended last
        while self._ask(scope, high, None)[2]:
            low, high = high, 2 * high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._ask(scope, middle, None)[2] else (low, middle)
        self._found[scope.request_key] = high, digest
        return high, digest


def page_stream(name: str, fetch: Fetch, scopes: Sequence[ScopeRequest], task_rows: int = TASK_ROWS) -> type[DataSource]:
    """A streaming data source class bound to ``fetch`` and the scopes to follow."""

    class PageStream(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return RAW_PAGES

        def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
            return PageStreamReader(fetch, scopes, task_rows)

    return PageStream


def stream_pages(
    spark: SparkSession, fetch: Fetch, scopes: Sequence[ScopeRequest], out: str, checkpoint: str,
    name: str = "feedlake_page_stream", task_rows: int = TASK_ROWS,
) -> StreamingQuery:
    """Land the pages that have come since the last run below ``out``, and stop when caught up.

    Every batch overwrites its own folder, so one that is read again leaves no copies. Start it again with the same
    ``checkpoint`` to go on.
    """
    ship_package(spark)
    spark.dataSource.register(page_stream(name, fetch, scopes, task_rows))

    def land(pages: DataFrame, batch_id: int) -> None:
        pages.write.mode("overwrite").parquet(f"{out}/run={batch_id}")

    writer = spark.readStream.format(name).load().writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def streamed_pages(spark: SparkSession, out: str) -> DataFrame:
    """The raw page log of all batches, with ``run``."""
    return spark.read.schema(T.StructType([*RAW_PAGES, T.StructField("run", T.IntegerType())])).parquet(out)
