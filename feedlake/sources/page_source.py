"""A Python data source that reads scopes page by page and returns the raw page log.

Scopes are spread over tasks. Inside a scope the next offset is only known once a page has arrived,
so its pages come one after the other; a task holds one page at a time. A fetch failure does not fail
the task: it becomes the last row of its scope, so that everything received before it still lands.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import check_status, kind_of
from ..functions.lattice import found_type
from ..operators.paging import NOT_MODIFIED
from ..session import ship_package
from .requests import Fetch, PageRequest, ScopeRequest

RAW_PAGES = T.StructType([
    T.StructField("request_key", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("version_digest", T.StringType()),
    T.StructField("n_values", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("body", T.StringType()),
    T.StructField("error_kind", T.StringType()),
    T.StructField("error", T.StringType()),
])

# The conditional request header, and what it carries when nothing may match.
CONDITION_HEADER = "If-None-Match"
NEVER_MATCHES = "magic-value"
FAILED = 0  # status of a row that records a failure


@dataclass
class _Scopes(InputPartition):
    scopes: Sequence[ScopeRequest]


class PageReader(DataSourceReader):
    """Reads groups of scopes, one group a task. Tasks receive their own group only, not the whole list."""

    def __init__(self, fetch: Fetch, groups: Sequence[Sequence[ScopeRequest]]) -> None:
        self._fetch = fetch
        self._groups = groups

    def partitions(self) -> list[InputPartition]:
        return [_Scopes(group) for group in self._groups] or [_Scopes([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for scope in partition.scopes:
            yield from read_scope(self._fetch, scope)

    def __getstate__(self) -> Fetch:
        return self._fetch

    def __setstate__(self, fetch: Fetch) -> None:
        self.__init__(fetch, [])


def page_source(name: str, fetch: Fetch, scopes: Sequence[ScopeRequest], max_tasks: int) -> type[DataSource]:
    """A data source class bound to ``fetch`` (shipped to the executors) and the scopes to read."""
    groups = [list(scopes[i::max_tasks]) for i in range(min(max_tasks, len(scopes)))]

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return RAW_PAGES

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return PageReader(fetch, groups)

    return PageSource


def read_pages(
    spark: SparkSession,
    fetch: Fetch,
    scopes: Sequence[ScopeRequest],
    name: str = "feedlake_pages",
    max_tasks: int | None = None,
) -> DataFrame:
    """The raw page log of ``scopes``; every evaluation requests the pages again, so land it once.

    ``max_tasks`` bounds the requests in flight; by default four per core.
    """
    max_tasks = max_tasks or 4 * spark.sparkContext.defaultParallelism
    ship_package(spark)
    spark.dataSource.register(page_source(name, fetch, scopes, max_tasks))
    return spark.read.format(name).load()


def read_scope(fetch: Fetch, scope: ScopeRequest) -> Iterator[tuple]:
    """All pages of one scope, as rows of :data:`RAW_PAGES`."""
    resuming = scope.resume_offset > 0
    attempt, offset = scope.attempt, scope.resume_offset or scope.start_offset
    headers: dict[str, str] = {}
    if scope.conditional:
        condition = None if resuming else scope.stored_digest
        headers[CONDITION_HEADER] = condition or NEVER_MATCHES
    while scope.stop_offset is None or offset < scope.stop_offset:
        now = dt.datetime.now(dt.timezone.utc)
        try:
            count = scope.count if scope.stop_offset is None else min(scope.count, scope.stop_offset - offset)
            answer = fetch(PageRequest(scope.path, {**scope.params, "from": offset, "count": count}, headers))
            check_status(answer.status)
            values = answer.body.get("values") or []
            digest = answer.body.get("versionDigest") if scope.conditional else None
            body = json.dumps(values)
        except Exception as exc:  # any failure ends the scope; the reader decides what to raise
            message = str(exc) or type(exc).__name__
            yield (scope.request_key, attempt, offset, FAILED, None, None, now, None, kind_of(exc), message)
            return
        if answer.status == NOT_MODIFIED:
            yield (scope.request_key, attempt, offset, NOT_MODIFIED, None, 0, now, None, None, None)
            return
        if resuming and not (digest and digest == scope.resume_digest):
            attempt, offset, resuming = attempt + 1, 0, False
            continue
        resuming = False
        yield (scope.request_key, attempt, offset, answer.status, digest or None, len(values), now, body, None, None)
        if not values:
            return
        offset += len(values)


def decode_pages(raw: DataFrame, record: T.StructType) -> DataFrame:
    """The raw page log with ``body`` parsed into typed ``values``.

    A record that does not fit the schema, say a number where a list belongs, fails the query.
    """
    values = F.from_json("body", T.ArrayType(record), {"mode": "FAILFAST"})
    return raw.withColumn("values", values).drop("body")


def found_record(raw: DataFrame) -> T.StructType | None:
    """The least type of the records in a raw page log; None where it has no record."""
    bodies = found_type(raw.where("n_values > 0"), "body")
    record = bodies.elementType if isinstance(bodies, T.ArrayType) else bodies
    return record if isinstance(record, T.StructType) else None
