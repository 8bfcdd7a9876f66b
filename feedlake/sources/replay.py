"""Landed page logs as a source: write them per scope, and answer page requests from them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.paging import PAGE_SIZE
from .requests import PageRequest, PageResponse, ScopeRequest


#: Bytes of a row group of landed pages, about what a request reads.
GROUP_BYTES = 1 << 20


def land_pages(log: DataFrame, root: str) -> None:
    """Write a page log below ``root``: one folder per scope, pages in offset order, values as JSON text.

    Range partitioning on (scope, offset) cuts a large scope into several files of consecutive pages
    and keeps a small one in a single file. A file has many small row groups, whose statistics of ``offset`` and ``after``
    lead a request to the group of its page, however long the scope is.
    """
    after = (F.col("offset") + F.coalesce("n_values", F.lit(0))).alias("after")
    body = log.select(
        F.col("request_key").alias("scope"), "offset", after, "status", "version_digest", "n_values", F.to_json("values").alias("body")
    )
    pages = body.repartitionByRange("scope", "offset").sortWithinPartitions("scope", "offset")
    pages.write.option("parquet.block.size", GROUP_BYTES).partitionBy("scope").parquet(root)


class ReplayFetch:
    """A fetch function that answers from the pages below ``root``; a request's path names the scope.

    Requests in offset order are served from one running scan of the scope's folder, a few pages in
    memory at a time. Requests for single rows read one row group; the folder and its statistics are looked up once.
    """

    def __init__(self, root: str) -> None:
        self._root = root
        self._scope: str | None = None
        self._next = -1
        self._pages: Iterator[dict[str, Any]] = iter(())
        self._folders: dict[str, Any] = {}

    def __call__(self, request: PageRequest) -> PageResponse:
        offset, count = request.params["from"], request.params.get("count", PAGE_SIZE)
        if count == 1:
            return self._row(request.path, offset)
        if (self._scope, self._next) != (request.path, offset):
            self._scope, self._pages = request.path, self._open(request.path, offset)
        page = next(self._pages, None)
        if page is None or page["offset"] != offset:
            return PageResponse(body={"values": []})
        self._next = offset + page["n_values"]
        return PageResponse(page["status"], {"values": json.loads(page["body"]), "versionDigest": page["version_digest"]})

    def _row(self, scope: str, offset: int) -> PageResponse:
        import pyarrow.dataset as ds

        first, after, n = (ds.field(name) for name in ("offset", "after", "n_values"))
        held = self._folder(scope).to_table(filter=(first <= offset) & ((after > offset) | (n == 0)), use_threads=False)
        pages = sorted(held.to_pylist(), key=lambda page: page["offset"])
        page = pages[0] if pages else {"status": 200, "n_values": 0, "version_digest": None}
        values = json.loads(page["body"])[offset - page["offset"] :][:1] if page["n_values"] else []
        return PageResponse(page["status"], {"values": values, "versionDigest": page["version_digest"]})

    def _open(self, scope: str, offset: int) -> Iterator[dict[str, Any]]:
        import pyarrow.dataset as ds

        later = ds.field("offset") >= offset
        for batch in self._folder(scope).to_batches(filter=later, batch_size=16, batch_readahead=1, fragment_readahead=1):
            yield from batch.to_pylist()

    def _folder(self, scope: str) -> Any:
        import pyarrow.dataset as ds

        if scope not in self._folders:
            found = ds.dataset(f"{self._root}/scope={scope}", format="parquet")
            parts = list(found.get_fragments())
            for part in parts:
                part.ensure_complete_metadata()
            self._folders[scope] = ds.FileSystemDataset(parts, found.schema, found.format, found.filesystem)
        return self._folders[scope]

    def __getstate__(self) -> str:
        return self._root

    def __setstate__(self, root: str) -> None:
        self.__init__(root)


def replay_scopes(log: DataFrame, parts: int = 10_000, least_rows: int = 1_000_000) -> list[ScopeRequest]:
    """Requests that cover a landed page log, large scopes split at known page boundaries.

    A part holds at least ``least_rows`` rows, so that no more than about ``parts`` requests besides
    one per scope come to the driver.
    """
    rows = log.agg(F.sum("n_values")).first()[0] or 0
    width = max(least_rows, -(-rows // parts))
    part = F.expr(f"offset div {width}").alias("part")
    bounds = log.groupBy("request_key", part).agg(F.min("offset").alias("start"))
    starts: dict[str, list[int]] = {}
    for row in bounds.collect():
        starts.setdefault(row["request_key"], []).append(row["start"])
    requests = []
    for key, offsets in sorted(starts.items()):
        offsets.sort()
        for start, stop in zip(offsets, [*offsets[1:], None], strict=True):
            requests.append(ScopeRequest(key, key, {}, PAGE_SIZE, start_offset=start, stop_offset=stop))
    return requests
