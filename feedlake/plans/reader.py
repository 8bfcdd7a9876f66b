"""One incremental read from request to committed state.

Pages land first, then the flat output, and the state is published last: a run that dies anywhere
before that leaves the earlier state in force.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import EntitySpec
from ..errors import PASS_THROUGH, FeedError, ReadError
from ..functions.dates import watermark_text
from ..functions.keys import scope_key
from ..functions.selector import conform, field_type, narrow_schema, render
from ..operators.paging import scan_pages, scope_facts, whole_scopes
from ..operators.shape import SEPARATOR, explode_lists, leaf_paths
from ..operators.state import (
    STATE_SCHEMA, committed_state, digest_watermarks, failed_state, finished_scopes, resume_entries,
)
from ..operators.windows import read_span, window_table
from ..session import landed, null_safe, sized
from ..sources.page_source import RAW_PAGES, decode_pages, found_record, read_pages
from ..sources.requests import Fetch, ScopeRequest
from ..sources.state_store import StateStore
from ..sources.versions import exists
from ..spec import ReadSettings, reader_kind, resolve


def scan_entity(
    log: DataFrame, spec: EntitySpec, sep: str = SEPARATOR, facts: DataFrame | None = None, partial: bool = False
) -> DataFrame:
    """The flat rows of an entity from its page log; ``partial`` as in :func:`scan_pages`.

    Scan, selection and flattening are one step, so only the selected leaves are read from the files
    and one log of a path serves its full and its narrow entities.
    """
    record = log.schema["values"].dataType.elementType
    wanted = narrow_schema(record, spec.fields)
    leaves = leaf_paths(wanted, sep)
    rows = scan_pages(log, leaves, facts=facts, partial=partial)
    flat = rows.select(*[
        conform(F.col(f"`{name}`"), field_type(record, path), field_type(wanted, path)).alias(name)
        for name, path in leaves.items()
    ])
    return explode_lists(flat, spec.explode_columns, sep)


class FeedReader:
    """Reads one entity through ``fetch`` into flat rows below ``root``, a folder all executors reach.

    ``fetch`` answers one page request and raises on failure; it runs on the executors. ``output``
    holds the rows of the last :meth:`read`, also of one that failed part-way.
    """

    def __init__(
        self,
        spark: SparkSession,
        fetch: Fetch,
        root: str,
        settings: ReadSettings,
        extra_entities: dict[str, dict[str, Any]] | None = None,
        max_tasks: int | None = None,
    ) -> None:
        self._spark = spark
        self._fetch = fetch
        self._root = root.rstrip("/")
        self._settings = settings
        self._extra = extra_entities
        self._max_tasks = max_tasks
        self._store = StateStore(spark, f"{self._root}/state")
        self.output: DataFrame | None = None

    @property
    def state(self) -> DataFrame:
        """The state in force, as ``request_key, kind, value``."""
        return self._store.load()

    def read(self) -> DataFrame:
        """Read what the state does not yet cover and return it.

        An empty result means that nothing changed. On failure the rows received before it are in
        ``output`` and the resume positions are published; then the error is raised.
        """
        spec = resolve(self._settings, self._extra)
        kind = reader_kind(spec)
        run_id = uuid.uuid4().hex
        started = watermark_text(dt.datetime.now(dt.timezone.utc))
        old = self.state
        scopes = self._scopes(spec, kind, old)
        log = self._land(scopes, run_id)
        facts = self._facts(log, run_id)

        failure = self._failure(log, spec)
        try:
            self.output = self._shape(log, facts, spec, run_id)
        except (PySparkException, Py4JJavaError, ReadError) as exc:
            reason = str(exc).strip().splitlines()[0]
            raise ReadError(f"the landed pages of {spec.path!r} could not be turned into rows: {reason}", path=spec.path) from (
                failure or exc
            )
        if failure is not None:
            self._store.commit(lambda now: failed_state(now, resume_entries(facts), finished_scopes(facts)), run_id)
            raise failure
        marks = self._watermarks(facts, kind, scopes, started)
        self._store.commit(lambda now: committed_state(now, marks), run_id)
        return self.output

    def whole(self) -> DataFrame:
        """The rows of whole scopes out of all runs so far: those before the resume position of a resumed read come from the
        runs that it resumed. Scopes that have not ended yet are left out.
        """
        spec = resolve(self._settings, self._extra)
        runs = self._store.runs()
        logs = []
        for number, run_id in enumerate(runs):
            folder = f"{self._root}/pages/{run_id}"
            if exists(self._spark, folder):  # a state that was put in by hand has no pages
                logs.append(self._spark.read.schema(RAW_PAGES).parquet(folder).withColumn("run", F.lit(number)))
        if not logs:
            raise ReadError("nothing has been read yet", path=spec.path)
        log = whole_scopes(reduce(DataFrame.unionByName, logs))
        facts = landed(self._spark, scope_facts(log), "whole-facts")
        ended = null_safe(log, sized(facts.where("end_offset is not null").select("request_key")), ["request_key"], "left_semi")
        record = narrow_schema(spec.record_schema(None if spec.schema else found_record(ended)), spec.fields)
        return scan_entity(decode_pages(ended, record), spec, self._settings.sep)

    def _scopes(self, spec: EntitySpec, kind: str, old: DataFrame) -> list[ScopeRequest]:
        params: dict[str, Any] = {**(self._settings.params or {})}
        tail = {"fields": render(spec.fields)} | ({"sorting": spec.stable_sort_field} if spec.stable_sort_field else {})
        windows: list[tuple[str, str] | None] = [None]
        if kind == "windowed":
            as_of = self._settings.as_of or dt.datetime.now(dt.timezone.utc).date()
            span = window_table(self._spark, *read_span(as_of, self._settings.date_from)).orderBy("period_from")
            windows = [(str(row["period_from"]), str(row["period_to"])) for row in span.collect()]  # one row a month
        keys = [scope_key(spec.path, spec.fields, spec.stable_sort_field, self._settings.params, w) for w in windows]
        known: dict[tuple[str, str], str | None] = {}
        for row in old.where(F.col("request_key").isin(keys)).collect():  # at most four rows a scope
            known[row["request_key"], row["kind"]] = row["value"]

        scopes = []
        for key, window in zip(keys, windows, strict=True):
            bounds = {"dateFrom": window[0], "dateTo": window[1]} if window else {}
            since = known.get((key, "changed_since")) if kind == "changed_since" else None
            changed = {"changedSince": since} if since else {}
            request = {"request_key": key, "path": spec.path, "count": self._settings.count}
            request["params"] = {**params, **bounds, **changed, **tail}
            if kind == "changed_since":  # a moving result set: neither conditional nor resumable
                scopes.append(ScopeRequest(**request, conditional=False))
            else:
                scopes.append(ScopeRequest(
                    **request,
                    stored_digest=known.get((key, "digest")),
                    resume_offset=int(known.get((key, "resume_offset")) or 0),
                    resume_digest=known.get((key, "resume_digest")),
                ))
        return scopes

    def _land(self, scopes: list[ScopeRequest], run_id: str) -> DataFrame:
        folder = f"{self._root}/pages/{run_id}"
        read_pages(self._spark, self._fetch, scopes, max_tasks=self._max_tasks).write.parquet(folder)
        return self._spark.read.schema(RAW_PAGES).parquet(folder)

    def _facts(self, log: DataFrame, run_id: str) -> DataFrame:
        folder = f"{self._root}/facts/{run_id}"
        facts = scope_facts(log)
        facts.write.parquet(folder)
        return self._spark.read.schema(facts.schema).parquet(folder)

    def _failure(self, log: DataFrame, spec: EntitySpec) -> FeedError | None:
        row = log.where("error_kind is not null").select("error_kind", "error", "request_key", "offset").first()
        if row is None:
            return None
        error = PASS_THROUGH.get(row["error_kind"], ReadError)
        details = {"path": spec.path, "entity": self._settings.entity, "offset": row["offset"]}
        return error(row["error"], **details)

    def _shape(self, log: DataFrame, facts: DataFrame, spec: EntitySpec, run_id: str) -> DataFrame:
        record = narrow_schema(spec.record_schema(None if spec.schema else found_record(log)), spec.fields)
        flat = scan_entity(decode_pages(log, record), spec, self._settings.sep, facts, partial=True)
        folder = f"{self._root}/output/{run_id}"
        flat.write.parquet(folder)
        return self._spark.read.schema(flat.schema).parquet(folder)

    def _watermarks(self, facts: DataFrame, kind: str, scopes: list[ScopeRequest], started: str) -> DataFrame:
        if kind != "changed_since":
            return digest_watermarks(facts)
        return self._spark.createDataFrame([(s.request_key, "changed_since", started) for s in scopes], STATE_SCHEMA)
