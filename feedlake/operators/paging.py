"""Paged scans over a page log, and cutting tables into pages.

A page log holds one row per received page: ``request_key, attempt, offset, status, version_digest,
n_values, values``. A scope (one ``request_key``) ends at its first empty or not-modified page; a
short page does not end it. All per-scope facts come from aggregates over the page headers, never
from a window over whole pages, so a scope that holds a third of the log is still read by all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..errors import ReadError
from ..session import landed, null_safe, sized

PAGE_SIZE = 5000  # fixed value: the default request page size
NOT_MODIFIED = 304  # fixed value: HTTP status of an unchanged scope


def scope_facts(log: DataFrame) -> DataFrame:
    """What the page headers say about each scope's latest ``attempt``, from a single aggregate.

    ``end_offset`` is the first ending page (null: unfinished), ``opened`` tells whether any page came
    back, ``first_digest`` is the digest of the first one, ``next_offset`` follows the last data page.
    """
    n, offset = F.col("n_values"), F.col("offset")
    unchanged = F.col("status") == NOT_MODIFIED
    back = (-offset).alias("back")  # the largest struct of the latest attempt then has the smallest offset
    found = log.groupBy("request_key").agg(
        F.max("attempt").alias("attempt"),
        F.max(F.when((n == 0) | unchanged, F.struct("attempt", back))).alias("end"),
        F.max(F.when(n.isNotNull() & ~unchanged, F.struct("attempt", back, "version_digest"))).alias("first"),
        F.max(F.when(n > 0, F.struct("attempt", (offset + n).alias("next")))).alias("last"),
    )

    def latest(fact: str) -> Column:
        return F.col(f"{fact}.attempt") == F.col("attempt")

    return found.select(
        "request_key", "attempt",
        F.when(latest("end"), -F.col("end.back")).alias("end_offset"),
        F.coalesce(latest("first"), F.lit(False)).alias("opened"),
        F.when(latest("first"), F.col("first.version_digest")).alias("first_digest"),
        F.when(latest("last"), F.col("last.next")).alias("next_offset"),
    )


def live_pages(log: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """The data pages of every scope's latest attempt that lie before its end.

    ``facts`` is a landed :func:`scope_facts` table of the log, if the caller has one.
    """
    if facts is None:
        facts = landed(log.sparkSession, scope_facts(log).select("request_key", "attempt", "end_offset"), "scope-facts")
    last = sized(facts.select("request_key", F.col("attempt").alias("_attempt"), F.col("end_offset").alias("_end")))
    data = log.where((F.col("n_values") > 0) & (F.col("status") != NOT_MODIFIED))
    live = (F.col("attempt") == F.col("_attempt")) & (F.col("_end").isNull() | (F.col("offset") < F.col("_end")))
    return null_safe(data, last, ["request_key"]).where(live).drop("_attempt", "_end")


def scan_pages(
    log: DataFrame,
    fields: Mapping[str, Sequence[str]] | None = None,
    starts: DataFrame | None = None,
    facts: DataFrame | None = None,
    partial: bool = False,
) -> DataFrame:
    """The records of the log, one row each.

    A log in which a scope has failed, has not ended or has a hole is refused, unless ``partial`` asks for the records that
    came.

    ``fields`` maps column names to field paths inside a record; only those leaves are read from the
    files, which exploding whole records and dropping columns later would not achieve. Where they are all that a record has,
    whole records are exploded, which is cheaper than zipping their leaves. Without ``fields``
    the rows have ``request_key`` and all fields. ``starts`` (``request_key, start_offset``) makes it
    a resumed scan: only pages from that offset onward, whole scopes where it names none.
    """
    if facts is None:
        facts = landed(log.sparkSession, scope_facts(log), "scope-facts")
    if not partial:
        require_whole(log, facts, starts)
    pages = live_pages(log, facts)
    if starts is not None:
        pages = null_safe(pages, sized(starts.select("request_key", "start_offset")), ["request_key"], "left").where(
            F.col("offset") >= F.coalesce("start_offset", F.lit(0))
        )
    if fields is None:
        return pages.select("request_key", F.explode("values").alias("_record")).select("request_key", "_record.*")
    at = lambda root, path: F.col(".".join(f"`{part}`" for part in (root, *path)))
    if {tuple(path) for path in fields.values()} >= _leaves(log.schema["values"].dataType.elementType):
        return pages.select(F.explode("values").alias("_record")).select(*[at("_record", path).alias(name) for name, path in fields.items()])
    return pages.select(F.inline(F.arrays_zip(*[at("values", path).alias(name) for name, path in fields.items()])))


def _leaves(record: T.StructType, path: tuple[str, ...] = ()) -> set[tuple[str, ...]]:
    """The paths of all fields that are not objects."""
    return {
        leaf for f in record for leaf in (_leaves(f.dataType, (*path, f.name)) if isinstance(f.dataType, T.StructType) else {(*path, f.name)})
    }


def require_whole(log: DataFrame, facts: DataFrame, starts: DataFrame | None = None) -> None:
    """Raise :class:`ReadError` unless every scope of the log has ended and its live pages add up to its end.

    ``starts`` names the offsets from which scopes are wanted (default: 0). A scope answered "not modified" at once has
    no page and is whole. One aggregate over the page headers; the driver sees a few of the scopes that are not.
    """
    pages = live_pages(log.select("request_key", "attempt", "offset", "status", "n_values"), facts)
    ends = facts.select("request_key", "end_offset", "opened")
    if starts is None:
        pages, ends = pages.withColumn("_from", F.lit(0)), ends.withColumn("_from", F.lit(0))
    else:
        wanted = sized(starts.select("request_key", F.coalesce("start_offset", F.lit(0)).alias("_start")))
        pages, ends = [
            null_safe(side, wanted, ["request_key"], "left").withColumn("_from", F.coalesce("_start", F.lit(0))).drop("_start") for side in (pages, ends)
        ]
    sums = pages.where("offset >= _from").groupBy("request_key").agg(F.sum("n_values").alias("_received"))
    received = F.coalesce("_received", F.lit(0))
    unmodified = F.col("end_offset").isNotNull() & ~F.col("opened")
    whole = received == F.greatest(F.col("end_offset") - F.col("_from"), F.lit(0))
    short = null_safe(ends, sums, ["request_key"], "left").where(~F.coalesce(unmodified | whole, F.lit(False)))
    found = short.select("request_key", "end_offset", received.alias("n_rows")).limit(5).collect()
    if found:
        raise ReadError(
            f"{len(found)} or more scopes of the page log are not whole, first {found[0]['request_key']!r}; ask for a partial result to read what came",
            scopes=[row.asDict() for row in found],
        )


def whole_scopes(log: DataFrame) -> DataFrame:
    """The page log of whole scopes out of those of several runs, told apart by ``run`` (a later run has a larger one).

    A resumed scope lies in several logs. What counts are the pages of its last run, and those of earlier runs before the
    offset where a later one went on, as long as they have the digest of the last. A run in which the scope was not modified
    adds nothing. The table of scopes and runs comes from one aggregate over the headers; pages are only joined with it.
    """
    data = log.where((F.col("status") != NOT_MODIFIED) & F.col("n_values").isNotNull())
    heads = data.groupBy("request_key", "run").agg(
        F.max(F.struct("attempt", (-F.col("offset")).alias("back"), "version_digest")).alias("head")
    ).select(
        "request_key", "run", F.col("head.attempt").alias("_attempt"), (-F.col("head.back")).alias("_start"),
        F.col("head.version_digest").alias("_digest"),
    )
    later = Window.partitionBy("request_key").orderBy(F.desc("run"))
    heads = heads.select(
        "*", F.first("_digest").over(later).alias("_last"), F.row_number().over(later).alias("_age"),
        F.min("_start").over(later.rowsBetween(Window.unboundedPreceding, -1)).alias("_until"),
    )
    heads = heads.where((F.col("_age") == 1) | (F.col("_digest") == F.col("_last"))).drop("_start", "_digest", "_last", "_age")
    pages = null_safe(data, sized(landed(log.sparkSession, heads, "run-heads")), ["request_key", "run"])
    counts = (F.col("attempt") == F.col("_attempt")) & (F.col("_until").isNull() | (F.col("offset") < F.col("_until")))
    return pages.where(counts).withColumn("attempt", F.lit(1)).drop("_attempt", "_until", "run")


def scope_report(log: DataFrame) -> DataFrame:
    """Per scope: pages, rows, and whether it is complete, contiguous and of one digest.

    Contiguous means the live pages chain from 0 to the end: every page ends where another begins,
    and their sizes add up to the end offset. Checked with an equi-join on (scope, offset), which
    spreads a large scope over all tasks.
    """
    header = log.select("request_key", "attempt", "offset", "status", "version_digest", "n_values")
    ends = landed(log.sparkSession, scope_facts(header), "scope-facts")
    pages = live_pages(header, ends).select("request_key", "offset", "n_values", "version_digest")
    begins = pages.select("request_key", "offset").union(
        ends.where("end_offset is not null").select("request_key", F.col("end_offset").alias("offset"))
    ).distinct().withColumnRenamed("offset", "_next").withColumn("_found", F.lit(1))
    chained = null_safe(pages.withColumn("_next", F.col("offset") + F.col("n_values")), begins, ["request_key", "_next"], "left")
    facts = chained.groupBy("request_key").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("n_values").alias("n_rows"),
        F.sum(F.when(F.col("_found").isNull(), 1).otherwise(0)).alias("_breaks"),
        F.min("offset").alias("_first"),
        F.min("version_digest").alias("_low"),
        F.max("version_digest").alias("_high"),
    )
    joined = null_safe(ends, facts, ["request_key"], "left")
    rows = F.coalesce("n_rows", F.lit(0))
    return joined.select(
        "request_key", "attempt",
        F.coalesce("n_pages", F.lit(0)).alias("n_pages"),
        rows.alias("n_rows"),
        F.col("end_offset").isNotNull().alias("complete"),
        (F.col("end_offset").isNotNull() & (F.coalesce("_breaks", F.lit(0)) == 0) & (rows == F.col("end_offset"))
         & (F.coalesce("_first", F.lit(0)) == 0)).alias("contiguous"),
        F.coalesce(F.col("_low") == F.col("_high"), F.lit(True)).alias("one_digest"),
    )


def running_total(df: DataFrame, scope: list[str], position: str, value: str, out: str, fan: int = 1024) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the scope's rows at smaller ``position`` (unique, integral).

    Two levels: totals of blocks of ``fan`` positions are accumulated per scope, then positions inside
    their block. No task orders more than ``fan`` rows, or one scope's block totals.
    """
    blocks = df.withColumn("_block", F.expr(f"`{position}` div {fan}"))
    totals = blocks.groupBy(*scope, "_block").agg(F.sum(value).alias("_total"))
    over = Window.partitionBy(*scope).orderBy("_block")
    bases = totals.select(*scope, "_block", (F.sum("_total").over(over) - F.col("_total")).alias("_earlier"))
    inner = Window.partitionBy(*scope, "_block").orderBy(position)
    local = blocks.withColumn("_within", F.sum(value).over(inner) - F.col(value))
    return local.join(bases, [*scope, "_block"]).withColumn(out, F.col("_earlier") + F.col("_within")).drop(
        "_block", "_earlier", "_within"
    )


def numbered(df: DataFrame, scope: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_pos``, the place of a row in its scope by ``order`` and then the remaining columns, and the row
    counts ``_n`` per scope and task.

    Rows are dealt out by sampled ranges of (scope, order), sorted within their range and landed; rows that are equal in
    every column are dealt out by row number. What a task holds of a scope lies in one stretch, so places follow from
    row numbers and from the counts of earlier tasks, of which a scope has one per task.
    """
    sort = [*map(F.col, scope), *order, *_orderable(df.drop(*scope))]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*sort, "_row").sortWithinPartitions(*sort, "_row").drop("_row")
    rows = rows.withColumn("_task", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())
    rows = landed(df.sparkSession, rows, "numbered")
    counts = rows.groupBy(*scope, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    counts = landed(df.sparkSession, counts, "task-counts")
    earlier = F.sum("_n").over(Window.partitionBy(*scope).orderBy("_task")) - F.col("_n")
    shift = counts.select(*scope, "_task", (earlier - F.col("_first")).alias("_shift"))
    placed = null_safe(rows, sized(shift), [*scope, "_task"]).withColumn("_pos", F.col("_seq") + F.col("_shift"))
    return placed.drop("_task", "_seq", "_shift"), counts


def _orderable(df: DataFrame) -> list[Column]:
    return [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema]


def cut_pages(df: DataFrame, scope: str, key: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """A table as a page log: each scope's rows in ``key`` order, ``page_size`` per page but for the last, and the empty
    page that closes the scope.

    ``key`` is the stable sort field; rows without it come first, equal keys are ordered by the remaining columns. A null
    scope is a scope. Pages are cut by the place of a row, however dense or repeated the keys are, and no task ever
    holds a whole scope: rows are shuffled by range to be placed and then by (scope, page).
    """
    rows, counts = numbered(df, [scope], [F.col(key)])
    values = F.struct(key, *[name for name in df.columns if name not in (scope, key)])
    pages = rows.groupBy(scope, F.expr(f"_pos div {page_size}").alias("_page")).agg(
        F.count(F.lit(1)).cast("int").alias("n_values"),
        F.transform(F.sort_array(F.collect_list(F.struct("_pos", values.alias("_value")))), lambda x: x["_value"]).alias("values"),
    )
    ends = counts.groupBy(scope).agg(F.sum("_n").alias("offset")).select(
        scope, "offset", F.lit(0).alias("n_values"), F.array().cast(pages.schema["values"].dataType).alias("values")
    )
    pages = pages.select(scope, (F.col("_page") * page_size).alias("offset"), "n_values", "values")
    return pages.unionByName(ends).select(
        F.col(scope).cast("string").alias("request_key"),
        F.lit(1).alias("attempt"),
        "offset",
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("version_digest"),
        "n_values", "values",
    )


def stable_sort(df: DataFrame, sort_field: str | None) -> DataFrame:
    """Ascending sort by a field, which may be a dotted path; no field, no sort."""
    return df.orderBy(_sort_column(df, sort_field)) if sort_field else df


def offset_page(df: DataFrame, sort_field: str, offset: int, limit: int, seek_beyond: int = 100_000) -> DataFrame:
    """Rows ``[offset, offset + limit)`` in ``sort_field`` order, equal keys in the order of the other columns.

    A shallow page is a distributed top-k. For a deep page on an integral key, counts per key range (at most 1024 a pass)
    narrow the key interval first. What is still deep then, by another type of key, rows without a key or one
    hot key, gets row places from a distributed sort, so no task ever holds all rows before the page.
    """
    column = _sort_column(df, sort_field)
    integral = isinstance(df.select(column.alias("k")).schema["k"].dataType, (T.LongType, T.IntegerType))
    if offset + limit > seek_beyond and integral:
        df, offset = _seek(df, column, offset, limit, seek_beyond)
    if offset + limit > seek_beyond:
        rows, _ = numbered(df, [], [column])
        return rows.where(F.col("_pos").between(offset, offset + limit - 1)).orderBy("_pos").drop("_pos")
    return df.orderBy(column, *_orderable(df)).offset(offset).limit(limit)


def _seek(df: DataFrame, column: Column, offset: int, limit: int, enough: int) -> tuple[DataFrame, int]:
    key = df.select(column.cast("long").alias("k"))
    low, high, total, known = key.agg(F.min("k"), F.max("k"), F.count(F.lit(1)), F.count("k")).first()
    if offset >= total:
        return df.where(F.lit(False)), 0
    if known < total:  # rows without a key sort first; leave them to the plain sort
        return df, offset
    first, _, before = _cell_of(key, low, high, offset, 0, enough)
    _, last, _ = _cell_of(key, first, high, min(offset + limit, total) - 1, before, enough)
    return df.where(column.between(first, last)), offset - before


def _cell_of(key: DataFrame, low: int, high: int, rank: int, before: int, enough: int) -> tuple[int, int, int]:
    """A narrow key range around the row of that rank, and the number of rows before the range."""
    while high > low:
        step = -(-(high - low + 1) // 1024)
        cells = F.expr(f"(k - {low}L) div {step}L").alias("cell")
        found = 0
        for cell, found in sorted(key.where(F.col("k").between(low, high)).groupBy(cells).count().collect()):
            if before + found > rank:
                break
            before += found
        low, high = low + cell * step, min(high, low + (cell + 1) * step - 1)
        if found <= enough:
            break
    return low, high, before


def _sort_column(df: DataFrame, sort_field: str) -> Column:
    if sort_field.split(".", 1)[0] not in df.columns:
        raise ReadError(f"sort field {sort_field!r} is not in the data", stable_sort_field=sort_field)
    return F.col(sort_field)
