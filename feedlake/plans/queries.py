"""The registered queries: every operator on the test tables, over all of their rows.

Nested records, page logs and earlier states are derived from the flat tables; whatever a plan reads
more than once is landed first. Page size and key span are small here so that the test tables give
several pages a scope.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CATALOG, EntitySpec
from ..functions import dates
from ..functions.digest import scope_digests
from ..functions.keys import window_scope_key
from ..functions.selector import narrow_schema, project
from ..operators import incremental, paging, shape, state, windows
from ..session import landed, scratch_dir, sized
from ..sources.page_log import read_page_log
from ..sources.page_source import decode_pages, read_pages
from ..sources.replay import ReplayFetch, land_pages, replay_scopes
from ..streaming.changed_since import read_changes, stream_changes
from .reader import scan_entity

Query = Callable[[SparkSession, str], DataFrame]

PAGE = 50
EARLIER_RUN = dt.date(1998, 7, 15)  # the earlier run saw the orders placed before this day
EVENT_WATERMARK = "2024-01-15T00:00:00Z"
ORDER_FIELDS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
ORDER_LEAVES = {name: (name,) for name in ORDER_FIELDS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month(column: str) -> Column:
    return F.coalesce(F.trunc(column, "MM").cast("string"), F.lit("undated"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("request_key", _month("o_orderdate"))


def _order_digests(orders: DataFrame) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return scope_digests(orders, ["request_key"], [*ORDER_FIELDS, F.col("o_orderdate").cast("date"), cents])


def _earlier(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderdate") < F.lit(EARLIER_RUN))


def _order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders landed as pages of monthly scopes."""
    return landed(spark, paging.cut_pages(_orders(spark, sf_dir), "request_key", "o_orderkey", PAGE), "pages")


def _with_strays(log: DataFrame) -> DataFrame:
    """Add a page after the end of every scope, which no scan may return."""
    after = log.where("n_values = 0").select("request_key", (F.col("offset") + PAGE).alias("_after"))
    stray = log.where("offset = 0 and n_values > 0").join(sized(after), "request_key").withColumn("offset", F.col("_after"))
    return log.unionByName(stray.drop("_after"))


# Paged scans, sorting, offsets


def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.scan_pages(_with_strays(_order_log(spark, sf_dir)), ORDER_LEAVES)


def _page_bounds(log: DataFrame, key: str) -> DataFrame:
    ends = [F.try_element_at("values", F.lit(at))[key].alias(name) for at, name in ((1, "first_id"), (-1, "last_id"))]
    return log.where("n_values > 0").select("request_key", F.col("offset").alias("page_offset"), "n_values", *ends)


def page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_bounds(paging.cut_pages(_orders(spark, sf_dir), "request_key", "o_orderkey", PAGE), "o_orderkey")


def page_index_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scope whose key repeats: the lines of all orders."""
    lines = table(spark, sf_dir, "lineitem").select(F.lit("lines").alias("request_key"), "l_orderkey", "l_linenumber")
    return _page_bounds(paging.cut_pages(lines, "request_key", "l_orderkey", PAGE), "l_orderkey")


def page_index_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys far apart do not make short pages."""
    orders = _orders(spark, sf_dir).select("request_key", (F.col("o_orderkey") * 1_000_003).alias("id"))
    return _page_bounds(paging.cut_pages(orders, "request_key", "id", PAGE), "id")


def _null_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority, where urgent ones have no scope."""
    scope = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").withColumn("request_key", scope)


def null_scope_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = landed(spark, paging.cut_pages(_null_scoped(spark, sf_dir), "request_key", "o_orderkey", PAGE), "pages")
    return paging.scan_pages(log, ORDER_LEAVES)


def null_scope_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scopes whose row count has changed since the earlier run; the urgent ones have a null scope."""
    orders = _null_scoped(spark, sf_dir)
    counted = lambda df: df.groupBy("request_key").agg(F.count("*").cast("string").alias("digest"))
    saved = counted(orders.where((F.col("o_orderdate") < F.lit(EARLIER_RUN)) | (F.col("o_orderpriority") == "5-LOW")))
    changed = incremental.changed_scopes(counted(orders), saved, ["request_key"])
    return incremental.conditional_scan(orders, changed, ["request_key"]).select("request_key", *ORDER_FIELDS)


def changed_since_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps as text with fractions of seconds."""
    events = table(spark, sf_dir, "events").withColumn("ts_text", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return incremental.changed_since(events, "ts_text", EVENT_WATERMARK).select("event_id", "ts_text")


def deep_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deep page by a text key with many equal values."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    return paging.offset_page(orders, "o_orderpriority", 1200, 250, seek_beyond=100)


def scope_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.scope_report(_with_strays(_order_log(spark, sf_dir))).select("request_key", "n_pages", "n_rows", "complete", "contiguous")


def sorted_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.offset_page(table(spark, sf_dir, "orders").select(*ORDER_FIELDS), "o_orderkey", 1000, 500)


def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(*ORDER_FIELDS)
    return paging.offset_page(orders, "o_orderkey", 1200, 250, seek_beyond=100)


def entity_page_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages, requested again page by page through the Python data source."""
    log = _order_log(spark, sf_dir)
    root = scratch_dir(spark, "replay")
    land_pages(log, root)
    raw = landed(spark, read_pages(spark, ReplayFetch(root), replay_scopes(log)), "raw")
    record = narrow_schema(log.schema["values"].dataType.elementType, ORDER_FIELDS)
    return paging.scan_pages(decode_pages(raw, record), ORDER_LEAVES)


def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as JSON lines, of which only the wanted fields are parsed."""
    log = paging.cut_pages(_orders(spark, sf_dir), "request_key", "o_orderkey", PAGE)
    folder = scratch_dir(spark, "json-pages")
    log.select("request_key", "offset", "values").write.json(folder)
    record = narrow_schema(log.schema["values"].dataType.elementType, ORDER_FIELDS)
    return paging.scan_pages(read_page_log(spark, folder, record, "json"), ORDER_LEAVES)


# Changed-since reads


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")


def changed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.changed_since(_events(spark, sf_dir), "ts", EVENT_WATERMARK)


def changed_since_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.changed_since(_events(spark, sf_dir), "ts", None)


def changed_since_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run up to the watermark it stores, and a second one from there: every row once."""
    events = _events(spark, sf_dir)
    first = incremental.changed_since(events, "ts", None, before=EVENT_WATERMARK)
    second = incremental.changed_since(events, "ts", EVENT_WATERMARK)
    return shape.stack([first.withColumn("run", F.lit(1)), second.withColumn("run", F.lit(2))])


def changed_since_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "changes")
    checkpoint = scratch_dir(spark, "stream-state")
    query = stream_changes(spark, lambda: _events(spark, sf_dir), "ts", out, checkpoint, since=EVENT_WATERMARK)
    query.awaitTermination()
    return read_changes(spark, out, _events(spark, sf_dir).schema)


def watermark_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = dates.format_watermark(F.col("ts"))
    return _events(spark, sf_dir).select(
        "event_id", mark.alias("watermark"), dates.parse_watermark(mark).cast("string").alias("read_back")
    )


def param_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    return incremental.filter_params(table(spark, sf_dir, "orders").select(*ORDER_FIELDS), wanted)


# Windows, dates, keys


def month_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly windows between every customer's first and last order."""
    day = F.col("o_orderdate").cast("date")
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return windows.expand_windows(spans, F.col("first"), F.col("last")).select("o_custkey", "period_from", "period_to")


def relative_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default three years of windows back from every customer's last order, that day included."""
    day = F.col("o_orderdate").cast("date")
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(day).alias("last"))
    start = dates.shift_years(F.col("last"), -dates.DEFAULT_YEARS_BACK)
    spanned = windows.expand_windows(spans, start, F.date_add("last", 1))
    return spanned.select("o_custkey", "period_from", "period_to")


def windowed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    inside = windows.assign_windows(orders, "o_orderdate", dt.date(1996, 2, 10), dt.date(2000, 9, 20))
    return inside.select("o_orderkey", "period_from", "period_to")


def year_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.shift_years(day, -3).alias("three_back"), dates.shift_years(day, 1).alias("one_ahead")
    )


def scope_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request keys of every customer's windows, under a filter on the customer."""
    spec = CATALOG["ledger_posting"]
    bounds = month_windows(spark, sf_dir).select("period_from", "period_to").distinct()
    key = window_scope_key(
        spec.path, spec.fields, spec.stable_sort_field, {"isOpen": True}, F.col("period_from"), F.col("period_to")
    )
    return bounds.withColumn("request_key", key)


# Digests and conditional reads


def scope_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_digests(_orders(spark, sf_dir))


def changed_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return incremental.changed_scopes(_order_digests(orders), _order_digests(_earlier(orders)), ["request_key"])


def conditional_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    changed = changed_scopes(spark, sf_dir)
    return incremental.conditional_scan(orders, changed, ["request_key"]).select("request_key", *ORDER_FIELDS)


# State


def _digest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose requests for scopes before 1996 failed, and which broke off in 2000: later scopes have no end page."""
    log = _order_log(spark, sf_dir).drop("version_digest", "values")
    answered = F.col("request_key") >= "1996-01-01"
    received = log.where("n_values > 0 or request_key < '2000-01-01'")
    received = received.withColumn("n_values", F.when(answered, F.col("n_values"))).withColumn(
        "status", F.when(answered, F.col("status")).otherwise(F.lit(500))
    )
    digests = _order_digests(_orders(spark, sf_dir)).select("request_key", F.col("digest").alias("version_digest"))
    return received.join(sized(landed(spark, digests, "digests")), "request_key")


def _saved_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the earlier run left: a digest per scope, and a position after the first page of each."""
    digests = _order_digests(_earlier(_orders(spark, sf_dir)))
    rows = F.array(
        F.struct(F.lit("digest").alias("kind"), F.col("digest").alias("value")),
        F.struct(F.lit("resume_offset").alias("kind"), F.least("n_rows", F.lit(PAGE)).cast("string").alias("value")),
        F.struct(F.lit("resume_digest").alias("kind"), F.col("digest").alias("value")),
    )
    return digests.select("request_key", F.inline(rows))


def page_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks of the finished scopes and resume positions of the others, from the page log."""
    facts = landed(spark, paging.scope_facts(_digest_log(spark, sf_dir)), "facts")
    return state.digest_watermarks(facts).unionByName(state.resume_entries(facts))


def commit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a run over all scopes: changed ones give a new watermark, those answered "not modified" keep theirs."""
    digests = _order_digests(_orders(spark, sf_dir)).join(changed_scopes(spark, sf_dir).select("request_key"), "request_key")
    known = F.when(F.col("n_rows") >= 180, F.col("digest"))  # the source gives small scopes no digest
    new = digests.select("request_key", F.lit("digest").alias("kind"), known.alias("value"))
    return state.committed_state(_saved_state(spark, sf_dir), new)


def failed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = landed(spark, paging.scope_facts(_digest_log(spark, sf_dir)), "facts")
    return state.failed_state(_saved_state(spark, sf_dir), state.resume_entries(facts), state.finished_scopes(facts))


def resume_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = _order_digests(_orders(spark, sf_dir))
    return state.resume_starts(_saved_state(spark, sf_dir), current)


def resumed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scopes unchanged since the earlier run go on after its first page, the others start over."""
    log = _order_log(spark, sf_dir)
    reached = log.where("offset = 0 and n_values > 0").select(
        "request_key", F.lit("resume_offset").alias("kind"), F.col("n_values").cast("string").alias("value")
    )
    marks = _saved_state(spark, sf_dir).where("kind = 'resume_digest'")
    starts = state.resume_starts(reached.unionByName(marks), _order_digests(_orders(spark, sf_dir)))
    return paging.scan_pages(log, ORDER_LEAVES, landed(spark, starts, "starts"))


# Nested records


def _customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = sized(table(spark, sf_dir, "nation").join(
        sized(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    ))
    region = F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    nation = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), region.alias("region"))
    joined = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("n_nationkey").isNotNull(), nation).alias("nation"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )


def nested_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["id", "name", {"nation": ["id", {"region": ["name"]}]}]
    return shape.flatten(project(_customer_records(spark, sf_dir), wanted))


def flatten_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects two levels deep; orders without a price have no total object at all."""
    level = F.struct(F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("status"))
    total = F.struct(F.col("o_totalprice").alias("amount"), level.alias("level"))
    nested = table(spark, sf_dir, "orders").select(
        F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_totalprice") >= 250_000, total).alias("total"),
    )
    return shape.flatten(nested)


def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text decoded with a schema, then flattened."""
    props = F.from_json("props", "k long", {"mode": "FAILFAST"})
    return shape.flatten(table(spark, sf_dir, "events").select("event_id", "user_id", props.alias("props")))


def _line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with lists of objects: no list for returned lines, an empty one where nothing is charged."""
    rates = [("discount", "l_discount"), ("tax", "l_tax")]
    candidates = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.struct(F.col(rate).alias("value"), F.lit("rate").alias("unit")).alias("amount"))
        for kind, rate in rates
    ])
    charges = F.filter(candidates, lambda charge: charge["amount"]["value"] > 0)
    flags = F.array(
        F.struct(F.lit("return").alias("name"), F.col("l_returnflag").alias("code")),
        F.struct(F.lit("line").alias("name"), F.col("l_linestatus").alias("code")),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") != "R", charges).alias("charges"),
        flags.alias("flags"),
    )


def explode_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.explode_list(_line_records(spark, sf_dir).drop("flags"), "charges")


def explode_two_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.explode_lists(_line_records(spark, sf_dir), ["charges", "flags"])


def list_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = shape.flatten(_line_records(spark, sf_dir).drop("flags"))
    return flat.withColumn("n_charges", F.when(F.col("charges").isNotNull(), F.size("charges"))).drop("charges")


def list_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["l_orderkey", "l_linenumber", {"charges": [{"amount": ["value"]}]}]
    return shape.explode_list(project(_line_records(spark, sf_dir), wanted), "charges")


def union_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation_id")
    )
    return shape.stack([customers, suppliers])


# Entities


def _entity_rows(spark: SparkSession, rows: DataFrame, spec: EntitySpec, given: dict[str, Column]) -> DataFrame:
    """Land ``rows`` as the page log of an entity and scan it. Pages hold the given fields, as those of a source that sends no
    nulls; the log is read with the entity's whole record, in which the others are null.
    """
    schema = spec.record_schema()
    records = rows.select(
        given["request_key"].alias("request_key"), *[given[f.name].cast(f.dataType).alias(f.name) for f in schema.fields if f.name in given]
    )
    log, folder = paging.cut_pages(records, "request_key", "id", PAGE), scratch_dir(spark, "pages")
    log.write.parquet(folder)
    whole = T.StructType([T.StructField(f.name, T.ArrayType(schema)) if f.name == "values" else f for f in log.schema])
    return scan_entity(spark.read.schema(whole).parquet(folder), spec)


def _object(column: str) -> Column:
    return F.struct(F.col(column).alias("id"))


def entity_customer_lite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scope that holds every row."""
    return _entity_rows(spark, table(spark, sf_dir, "customer"), CATALOG["customer_lite"], {
        "request_key": F.lit("customer"), "id": F.col("c_custkey"), "name": F.col("c_name"),
        "customerNumber": F.col("c_custkey"), "language": F.col("c_mktsegment"), "isInactive": F.col("c_acctbal") < 0,
    })


def entity_supplier_bank_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def account(provider: str) -> Column:
        number = F.concat(F.col("s_suppkey").cast("string"), F.lit(f"-{provider}"))
        return F.struct(F.lit("").alias("iban"), number.alias("bban"), F.lit(provider).alias("provider"))

    one, two = F.array(account("NETS")), F.array(account("NETS"), account("AUTOPAY"))
    accounts = F.when(F.col("s_acctbal") > 5000, two).when(F.col("s_acctbal") > 0, one)
    return _entity_rows(spark, table(spark, sf_dir, "supplier"), CATALOG["supplier_bank_accounts_lite"], {
        "request_key": F.lit("supplier"), "id": F.col("s_suppkey"), "isInactive": F.col("s_acctbal") < 0,
        "bankAccountPresentation": accounts,
    })


def entity_ledger_posting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as postings of monthly windows; ids repeat here, which the page cutting allows."""
    return _entity_rows(spark, table(spark, sf_dir, "lineitem"), CATALOG["ledger_posting"], {
        "request_key": _month("l_shipdate"), "id": F.col("l_orderkey"), "voucher": _object("l_orderkey"),
        "date": F.col("l_shipdate").cast("date"), "account": _object("l_suppkey"), "supplier": _object("l_suppkey"),
        "product": _object("l_partkey"), "amount": F.col("l_extendedprice"), "amountGross": F.col("l_extendedprice"),
        "row": F.col("l_linenumber"), "type": F.col("l_linestatus"), "matched": F.col("l_returnflag") == "R",
    })


def custom_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an endpoint outside the catalogue, described by its own fields."""
    spec = EntitySpec("events", ["id", "kind", {"user": ["id"]}], changed_since=False)
    return _entity_rows(spark, table(spark, sf_dir, "events"), spec, {
        "request_key": F.lit("events"), "id": F.col("event_id"), "kind": F.col("event_type"), "user": _object("user_id"),
    })


def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: orders landed as pages, scanned, put into windows, with row count and digest per window."""
    rows = paging.scan_pages(_order_log(spark, sf_dir), {**ORDER_LEAVES, "o_orderdate": ("o_orderdate",)})
    inside = windows.assign_windows(rows, "o_orderdate", dt.date(1995, 1, 1), dt.date(2001, 8, 2))
    return scope_digests(inside, ["period_from", "period_to"], ORDER_FIELDS)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        page_scan, page_index, page_index_repeated, page_index_sparse, null_scope_scan, null_scope_conditional,
        scope_report, sorted_page, deep_page, deep_page_text, json_pages, entity_page_source, changed_since_text,
        changed_since, changed_since_first_run, changed_since_two_runs, changed_since_stream, watermark_format, param_filter,
        month_windows, relative_windows, windowed_scan, year_shift, scope_key,
        scope_digest, changed_scopes, conditional_scan,
        page_state, commit_state, failed_state, resume_position, resumed_scan,
        nested_projection, flatten_orders, flatten_events, explode_list, explode_two_lists, list_kept, list_projection,
        union_ragged, entity_customer_lite, entity_supplier_bank_accounts, entity_ledger_posting, custom_endpoint,
        window_counts,
    )
}
