"""Registered queries over what reads leave behind, with their SQL: records whose types are found, tables kept up by deltas,
stored pages, states and streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import CATALOG, EntitySpec
from ..functions import digest as digests
from ..functions.selector import narrow_schema
from ..operators import balances, directory, incremental, paging, shape, state
from ..session import landed, scratch_dir, sized
from ..sources.page_source import decode_pages, found_record
from ..sources.replay import ReplayFetch, land_pages
from ..sources.requests import ScopeRequest
from ..sources.snapshot import Snapshot
from ..streaming.changed_since import read_changes, stream_changes
from ..streaming.pages import stream_pages, streamed_pages
from .oracle import CHANGED, EARLIER_RUN, EVENT_FIELDS, MONTH, ORDER_FIELDS as ORDER_SQL, PAGE, PAGES, WATERMARK, _digest, _digests, _WHOLE_ORDER
from .queries import EVENT_WATERMARK, ORDER_FIELDS, ORDER_LEAVES, Query, _earlier, _order_log, _orders, changed_scopes, table
from .reader import scan_entity

# Records whose schema is found


def _found(spark: SparkSession, records: DataFrame, spec: EntitySpec, key: str = "id") -> DataFrame:
    """``records`` landed as pages of JSON text and scanned with the types that the text shows."""
    log = paging.cut_pages(records, "request_key", key, PAGE)
    raw = landed(spark, log.withColumn("body", F.to_json("values")).drop("values"), "json-log")
    record = narrow_schema(spec.record_schema(found_record(raw)), spec.fields)
    return scan_entity(decode_pages(raw, record), spec)


def custom_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a list of their orders; nothing but the records says that it is a list."""
    order = F.struct(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(order).alias("orders"))
    customers = table(spark, sf_dir, "customer").join(lists, F.col("c_custkey") == F.col("o_custkey"), "left")
    records = customers.select(F.lit("customers").alias("request_key"), F.col("c_custkey").alias("id"), "orders")
    spec = EntitySpec("customers", ["id", {"orders": ["key", "price", "status"]}], False, explode_columns=("orders",))
    return _found(spark, records, spec)


def custom_nested_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a list of lines that hold a list of rates each, and a field that is a number or a text."""
    rate = lambda kind, column: F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value"))
    mark = F.when(F.col("l_returnflag") == "R", F.lit("returned")).otherwise(F.col("l_partkey").cast("string"))
    line = F.struct(F.col("l_linenumber").alias("number"), mark.alias("mark"), F.array(rate("discount", "l_discount"), rate("tax", "l_tax")).alias("rates"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(line).alias("lines"))
    records = lines.select(F.expr("concat('part ', id % 3)").alias("request_key"), "id", "lines")
    spec = EntitySpec("orders", ["id", {"lines": ["number", "mark", {"rates": ["kind", "value"]}]}], False, explode_columns=("lines", "lines_rates"))
    return _found(spark, records, spec)


def entity_balance_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly balances of customers, whose account object comes whole, with more fields than any table here names."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    postings = table(spark, sf_dir, "orders").select(F.col("o_custkey"), F.col("o_orderdate").cast("date").alias("day"), cents.alias("cents"))
    sheet = balances.account_balances(postings, "o_custkey", "day", "cents")
    nation = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    account = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("number"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), nation.alias("nation"),
    )
    nations = sized(table(spark, sf_dir, "nation"))
    joined = sheet.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    records = joined.select(
        F.col("period_from").cast("string").alias("request_key"), F.col("c_custkey").alias("order_id"), account.alias("account"),
        F.col("balance_in").alias("balanceIn"), F.col("balance_change").alias("balanceChange"), F.col("balance_out").alias("balanceOut"),
        F.col("period_from").alias("startDate"), F.add_months("period_from", 1).alias("endDate"),
    )
    return _found(spark, records, CATALOG["balance_sheet"], "order_id")


def union_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that differ in the types of their columns and in the parts of an object."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.floor("c_acctbal").cast("int").alias("amount"), F.col("c_custkey").alias("tag"),
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("contact"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_acctbal").alias("amount"),
        F.array("s_suppkey", "s_nationkey").alias("tag"),
        F.struct(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")).alias("contact"),
    )
    return shape.flatten(shape.stack([customers, suppliers]))


# Tables kept up by deltas


def apply_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept by key: a first load, a delta with changes and deletions that is applied twice, and rows that come late."""
    orders = table(spark, sf_dir, "orders")

    def rows(df: DataFrame, version: int, gone: bool = False, **changed) -> DataFrame:
        return df.withColumns(changed).select(*ORDER_FIELDS, F.lit(version).alias("version"), F.lit(gone).alias("gone"))

    first = rows(_earlier(orders), 1)
    later = orders.where(F.col("o_orderdate") >= F.lit(EARLIER_RUN))
    delta = rows(later, 1).unionByName(rows(orders.where("o_orderkey % 7 = 0"), 2, o_orderstatus=F.lit("X"))).unionByName(
        rows(orders.where("o_orderkey % 11 = 0"), 3, True)
    )
    kept = Snapshot(spark, scratch_dir(spark, "orders-kept"), first.schema, key=["o_orderkey"], buckets=8, deleted="gone")
    kept.merge(first, ["version"], "first")
    kept.merge(delta, ["version"], "second")
    kept.merge(delta, ["version"], "second")
    kept.merge(rows(orders.where("o_orderkey % 22 = 0"), 0), ["version"], "late")
    return kept.read().drop("gone")


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month; urgent ones have no scope."""
    scope = F.when(F.col("o_orderpriority") != "1-URGENT", F.trunc("o_orderdate", "MM"))
    return table(spark, sf_dir, "orders").select(scope.alias("period_from"), *ORDER_FIELDS)


def replace_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept by month: those of 1997 and those without a month are read anew, and March comes back empty."""
    orders = _by_month(spark, sf_dir)
    kept = Snapshot(spark, scratch_dir(spark, "months-kept"), orders.schema, scope="period_from")
    kept.replace(orders, orders.select("period_from"), "first")
    read = orders.where("period_from is null or year(period_from) = 1997")
    delta = read.where("o_orderkey % 2 = 0 and not period_from <=> date'1997-03-01'").withColumn("o_orderstatus", F.lit("N"))
    for run_id in ("second", "second"):
        kept.replace(delta, read.select("period_from"), run_id)
    return kept.read()


def digest_after_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of all months after new orders and changed ones, from the stored sums of the months and the delta alone."""
    orders = _orders(spark, sf_dir)
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    limbs = lambda df: digests.scope_limbs(df, ["request_key"], [*ORDER_FIELDS, F.col("o_orderdate").cast("date"), cents])
    earlier = _earlier(orders)
    stored = landed(spark, limbs(earlier), "limbs")
    old = earlier.where("o_orderkey % 17 = 0")
    new = orders.where(F.col("o_orderdate") >= F.lit(EARLIER_RUN)).unionByName(old.withColumn("o_orderstatus", F.lit("Z")))
    return digests.shifted_limbs(stored, ["request_key"], limbs(new), limbs(old)).select("request_key", "n_rows", digests.limb_digest().alias("digest"))


def account_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly balances; one account has a third of all postings, and some postings have no account."""
    account = F.when(F.col("o_orderkey") % 3 == 0, 1).when(F.col("o_orderkey") % 31 != 0, F.col("o_custkey"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    postings = table(spark, sf_dir, "orders").select(account.alias("account"), "o_orderdate", cents.alias("cents"))
    return balances.account_balances(postings, "account", "o_orderdate", "cents")


def posting_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balance of suppliers after every line; a third of all lines is of one of them."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    account = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey"))
    postings = table(spark, sf_dir, "lineitem").select(account.alias("account"), "l_shipdate", "l_orderkey", "l_linenumber", cents.alias("cents"))
    return balances.running_balances(postings, "account", ["l_shipdate", "l_orderkey", "l_linenumber"], "cents")


# Stored pages


def directory_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(*ORDER_FIELDS)
    folder = scratch_dir(spark, "directory")
    directory.land_directory(orders, ["o_orderkey"], folder, file_rows=400)
    return directory.directory_page(spark, folder, orders.schema, 1200, 250)


def conditional_scan_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed months of orders that are stored by month: other months are not opened."""
    stored = incremental.land_scopes(_orders(spark, sf_dir), "request_key", scratch_dir(spark, "by-month"))
    scan = incremental.conditional_scan(stored, changed_scopes(spark, sf_dir), ["request_key"], stored=True)
    return scan.select("request_key", *ORDER_FIELDS)


def whole_after_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that broke off after the first page of each month, and one that went on; the months of 1998 had changed meanwhile
    and were read from their start.
    """
    log = _order_log(spark, sf_dir).withColumn("version_digest", F.md5("request_key"))
    changed = F.col("request_key").startswith("1998")
    first = log.where(f"offset < {PAGE} and n_values > 0").withColumn("version_digest", F.when(changed, F.lit("old")).otherwise(F.col("version_digest")))
    second = log.where(changed | (F.col("offset") >= PAGE) | (F.col("n_values") == 0))
    runs = first.withColumn("run", F.lit(0)).unionByName(second.withColumn("run", F.lit(1)))
    return paging.scan_pages(paging.whole_scopes(runs), ORDER_LEAVES)


def partial_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows received by a run that failed after the first page of each month from 2000 on."""
    log = _order_log(spark, sf_dir)
    failed = F.col("request_key") >= "2000-01-01"
    received = log.where(~failed | ((F.col("offset") < PAGE) & (F.col("n_values") > 0)))
    failure = log.where(failed & (F.col("offset") == PAGE)).select(
        "request_key", "attempt", "offset", F.lit(0).alias("status"), "version_digest", F.lit(None).cast("int").alias("n_values"),
        F.lit(None).cast(log.schema["values"].dataType).alias("values"),
    )
    return paging.scan_pages(received.unionByName(failure), ORDER_LEAVES, partial=True)


def empty_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second month came back empty, and some were not modified at all."""
    log = _order_log(spark, sf_dir)
    at = F.month(F.to_date(F.substring("request_key", 1, 10)))
    ends = log.where("n_values = 0").withColumns({"offset": F.lit(0).cast("long"), "status": F.when(at % 4 == 0, 304).otherwise(200)})
    return paging.scan_pages(log.where(at % 2 == 1).unionByName(ends.where(at % 2 == 0)), ORDER_LEAVES)


# States and streams


def null_scope_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of scopes of which one is null: after a success, after a failure, and where each goes on."""
    scope = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("request_key")
    counts = table(spark, sf_dir, "orders").groupBy(scope).agg(F.count(F.lit(1)).cast("string").alias("n"))
    counts = landed(spark, counts, "counts")
    entry = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    rows = lambda *entries: counts.select("request_key", F.inline(F.array(*entries)))
    old = rows(entry("digest", F.lit("a")), entry("resume_offset", F.lit("50")), entry("resume_digest", F.col("n")))
    committed = state.committed_state(old, rows(entry("digest", F.col("n"))))
    resume = rows(entry("resume_offset", F.lit("90")), entry("resume_digest", F.col("n")))
    failed = state.failed_state(old, resume, counts.select("request_key").limit(0))
    starts = state.resume_starts(failed, counts.select("request_key", F.col("n").alias("digest")))
    starts = starts.select("request_key", F.lit("start").alias("kind"), F.col("start_offset").cast("string").alias("value"))
    named = [df.withColumn("after", F.lit(name)) for name, df in (("success", committed), ("failure", failed), ("resume", starts))]
    return shape.stack(named)


def changed_since_odd_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change times as text: some with another zone, some without one, some days only, some that are no time at all."""
    local = F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    kind = F.col("event_id") % 5
    text = F.when(kind == 0, local).when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(kind == 2, F.date_format("ts", "yyyy-MM-dd"))
    text = text.when((kind == 3) & (F.col("event_id") % 2 == 0), F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    events = table(spark, sf_dir, "events").select("event_id", text.alias("ts_text"))
    return incremental.changed_since(events, "ts_text", EVENT_WATERMARK)


def changed_since_stream_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream without a watermark reads all rows, also those without a change time; started again without its checkpoint, none twice."""
    known = F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("ts")
    load = lambda: table(spark, sf_dir, "events").select("event_id", known, "user_id", "event_type")
    out = scratch_dir(spark, "first-run")
    for _ in range(2):
        stream_changes(spark, load, "ts", out, scratch_dir(spark, "stream-state")).awaitTermination()
    return read_changes(spark, out, load().schema)


def page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly scopes followed as a stream of pages, which is started twice."""
    log = _order_log(spark, sf_dir).withColumn("version_digest", F.md5("request_key"))
    root, out, checkpoint = (scratch_dir(spark, label) for label in ("stream-pages", "stream-out", "stream-offsets"))
    land_pages(log, root)
    scopes = [ScopeRequest(row["request_key"], row["request_key"], {}, PAGE) for row in log.select("request_key").distinct().collect()]  # one a month
    for _ in range(2):
        stream_pages(spark, ReplayFetch(root), scopes, out, checkpoint, task_rows=PAGE * 200).awaitTermination()
    record = narrow_schema(log.schema["values"].dataType.elementType, ORDER_FIELDS)
    return paging.scan_pages(decode_pages(paging.whole_scopes(streamed_pages(spark, out)), record), ORDER_LEAVES)


KEPT: dict[str, Query] = {
    query.__name__: query
    for query in (
        custom_list, custom_nested_list, entity_balance_sheet, union_mixed_types,
        apply_delta, replace_windows, digest_after_delta, account_balances, posting_balances,
        directory_page, conditional_scan_stored, whole_after_resume, partial_result, empty_scopes,
        null_scope_state, changed_since_odd_text, changed_since_stream_first_run, page_stream,
    )
}

_EARLIER_SQL = f"timestamp '{EARLIER_RUN} 00:00:00'"
_CENTS = "cast(round({0} * 100) as bigint)"


def _running(source: str) -> str:
    """Monthly balances of ``source`` (account, day, cents)."""
    return f"""
        select account, period_from, n_postings, cast(total - balance_change as bigint) as balance_in, balance_change,
          cast(total as bigint) as balance_out
        from (select *, sum(balance_change) over (partition by account order by period_from) as total
          from (select account, cast(date_trunc('month', day) as date) as period_from, count(*) as n_postings,
              cast(sum(cents) as bigint) as balance_change from ({source}) group by 1, 2))"""


_STATUS = "case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end"
_SCOPED = "select case when o_orderpriority <> '1-URGENT' then cast(date_trunc('month', o_orderdate) as date) end as period_from, * from orders"
_READ = "period_from is null or year(period_from) = 1997"
_COUNTS = "select case when o_orderpriority <> '1-URGENT' then o_orderpriority end as request_key, cast(count(*) as varchar) as n from orders group by 1"
_CHANGED_ORDERS = f"""(select o_orderkey, o_custkey,
    case when o_orderkey % 17 = 0 and o_orderdate < {_EARLIER_SQL} then 'Z' else o_orderstatus end as o_orderstatus,
    o_orderpriority, o_orderdate, o_totalprice from orders)"""

KEPT_ORACLE: dict[str, str] = {
    "custom_list": """
        select c_custkey as id, o_orderkey as orders_key, o_totalprice as orders_price, o_orderstatus as orders_status
        from customer join orders on c_custkey = o_custkey""",
    "custom_nested_list": """
        select l_orderkey as id, cast(l_linenumber as bigint) as lines_number,
          case when l_returnflag = 'R' then 'returned' else cast(l_partkey as varchar) end as lines_mark,
          rate.kind as lines_rates_kind, rate.value as lines_rates_value
        from (select *, unnest([{'kind': 'discount', 'value': l_discount}, {'kind': 'tax', 'value': l_tax}]) as rate from lineitem)""",
    "entity_balance_sheet": f"""
        select cast(balance_in as double) as "balanceIn", cast(balance_change as double) as "balanceChange",
          cast(balance_out as double) as "balanceOut", cast(period_from as varchar) as "startDate",
          cast(cast(period_from + interval 1 month as date) as varchar) as "endDate", c_custkey as account_id,
          c_custkey as account_number, c_name as account_name, c_mktsegment as account_segment,
          cast(n_nationkey as bigint) as account_nation_id, n_name as account_nation_name
        from ({_running(f"select o_custkey as account, o_orderdate as day, {_CENTS.format('o_totalprice')} as cents from orders")})
        join customer on account = c_custkey join nation on c_nationkey = n_nationkey""",
    "union_mixed_types": """
        select cast(c_custkey as varchar) as id, cast(cast(floor(c_acctbal) as integer) as double) as amount, cast(c_custkey as varchar) as tag,
          c_name as contact_name, c_mktsegment as contact_segment, cast(null as integer) as contact_nation from customer
        union all
        select 's-' || s_suppkey, s_acctbal, '[' || s_suppkey || ',' || s_nationkey || ']', s_name, null, cast(s_nationkey as integer) from supplier""",
    "apply_delta": f"""
        select o_orderkey, o_custkey, {_STATUS} as o_orderstatus, o_orderpriority,
          cast(case when o_orderkey % 7 = 0 then 2 else 1 end as integer) as version
        from orders where o_orderkey % 11 <> 0""",
    "replace_windows": f"""
        select period_from, o_orderkey, o_custkey, case when {_READ} then 'N' else o_orderstatus end as o_orderstatus, o_orderpriority
        from ({_SCOPED})
        where not ({_READ}) or o_orderkey % 2 = 0 and period_from is distinct from date '1997-03-01'""",
    "digest_after_delta": f"select {MONTH} as request_key, count(*) as n_rows, {_digest(_WHOLE_ORDER)} as digest from {_CHANGED_ORDERS} group by 1",
    "account_balances": _running(f"""
        select case when o_orderkey % 3 = 0 then 1 when o_orderkey % 31 <> 0 then o_custkey end as account, o_orderdate as day,
          {_CENTS.format('o_totalprice')} as cents from orders"""),
    "posting_balances": f"""
        with postings as (
          select case when l_orderkey % 3 = 0 then 1 else l_suppkey end as account, l_shipdate, l_orderkey, l_linenumber,
            {_CENTS.format('l_extendedprice')} as cents from lineitem)
        select *, cast(sum(cents) over (partition by account order by l_shipdate, l_orderkey, l_linenumber, cents rows unbounded preceding) as bigint) as balance
        from postings""",
    "directory_page": f"select {ORDER_SQL} from orders order by o_orderkey limit 250 offset 1200",
    "conditional_scan_stored": f"select {MONTH} as request_key, {ORDER_SQL} from orders where {MONTH} in (select request_key from ({CHANGED}))",
    "whole_after_resume": f"select {ORDER_SQL} from orders",
    "partial_result": f"with {PAGES} select {ORDER_SQL} from numbered where request_key < '2000-01-01' or pos < {PAGE} or request_key = 'undated' and pos < {PAGE}",
    "empty_scopes": f"select {ORDER_SQL} from orders where month(o_orderdate) % 2 = 1",
    "null_scope_state": f"""
        with counts as ({_COUNTS})
        select request_key, 'digest' as kind, n as value, 'success' as after from counts
        union all select request_key, 'digest', 'a', 'failure' from counts
        union all select request_key, 'resume_offset', '90', 'failure' from counts
        union all select request_key, 'resume_digest', n, 'failure' from counts
        union all select request_key, 'start', '90', 'resume' from counts""",
    "changed_since_odd_text": f"""
        with marked as (
          select event_id, ts, case
            when event_id % 5 = 0 then strftime(ts + interval 2 hour, '%Y-%m-%dT%H:%M:%S+02:00')
            when event_id % 5 = 1 then strftime(ts, '%Y-%m-%d %H:%M:%S')
            when event_id % 5 = 2 then strftime(ts, '%Y-%m-%d')
            when event_id % 5 = 3 and event_id % 2 = 0 then 'n/a'
            else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as ts_text
          from events)
        select event_id, ts_text from marked
        where ts_text = 'n/a' or case when event_id % 5 = 2 then date_trunc('day', ts) else date_trunc('second', ts) end >= {WATERMARK}""",
    "changed_since_stream_first_run": f"select {EVENT_FIELDS.replace('ts', 'case when event_id % 13 <> 0 then ts end as ts', 1)} from events",
    "page_stream": f"select {ORDER_SQL} from orders",
}
