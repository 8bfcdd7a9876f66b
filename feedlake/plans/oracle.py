"""DuckDB SQL with the results of the registered queries, over the same tables."""

from __future__ import annotations

from ..catalog import CATALOG
from ..functions.keys import request_text
from .queries import EARLIER_RUN, PAGE

ORDER_FIELDS = "o_orderkey, o_custkey, o_orderstatus, o_orderpriority"
MONTH = "coalesce(cast(cast(date_trunc('month', o_orderdate) as date) as varchar), 'undated')"
EARLIER = f"(select * from orders where o_orderdate < timestamp '{EARLIER_RUN} 00:00:00')"
WATERMARK = "timestamp '2024-01-15 00:00:00'"
EVENT_FIELDS = "event_id, ts, user_id, event_type"


def _prefixed(expr: str) -> str:
    text = f"cast({expr} as varchar)"
    return f"coalesce(cast(length({text}) as varchar) || ':' || {text}, '-')"


def _digest(exprs: list[str]) -> str:
    row = " || ".join(_prefixed(e) for e in exprs)
    total = f"sum(cast(cast(('0x' || substr(md5({row}), 1, 15)) as ubigint) as hugeint))"
    return f"cast(count(*) as varchar) || '-' || cast({total} as varchar)"


_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
_WHOLE_ORDER = [*_FIELDS, "cast(o_orderdate as date)", "cast(round(o_totalprice * 100) as bigint)"]


def _digests(source: str) -> str:
    return f"(select {MONTH} as request_key, count(*) as n_rows, {_digest(_WHOLE_ORDER)} as digest from {source} group by 1)"


CHANGED = f"""
select n.request_key, n.n_rows, n.digest, o.digest as saved_digest
from {_digests('orders')} n left join {_digests(EARLIER)} o on n.request_key = o.request_key
where n.digest is distinct from o.digest"""

PAGES = f"""
numbered as (
  select {MONTH} as request_key, *, row_number() over (partition by {MONTH} order by o_orderkey) - 1 as pos
  from orders),
pages as (
  select request_key, pos // {PAGE} as page, count(*) as n_values, min(pos) as page_offset,
    min(o_orderkey) as first_id, max(o_orderkey) as last_id
  from numbered group by 1, 2)"""

NULL_SCOPED = """
scoped as (select *, case when o_orderpriority <> '1-URGENT' then o_orderpriority end as request_key from orders)"""

SAVED = f"""
saved as (
  select request_key, unnest([
    {{'kind': 'digest', 'value': digest}},
    {{'kind': 'resume_offset', 'value': cast(least(n_rows, {PAGE}) as varchar)}},
    {{'kind': 'resume_digest', 'value': digest}}]) as entry
  from {_digests(EARLIER)}),
old as (select request_key, entry.kind as kind, entry.value as value from saved)"""

REACHED = f"""
reached as (
  select n.request_key, max(page_offset + n_values) as resume_offset, any_value(digest) as resume_digest
  from pages p join {_digests('orders')} n on n.request_key = p.request_key
  where p.request_key >= '2000-01-01' group by 1),
resume as (
  select request_key, 'resume_offset' as kind, cast(resume_offset as varchar) as value from reached
  union all select request_key, 'resume_digest', resume_digest from reached)"""

LINES = """
lines as (
  select *, row_number() over () as line_no,
    case when l_returnflag <> 'R' then list_filter(
      [{'kind': 'discount', 'value': l_discount}, {'kind': 'tax', 'value': l_tax}], lambda c: c.value > 0) end as charges
  from lineitem),
charged as (select l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, unnest(charges) as charge from lines)"""

_KEY = CATALOG["ledger_posting"]
_KEY_TEXT = request_text(_KEY.path, _KEY.fields, _KEY.stable_sort_field, {"isOpen": True}).replace("'", "''")

MONTH_WINDOWS = """
spans as (
  select o_custkey, cast(min(o_orderdate) as date) as first, cast(max(o_orderdate) as date) as last from orders group by 1),
firsts as (
  select o_custkey, last,
    cast(unnest(generate_series(date_trunc('month', first), cast(last - interval 1 day as timestamp), interval 1 month)) as date)
      as period_from
  from spans where first < last),
bounds as (
  select o_custkey, period_from, cast(least(period_from + interval 1 month, last) as date) as period_to from firsts)"""

POSTING_NULLS = ", ".join(
    f"cast(null as {sql}) as {name}" for sql, names in (
        ("varchar", "description amortizationStartDate amortizationEndDate invoiceNumber termOfPayment externalRef "
                    "taxTransactionType"),
        ("bigint", "amortizationAccount_id customer_id employee_id project_id department_id vatType_id currency_id "
                   "closeGroup_id taxTransactionTypeId"),
        ("double", "amountCurrency amountGrossCurrency"),
        ("boolean", "systemGenerated"),
    ) for name in names.split()
)

ORACLE: dict[str, str] = {
    "page_scan": f"select {ORDER_FIELDS} from orders",
    "page_index": f"with {PAGES} select request_key, page_offset, n_values, first_id, last_id from pages",
    "page_index_repeated": f"""
        with n as (select l_orderkey, row_number() over (order by l_orderkey) - 1 as pos from lineitem)
        select 'lines' as request_key, min(pos) as page_offset, count(*) as n_values, min(l_orderkey) as first_id,
          max(l_orderkey) as last_id from n group by pos // {PAGE}""",
    "page_index_sparse": f"""with {PAGES}
        select request_key, page_offset, n_values, first_id * 1000003 as first_id, last_id * 1000003 as last_id from pages""",
    "null_scope_scan": f"select {ORDER_FIELDS} from orders",
    "null_scope_conditional": f"""
        with {NULL_SCOPED}
        select request_key, {ORDER_FIELDS} from scoped where o_orderpriority in (
          select o_orderpriority from orders where o_orderpriority <> '5-LOW'
          group by 1 having count(*) <> count(case when o_orderdate < timestamp '{EARLIER_RUN} 00:00:00' then 1 end))""",
    "changed_since_text": f"""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as ts_text from events where ts >= {WATERMARK}""",
    "deep_page_text": "select o_orderpriority, o_orderkey from orders order by 1, 2 limit 250 offset 1200",
    "scope_report": f"""with {PAGES} select request_key, count(*) as n_pages, cast(sum(n_values) as bigint) as n_rows,
        true as complete, true as contiguous from pages group by 1""",
    "sorted_page": f"select {ORDER_FIELDS} from orders order by o_orderkey limit 500 offset 1000",
    "deep_page": f"select {ORDER_FIELDS} from orders order by o_orderkey limit 250 offset 1200",
    "json_pages": f"select {ORDER_FIELDS} from orders",
    "entity_page_source": f"select {ORDER_FIELDS} from orders",
    "changed_since": f"select {EVENT_FIELDS} from events where ts >= {WATERMARK}",
    "changed_since_first_run": f"select {EVENT_FIELDS} from events",
    "changed_since_two_runs": f"select {EVENT_FIELDS}, case when ts < {WATERMARK} then 1 else 2 end as run from events",
    "changed_since_stream": f"select {EVENT_FIELDS} from events where ts >= {WATERMARK}",
    "watermark_format": """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as watermark,
        strftime(ts, '%Y-%m-%d %H:%M:%S') as read_back from events""",
    "param_filter": f"select {ORDER_FIELDS} from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'",
    "month_windows": f"with {MONTH_WINDOWS} select * from bounds",
    "relative_windows": """
        with spans as (select o_custkey, cast(max(o_orderdate) as date) as last from orders group by 1),
        firsts as (
          select o_custkey, last,
            cast(unnest(generate_series(date_trunc('month', last - interval 3 year), cast(last as timestamp), interval 1 month))
              as date) as period_from
          from spans)
        select o_custkey, period_from, cast(least(period_from + interval 1 month, last + interval 1 day) as date) as period_to
        from firsts""",
    "windowed_scan": """
        select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as period_from,
          cast(least(date_trunc('month', o_orderdate) + interval 1 month, timestamp '2000-09-20 00:00:00') as date) as period_to
        from orders where o_orderdate >= timestamp '1996-02-01 00:00:00' and o_orderdate < timestamp '2000-09-20 00:00:00'""",
    "year_shift": """
        select o_orderkey, cast(cast(o_orderdate as date) - interval 3 year as date) as three_back,
          cast(cast(o_orderdate as date) + interval 1 year as date) as one_ahead from orders""",
    "scope_key": f"""
        with {MONTH_WINDOWS}
        select distinct period_from, period_to,
          sha256('{_KEY_TEXT}' || '5:since10:' || period_from || '5:until10:' || period_to) as request_key
        from bounds""",
    "scope_digest": f"select * from {_digests('orders')}",
    "changed_scopes": CHANGED,
    "conditional_scan": f"""
        select {MONTH} as request_key, {ORDER_FIELDS} from orders
        where {MONTH} in (select request_key from ({CHANGED}))""",
    "page_state": f"""
        with {PAGES}, {REACHED}
        select request_key, 'digest' as kind, digest as value from {_digests('orders')}
        where request_key >= '1996-01-01' and request_key < '2000-01-01'
        union all select * from resume""",
    "commit_state": f"""
        with {SAVED},
        new as (
          select request_key, 'digest' as kind, case when n_rows >= 180 then digest end as value
          from {_digests('orders')} where request_key in (select request_key from ({CHANGED})))
        select request_key, kind, value from new
        union all
        select request_key, kind, value from old where kind = 'digest' and request_key not in (select request_key from new)""",
    "failed_state": f"""
        with {SAVED}, {PAGES}, {REACHED}
        select request_key, kind, value from old where kind = 'digest'
        union all select request_key, kind, value from old where kind <> 'digest' and request_key < '1996-01-01'
        union all select request_key, kind, value from resume""",
    "resume_position": f"""
        select n.request_key, cast(case when n.digest = o.digest then least(o.n_rows, {PAGE}) else 0 end as bigint) as start_offset
        from {_digests('orders')} n left join {_digests(EARLIER)} o on n.request_key = o.request_key""",
    "resumed_scan": f"""
        with {PAGES},
        starts as (
          select n.request_key, case when n.digest = o.digest then p.n_values else 0 end as start_offset
          from {_digests('orders')} n left join {_digests(EARLIER)} o on n.request_key = o.request_key
          join pages p on p.request_key = n.request_key and p.page_offset = 0)
        select {ORDER_FIELDS} from numbered join starts using (request_key) where pos >= start_offset""",
    "nested_projection": """
        select c_custkey as id, c_name as name, n_nationkey as nation_id, r_name as nation_region_name
        from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "flatten_orders": """
        select o_orderkey as id, o_custkey as customer_id,
          case when o_totalprice >= 250000 then o_totalprice end as total_amount,
          case when o_totalprice >= 250000 then o_orderpriority end as total_level_name,
          case when o_totalprice >= 250000 then o_orderstatus end as total_level_status
        from orders""",
    "flatten_events": """
        select event_id, user_id, cast(json_extract_string(props, '$.k') as bigint) as props_k from events""",
    "explode_list": f"""
        with {LINES} select l_orderkey, l_linenumber, l_partkey, charge.kind as charges_kind,
          charge.value as charges_amount_value, 'rate' as charges_amount_unit from charged""",
    "explode_two_lists": f"""
        with {LINES},
        flagged as (
          select *, unnest([{{'name': 'return', 'code': l_returnflag}}, {{'name': 'line', 'code': l_linestatus}}]) as flag
          from charged)
        select l_orderkey, l_linenumber, l_partkey, charge.kind as charges_kind, charge.value as charges_amount_value,
          'rate' as charges_amount_unit, flag.name as flags_name, flag.code as flags_code from flagged""",
    "list_kept": f"""
        with {LINES} select l_orderkey, l_linenumber, l_partkey, cast(len(charges) as integer) as n_charges from lines""",
    "list_projection": f"""
        with {LINES} select l_orderkey, l_linenumber, charge.value as charges_amount_value from charged""",
    "union_ragged": """
        select c_custkey as id, c_name as name, c_mktsegment as segment, cast(null as integer) as nation_id from customer
        union all select s_suppkey, s_name, null, s_nationkey from supplier""",
    "entity_customer_lite": """
        select c_custkey as id, c_name as name, c_custkey as "customerNumber", cast(null as varchar) as "organizationNumber",
          c_mktsegment as language, c_acctbal < 0 as "isInactive" from customer""",
    "entity_supplier_bank_accounts": """
        with accounts as (
          select s_suppkey as id, s_acctbal < 0 as inactive, unnest(
            case when s_acctbal > 5000 then ['NETS', 'AUTOPAY'] when s_acctbal > 0 then ['NETS'] end) as provider
          from supplier)
        select id, inactive as "isInactive", '' as "bankAccountPresentation_iban",
          id || '-' || provider as "bankAccountPresentation_bban", provider as "bankAccountPresentation_provider"
        from accounts""",
    "entity_ledger_posting": f"""
        select l_orderkey as id, l_orderkey as voucher_id, cast(cast(l_shipdate as date) as varchar) as date,
          l_suppkey as account_id, l_suppkey as supplier_id, l_partkey as product_id, l_extendedprice as amount,
          l_extendedprice as "amountGross", cast(l_linenumber as bigint) as "row", l_linestatus as type,
          l_returnflag = 'R' as matched, {POSTING_NULLS}
        from lineitem""",
    "custom_endpoint": "select event_id as id, event_type as kind, user_id from events",
    "window_counts": f"""
        select cast(date_trunc('month', o_orderdate) as date) as period_from,
          cast(least(date_trunc('month', o_orderdate) + interval 1 month, timestamp '2001-08-02 00:00:00') as date) as period_to,
          count(*) as n_rows, {_digest(_FIELDS)} as digest
        from orders where o_orderdate >= timestamp '1995-01-01 00:00:00' and o_orderdate < timestamp '2001-08-02 00:00:00'
        group by 1, 2""",
}
