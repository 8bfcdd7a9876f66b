"""Paged scans, page cutting, offsets and sorting."""

import random

import pytest
from pyspark.sql import functions as F

from feedlake.errors import ReadError
from feedlake.operators import paging

from .conftest import rows

LOG = ("request_key string, attempt int, offset long, status int, version_digest string, n_values int, "
       "values array<struct<id long, account struct<id long, name string>>>")


def page(key, offset, ids, status=200, attempt=1, digest="d1"):
    values = None if status == 304 else [(i, (i * 10, f"n{i}")) for i in ids]
    return (key, attempt, offset, status, digest, len(ids), values)


def scan(spark, *pages, **kwargs):
    return [row[1] for row in rows(paging.scan_pages(spark.createDataFrame(list(pages), LOG), **kwargs).select("request_key", "id"))]


def test_scan_stops_at_the_first_empty_page_only(spark):
    got = scan(spark, page("k", 0, [1, 2, 3]), page("k", 3, [4, 5]), page("k", 5, []), page("k", 9, [99]))
    assert got == [1, 2, 3, 4, 5]


def test_scan_of_an_unfinished_scope_keeps_what_has_landed(spark):
    assert scan(spark, page("k", 0, [1]), page("k", 1, [2]), partial=True) == [1, 2]


def test_scan_empty_and_not_modified_scopes(spark):
    log = spark.createDataFrame([page("a", 0, []), page("b", 0, [], 304), page("c", 0, [7]), page("c", 1, [], 304)], LOG)
    got = paging.scan_pages(log)
    assert rows(got) == [("c", 7, (70, "n7"))]
    assert paging.scan_pages(log.where("request_key = 'a'")).schema == got.schema


def test_scan_reads_only_the_latest_attempt(spark):
    pages = [page("k", 0, [1, 2]), page("k", 2, [3]), page("k", 0, [8], attempt=2), page("k", 1, [], attempt=2)]
    assert scan(spark, *pages) == [8]


def test_scan_does_not_mix_scopes(spark):
    got = scan(spark, page("a", 0, [1]), page("a", 1, []), page("b", 0, [5]), page("b", 1, [6]), page("b", 2, []))
    assert got == [1, 5, 6]


def test_resumed_scan(spark):
    starts = spark.createDataFrame([("a", 2)], "request_key string, start_offset long")
    got = scan(spark, page("a", 0, [1, 2]), page("a", 2, [3]), page("a", 3, []), page("b", 0, [9]), starts=starts, partial=True)
    assert got == [3, 9]


def test_scan_of_fields_reads_only_those_leaves(spark, tmp_path):
    spark.createDataFrame([page("k", 0, [1, 2]), page("k", 2, [])], LOG).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    got = paging.scan_pages(log, {"id": ("id",), "account_id": ("account", "id")})
    assert rows(got) == [(1, 10), (2, 20)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "values:array<struct<id:bigint,account:struct<id:bigint>>>" in plan


def report(spark, *pages):
    got = paging.scope_report(spark.createDataFrame(list(pages), LOG))
    return {r["request_key"]: (r["n_rows"], r["complete"], r["contiguous"], r["one_digest"]) for r in got.collect()}


def test_scope_report(spark):
    got = report(
        spark,
        page("good", 0, [1, 2]), page("good", 2, [3]), page("good", 3, []),
        page("open", 0, [1, 2]), page("open", 2, [3]),
        page("gap", 0, [1]), page("gap", 2, [3]), page("gap", 3, []),
        page("overlap", 0, [1, 2]), page("overlap", 1, [2]), page("overlap", 2, []),
        page("double", 0, [1]), page("double", 0, [1]), page("double", 1, []),
        page("late", 1, [2]), page("late", 2, []),
        page("mixed", 0, [1]), page("mixed", 1, [2], digest="d2"), page("mixed", 2, []),
        page("empty", 0, []), page("same", 0, [], 304),
    )
    assert got == {
        "good": (3, True, True, True), "open": (3, False, False, True), "gap": (2, True, False, True),
        "overlap": (3, True, False, True), "double": (2, True, False, True), "late": (1, True, False, True),
        "mixed": (2, True, True, False), "empty": (0, True, True, True), "same": (0, True, True, True),
    }


def test_running_total(spark):
    data = [("a", i, i % 5) for i in range(50)] + [("b", 3, 7), ("b", 100, 1)]
    df = spark.createDataFrame(data, "s string, p long, v long")
    got = {(r["s"], r["p"]): r["before"] for r in paging.running_total(df, ["s"], "p", "v", "before", fan=8).collect()}
    assert got == {(s, p): sum(v for t, q, v in data if t == s and q < p) for s, p, _ in data}


def check_log(log, data, page_size):
    """Every row once, offsets gap-free, pages bounded and closed."""
    pages = sorted((tuple(r) for r in log.select("request_key", "offset", "n_values").collect()))
    want = {}
    for scope, *_ in data:
        want[scope] = want.get(scope, 0) + 1
    for scope, total in want.items():
        offset = 0
        for _, start, n in [p for p in pages if p[0] == scope]:
            assert start == offset and n <= page_size
            offset += n
        assert offset == total and pages[[p[:2] for p in pages].index((scope, total))][2] == 0
    assert rows(paging.scan_pages(log)) == sorted(data, key=repr)


def test_cut_pages_property(spark):
    rng = random.Random(7)
    for page_size in (1, 4, 7):
        data = [(rng.choice("aab"), key, f"v{key}") for key in rng.sample(range(-50, 200), 120)]
        df = spark.createDataFrame(data, "s string, id long, v string")
        log = paging.cut_pages(df, "s", "id", page_size)
        check_log(log, data, page_size)
        firsts = log.where("n_values > 0").select("request_key", "offset", F.get("values", F.lit(0))["id"].alias("id")).collect()
        ordered = sorted(firsts, key=lambda r: (r["request_key"], r["offset"]))
        assert all(a["id"] < b["id"] for a, b in zip(ordered, ordered[1:]) if a["request_key"] == b["request_key"])


def test_cut_pages_with_a_repeated_key_and_missing_keys(spark):
    data = [("a", 5, f"v{i}") for i in range(60)] + [("a", 77, "copy")] * 40 + [("a", None, f"n{i}") for i in range(30)] + [("b", 1, "x")]
    df = spark.createDataFrame(data, "s string, id long, v string")
    check_log(paging.cut_pages(df, "s", "id", 6), data, 6)


def test_cut_pages_spreads_a_large_scope(spark):
    df = spark.range(4000).select(F.lit("only").alias("s"), "id")
    log = paging.cut_pages(df, "s", "id", 50)
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert log.where("n_values > 0").count() == 80


def test_cut_pages_in_key_order_with_copies_null_scope_and_text_keys(spark):
    data = [(scope, f"k{i % 30:02d}") for scope in ("a", None) for i in range(100)]
    log = paging.cut_pages(spark.createDataFrame(data, "s string, id string").repartition(5), "s", "id", 10)
    for scope in ("a", None):
        pages = log.where(F.col("request_key").eqNullSafe(F.lit(scope))).orderBy("offset").collect()
        assert [(p["offset"], p["n_values"]) for p in pages] == [(k * 10, 10) for k in range(10)] + [(100, 0)]
        assert [v["id"] for p in pages for v in p["values"]] == sorted(key for s, key in data if s == scope)
    assert paging.scan_pages(log).count() == 200


@pytest.mark.parametrize("key", ["id", "text"])
def test_deep_page_of_a_hot_key_is_not_one_task(spark, key):
    df = spark.range(0, 3000, 1, 6).select(F.lit(7).alias("id"), F.lit("x").alias("text"), F.col("id").alias("n"))
    page = paging.offset_page(df, key, 2000, 20, seek_beyond=500)
    assert [r["n"] for r in page.collect()] == list(range(2000, 2020))
    assert "TakeOrdered" not in page._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seek_beyond", [0, 10**6])
@pytest.mark.parametrize(("offset", "limit"), [(0, 3), (7, 60), (90, 30), (100, 5)])
def test_offset_page(spark, offset, limit, seek_beyond):
    ids = [i * i - 500 for i in range(100)]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = [r["id"] for r in paging.offset_page(df, "id", offset, limit, seek_beyond).collect()]
    assert sorted(got) == sorted(ids)[offset:offset + limit]


def test_offset_page_with_repeats_and_nulls(spark):
    ids = [1, 1, 1, 2, 2, 5000, 5000, 10**12]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    for offset in (0, 2, 4, 7):
        assert [r["id"] for r in paging.offset_page(df, "id", offset, 2, 0).collect()] == ids[offset:offset + 2]
    nulls = spark.createDataFrame([(None,), (3,), (None,)], "id long")
    assert [r["id"] for r in paging.offset_page(nulls, "id", 1, 2, 0).collect()] == [None, 3]


def test_stable_sort(spark):
    df = spark.createDataFrame([((2,),), ((1,),)], "account struct<id long>")
    assert [r["account"]["id"] for r in paging.stable_sort(df, "account.id").collect()] == [1, 2]
    assert paging.stable_sort(df, None) is df and paging.stable_sort(df, "") is df
    with pytest.raises(ReadError, match="nope"):
        paging.stable_sort(df, "nope")


def test_whole_records_are_exploded_without_zipping_their_leaves(spark, capsys):
    schema = "request_key string, attempt int, offset long, status int, version_digest string, n_values int, values array<struct<id:long,account:struct<id:long>,tags:array<string>>>"
    values = [(1, (5,), ["a", "b"]), (2, None, None), None, (3, (None,), [])]
    log = spark.createDataFrame([("k", 1, 0, 200, None, 4, values), ("k", 1, 4, 200, None, 0, [])], schema)
    leaves = {"id": ("id",), "account_id": ("account", "id"), "tags": ("tags",)}
    whole = paging.scan_pages(log, leaves)
    whole.explain()
    assert "arrays_zip" not in capsys.readouterr().out
    assert rows(whole) == sorted([(1, 5, ["a", "b"]), (2, None, None), (None, None, None), (3, None, [])], key=repr)
    some = paging.scan_pages(log, {"account_id": ("account", "id")})
    some.explain()
    assert "arrays_zip" in capsys.readouterr().out  # other leaves are not read
    assert rows(some) == rows(whole, "account_id")
