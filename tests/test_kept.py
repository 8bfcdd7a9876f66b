"""What reads leave behind: found types, deltas, stored pages, versions by several writers, streams that are cut off."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.catalog import EntitySpec
from feedlake.errors import ReadError
from feedlake.functions.lattice import found_type, joined
from feedlake.operators import balances, directory, incremental, merge, paging, shape, state
from feedlake.plans.reader import FeedReader
from feedlake.sources.requests import PageResponse, ScopeRequest
from feedlake.sources.snapshot import Snapshot
from feedlake.sources.state_store import StateStore
from feedlake.sources.versions import Versions
from feedlake.spec import ReadSettings
from feedlake.streaming.changed_since import read_changes, stream_changes
from feedlake.streaming.pages import stream_pages, streamed_pages

from .conftest import rows

TYPES = (
    T.NullType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DecimalType(12, 2), T.DecimalType(38, 10), T.StringType(), T.BooleanType(),
    T.DateType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType()), T.StructType([T.StructField("a", T.LongType())]),
    T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.ArrayType(T.NullType()))]),
)


# Types


def _set(dtype):
    """A type without the order of its fields."""
    if isinstance(dtype, T.StructType):
        return frozenset((f.name, _set(f.dataType)) for f in dtype)
    return ("list", _set(dtype.elementType)) if isinstance(dtype, T.ArrayType) else dtype


def test_joining_types_does_not_depend_on_order_or_grouping():
    for a in TYPES:
        assert joined(a, a) == a and joined(a, T.NullType()) == a
        for b in TYPES:
            assert _set(joined(a, b)) == _set(joined(b, a))
            for c in TYPES:
                assert _set(joined(joined(a, b), c)) == _set(joined(a, joined(b, c))), (a, b, c)


def test_found_type(spark):
    texts = ['[{"n": 1, "d": 1, "m": 1, "o": {"x": null}, "l": []}]', '[{"d": 2.5, "m": "n/a", "o": {"x": [1]}, "l": [{"k": true}]}]', "[]", "no json", None]
    found = found_type(spark.createDataFrame([(t,) for t in texts], "body string").repartition(5), "body")
    fields = {f.name: f.dataType.simpleString() for f in found.elementType}
    assert fields == {"n": "bigint", "d": "double", "m": "string", "o": "struct<x:array<bigint>>", "l": "array<struct<k:boolean>>"}
    odd = found_type(spark.createDataFrame([('{"OBJECT<": 1, "a`b": {}}',)], "body string"), "body")
    assert odd.fieldNames() == ["OBJECT<", "a`b"]
    assert isinstance(found_type(spark.createDataFrame([], "body string"), "body"), T.NullType)


def test_record_schema_prefers_what_has_landed(spark):
    spec = EntitySpec("p", ["id", "amount", "account", "unseen", {"parts": ["n", "m"]}], False)
    found = T.StructType.fromDDL("id long, amount long, account struct<id long, number long, group struct<id long>>, parts array<struct<n string>>, other string")
    got = spec.record_schema(found)
    assert got.simpleString() == (
        "struct<id:bigint,amount:double,account:struct<id:bigint,number:bigint,group:struct<id:bigint>>,unseen:string,parts:array<struct<n:string,m:string>>>"
    )


def test_stack_widens_and_joins_parts(spark):
    a = spark.createDataFrame([(1, (1,), [1])], "n int, o struct<x int>, l array<int>")
    b = spark.createDataFrame([(2**40, None, [2**40], 1.5)], "n long, o struct<x int, y string>, l array<long>, d double")
    c = spark.createDataFrame([("t", "u", None)], "n string, o string, l array<long>")
    assert rows(shape.stack([a, b])) == [(1, (1, None), [1], None), (2**40, None, [2**40], 1.5)]
    assert rows(shape.stack([a, c])) == [("1", '{"x":1}', [1]), ("t", "u", None)]
    assert rows(shape.stack([a.limit(0), a])) == [(1, (1,), [1])]


def served(tmp_path, scopes, page=3, digest="d", log=None):
    """A source over lists of records by path, which honours ``count`` and conditions; ``scopes`` is a JSON file, so it can change."""

    def fetch(request):
        with open(scopes) as file:
            records = json.load(file)
        if log:
            with open(log, "a") as out:
                out.write(json.dumps([request.path, request.params["from"], request.params["count"]]) + "\n")
        held = records[request.path]
        if request.headers.get("If-None-Match") == held["digest"]:
            return PageResponse(304)
        start, count = request.params["from"], min(page, request.params["count"])
        if held.get("fails_at") is not None and start >= held["fails_at"] and request.params["count"] > 1:
            raise ConnectionError("gone")
        return PageResponse(200, {"values": held["values"][start : start + count], "versionDigest": held["digest"]})

    return fetch


def put(path, **scopes):
    path.write_text(json.dumps(scopes))


def test_custom_endpoint_with_lists_and_mixed_values(spark, tmp_path):
    data = tmp_path / "data.json"
    put(data, things={"digest": "d", "values": [{"id": 1, "tags": [{"k": "a", "v": 1}], "x": 5}, {"id": 2, "tags": [{"k": "b", "v": "z"}], "x": {"y": 1}}]})
    settings = ReadSettings(path="things", fields=["id", "x", {"tags": ["k", "v"]}], pagination="offset", changed_since=False, explode_columns=["tags"])
    got = FeedReader(spark, served(tmp_path, data), str(tmp_path / "feed"), settings).read()
    assert rows(got) == [(1, "5", "a", "1"), (2, '{"y":1}', "b", "z")]


# Deltas


def test_latest_rows_ties_nulls_and_copies(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (None, None, "n"), (None, 0, "m"), (2, None, "x"), (2, None, "x")], "k int, v int, t string")
    got = rows(merge.latest_rows(df, ["k"], ["v"]))
    assert got == rows(merge.latest_rows(df.orderBy(F.desc("t")).repartition(3), ["k"], ["v"]))
    assert got == [(1, 2, "c"), (2, None, "x"), (None, 0, "m")]


def test_apply_delta_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 5, "c")], "k int, v int, t string")
    new = spark.createDataFrame([(2, 2, "B"), (3, 4, "late"), (4, 1, "d"), (1, 2, None)], "k int, v int, t string")
    once = merge.apply_delta(old, new, ["k"], ["v"], F.col("t").isNull())
    assert rows(once) == [(2, 2, "B"), (3, 5, "c"), (4, 1, "d")]
    assert rows(merge.apply_delta(once, new, ["k"], ["v"], F.col("t").isNull())) == rows(once)


def test_replace_windows_with_null_and_empty_scopes(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "s string, n int")
    delta = spark.createDataFrame([(None, 30), ("c", 4), ("other", 9)], "s string, n int")
    read = spark.createDataFrame([("b",), (None,), ("c",)], "s string")
    assert rows(merge.replace_windows(old, delta, ["s"], read)) == [("a", 1), ("c", 4), (None, 30)]


SCOPED = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.IntegerType())])


def test_snapshot_by_scope(spark, tmp_path):
    kept = Snapshot(spark, str(tmp_path / "kept"), SCOPED, scope="s")
    assert rows(kept.read()) == []
    frame = lambda *r: spark.createDataFrame(list(r), SCOPED)
    scopes = lambda *s: spark.createDataFrame([(x,) for x in s], "s string")
    kept.replace(frame(("a", 1), ("b/ c", 2), (None, 3)), scopes("a", "b/ c", None), "one")
    kept.replace(frame((None, 4), ("not read", 8)), scopes("a", None, "new"), "two")
    kept.replace(frame((None, 99)), scopes(None), "two")  # the rerun of a run that is done
    assert rows(kept.read()) == [("b/ c", 2), (None, 4)]
    with pytest.raises(ValueError):
        Snapshot(spark, str(tmp_path / "x"), SCOPED)


def test_a_second_writer_builds_on_the_first(spark, tmp_path):
    root = str(tmp_path / "kept")
    frame = lambda *r: spark.createDataFrame(list(r), SCOPED)
    one, two = (Snapshot(spark, root, SCOPED, key=["s"], buckets=2) for _ in range(2))
    one.merge(frame(("a", 1), ("b", 1)), ["n"], "first")
    latest, meanwhile = two._versions.latest, []

    def slow_latest():
        found = latest()
        if not meanwhile:
            meanwhile.append(1)
            one.merge(frame(("a", 2), ("c", 1)), ["n"], "between")
        return found

    two._versions.latest = slow_latest
    two.merge(frame(("b", 5), ("a", 1)), ["n"], "last")
    assert rows(one.read()) == [("a", 2), ("b", 5), ("c", 1)]


def test_versions_go_to_one_writer(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.latest() == (0, None)
    assert versions.publish(1, {"x": "é"}) and not versions.publish(1, {"x": "other"})
    assert versions.latest() == (1, {"x": "é"})
    assert versions.commit(lambda n, now: ({"x": now["x"] * 2}, n)) == 1
    assert versions.commit(lambda n, now: (None, "nothing")) == "nothing"
    assert versions.history() == [(1, {"x": "é"}), (2, {"x": "éé"})]
    assert [p.name for p in (tmp_path / "v").iterdir() if not p.name.startswith(".")] == sorted(f"{n:012d}" for n in (1, 2)) or versions.numbers() == [1, 2]


def test_two_readers_commit_both_watermarks(spark, tmp_path):
    store, other = (StateStore(spark, str(tmp_path / "state")) for _ in range(2))
    mark = lambda key: spark.createDataFrame([(key, "digest", "d")], state.STATE_SCHEMA)
    seen = []

    def change(now):
        if not seen:
            seen.append(1)
            other.commit(lambda then: state.committed_state(then, mark("b")), "run-b")
        return state.committed_state(now, mark("a"))

    store.commit(change, "run-a")
    assert rows(store.load()) == [("a", "digest", "d"), ("b", "digest", "d")]
    assert store.runs() == ["run-b", "run-a"]


# Balances


def test_balances(spark):
    postings = spark.createDataFrame(
        [("a", dt.date(2024, 1, 5), 10), ("a", dt.date(2024, 1, 9), -4), ("a", dt.date(2024, 3, 1), 1), (None, dt.date(2024, 1, 1), 7), ("b", None, None)],
        "account string, day date, amount long",
    )
    got = rows(balances.account_balances(postings, "account", "day", "amount"))
    assert ("a", dt.date(2024, 1, 1), 2, 0, 6, 6) in got and ("a", dt.date(2024, 3, 1), 1, 6, 1, 7) in got
    assert (None, dt.date(2024, 1, 1), 1, 0, 7, 7) in got and ("b", None, 1, 0, 0, 0) in got
    after = rows(balances.running_balances(postings, "account", ["day"], "amount"), "account", "amount", "balance")
    assert after == sorted([("a", 10, 10), ("a", -4, 6), ("a", 1, 7), (None, 7, 7), ("b", None, 0)], key=repr)


# Stored pages


def test_directory_opens_the_files_of_a_page_only(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("n"))
    folder = str(tmp_path / "dir")
    directory.land_directory(df, ["k"], folder, file_rows=50)
    want = sorted((n % 100, n) for n in range(1000))
    for offset, limit in ((0, 10), (495, 30), (990, 50), (1000, 5), (20, 0)):
        page = directory.directory_page(spark, folder, df.schema, offset, limit)
        assert [tuple(r) for r in page.collect()] == want[offset : offset + limit]
        assert len(page.inputFiles()) <= 2
    assert directory.directory_size(spark, folder) == 1000
    empty = str(tmp_path / "empty")
    directory.land_directory(df.limit(0), ["k"], empty)
    assert directory.directory_size(spark, empty) == 0 and directory.directory_page(spark, empty, df.schema, 0, 5).count() == 0


def test_stored_scopes_prune_partitions(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 10).cast("string").alias("s"), "id")
    stored = incremental.land_scopes(df, "s", str(tmp_path / "s"))
    got = incremental.conditional_scan(stored, spark.createDataFrame([("3",), ("7",)], "s string"), ["s"], stored=True)
    assert got.count() == 20
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [s#" in plan and "IN (3,7)" in plan


PAGE = "request_key string, attempt int, offset long, status int, version_digest string, n_values int, values array<struct<id long>>"


def page(key, offset, ids, digest="d", status=200, attempt=1):
    return (key, attempt, offset, status, digest, None if ids is None else len(ids), None if ids is None else [(i,) for i in ids])


@pytest.mark.parametrize(
    "broken", [[page("a", 0, [1]), page("a", 1, None, status=0)], [page("a", 0, [1])], [page("a", 0, [1]), page("a", 2, [3]), page("a", 3, [])], [page(None, 0, [1])]]
)
def test_a_short_log_is_refused_unless_asked_for(spark, broken):
    log = spark.createDataFrame([page("b", 0, [9]), page("b", 1, []), page("c", 0, [], status=304), *broken], PAGE)
    with pytest.raises(ReadError, match="not whole"):
        paging.scan_pages(log)
    want = sorted(i[0] for p in broken if p[6] for i in p[6]) + [9]
    assert sorted(r["id"] for r in paging.scan_pages(log, partial=True).collect()) == sorted(want)


def test_whole_scopes_of_several_runs(spark):
    runs = [
        [page("a", 0, [1, 2]), page("a", 2, [3]), page("a", 3, None, status=0), page("b", 0, [7], "old"), page("c", 0, [5]), page("c", 1, [])],
        [page("a", 3, [4]), page("a", 4, None, status=0), page("b", 0, [8], "new"), page("c", 0, [], status=304)],
        [page("a", 4, [5]), page("a", 5, []), page("b", 1, [9], "new"), page("b", 2, [], "new"), page(None, 0, [6]), page(None, 1, [])],
    ]
    log = spark.createDataFrame([(*p, k) for k, run in enumerate(runs) for p in run], PAGE + ", run int")
    whole = paging.whole_scopes(log)
    assert rows(paging.scan_pages(whole), "request_key", "id") == sorted(
        [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("a", 5), ("b", 8), ("b", 9), ("c", 5), (None, 6)], key=repr
    )


def test_reader_gives_whole_scopes_after_a_resume(spark, tmp_path):
    data = tmp_path / "data.json"
    values = [{"id": n, "name": "x"} for n in range(10)]
    put(data, department={"digest": "d", "values": values, "fails_at": 6})
    reader = FeedReader(spark, served(tmp_path, data), str(tmp_path / "feed"), ReadSettings(entity="department"))
    with pytest.raises(ReadError):
        reader.whole()
    with pytest.raises(Exception, match="gone"):
        reader.read()
    assert reader.whole().count() == 0
    put(data, department={"digest": "d", "values": values})
    assert reader.read().count() == 4
    assert sorted(r["id"] for r in reader.whole().collect()) == list(range(10))


# Streams


def test_a_batch_that_fails_half_way_is_run_again_for_its_interval(spark, tmp_path):
    frame = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 5)), (3, None), (4, dt.datetime(2024, 1, 9))], "id int, ts timestamp")
    out, broken = str(tmp_path / "out"), []

    def load():
        if not broken:
            broken.append(1)
            raise RuntimeError("broken load")
        return frame

    with pytest.raises(Exception, match="broken load"):
        stream_changes(spark, load, "ts", out, str(tmp_path / "one"), until="2024-01-03T00:00:00Z").awaitTermination()
    assert rows(read_changes(spark, out, frame.schema)) == []
    stream_changes(spark, load, "ts", out, str(tmp_path / "two"), until="2024-01-07T00:00:00Z").awaitTermination()
    assert sorted(r["id"] for r in read_changes(spark, out, frame.schema).collect()) == [1, 2, 3]
    intervals = [(c["since"], c["until"]) for _, c in Versions(spark, f"{out}/_intervals").history() if c["closed"]]
    assert intervals == [(None, "2024-01-03T00:00:00Z"), ("2024-01-03T00:00:00Z", "2024-01-07T00:00:00Z")]
    for folder in ("two", "three"):
        stream_changes(spark, load, "ts", out, str(tmp_path / folder), until="2024-02-01T00:00:00Z").awaitTermination()
    assert sorted(r["id"] for r in read_changes(spark, out, frame.schema).collect()) == [1, 2, 3, 4]


def test_page_stream_goes_on_after_a_kill_and_reads_nothing_twice(spark, tmp_path):
    data, log = tmp_path / "data.json", str(tmp_path / "requests")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    records = lambda *ids: [{"id": n} for n in ids]
    scopes = [ScopeRequest(k, k, {}, 3) for k in "abce"] + [ScopeRequest("d", "d", {}, 3, stored_digest="d")]

    def run():
        open(log, "w").close()
        stream_pages(spark, served(tmp_path, data, log=log), scopes, out, checkpoint, task_rows=4).awaitTermination()
        with open(log) as noted:
            return [json.loads(line) for line in noted]

    still = {"d": {"digest": "d", "values": records(0)}, "e": {"digest": "e", "values": []}}
    put(data, a={"digest": "a", "values": records(*range(10))}, b={"digest": "b", "values": records(20, 21)}, c={"digest": "c1", "values": records(30, 35), "fails_at": 0}, **still)
    with pytest.raises(Exception, match="gone"):
        run()
    put(data, a={"digest": "a", "values": records(*range(10))}, b={"digest": "b", "values": records(20, 21)}, c={"digest": "c1", "values": records(30, 35)}, **still)
    run()

    def found():
        pages = streamed_pages(spark, out)
        values = F.from_json("body", "array<struct<id long>>")
        return sorted(r["id"] for r in paging.scan_pages(paging.whole_scopes(pages.withColumn("values", values)), {"id": ("id",)}).collect())

    assert found() == [*range(10), 20, 21, 30, 35]
    put(data, a={"digest": "a", "values": records(*range(12))}, b={"digest": "b", "values": records(20, 21)}, c={"digest": "c2", "values": records(31, 32)}, **still)
    requests = run()
    assert ["a", 10, 2] in requests and not [r for r in requests if r[0] in ("b", "d") and r[2] > 1]
    assert found() == [*range(12), 20, 21, 31, 32]
