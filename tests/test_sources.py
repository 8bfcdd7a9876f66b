"""The changed-since stream and the replay of landed pages."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators import paging
from feedlake.session import scratch_dir
from feedlake.sources.page_log import read_page_log
from feedlake.sources.page_source import decode_pages, read_pages
from feedlake.sources.replay import ReplayFetch, land_pages, replay_scopes
from feedlake.sources.requests import PageRequest, PageResponse, ScopeRequest
from feedlake.streaming.changed_since import stream_changes
from feedlake.streaming.pages import PageStreamReader

from .conftest import rows


def test_stream_lands_each_interval_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("source", "out", "checkpoint"))

    def add(*seconds):
        data = [(dt.datetime(2024, 1, 1, 0, 0, s), s) for s in seconds]
        spark.createDataFrame(data, "ts timestamp_ntz, n long").write.mode("append").parquet(source)

    def run(until, since=None):
        query = stream_changes(spark, lambda: spark.read.parquet(source), "ts", out, checkpoint, since, until)
        query.awaitTermination()
        assert query.exception() is None
        return [r["n"] for r in spark.read.parquet(out).orderBy("n").collect()]

    add(1, 2, 3, 9)
    assert run("2024-01-01T00:00:05Z", since="2024-01-01T00:00:02Z") == [2, 3]
    assert run("2024-01-01T00:00:05Z") == [2, 3]
    add(5, 6)
    assert run("2024-01-01T00:00:10Z") == [2, 3, 5, 6, 9]


def test_stream_without_a_first_watermark_reads_everything(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("source", "out", "checkpoint"))
    spark.createDataFrame([(dt.datetime(1999, 1, 1), 1)], "ts timestamp_ntz, n long").write.parquet(source)
    stream_changes(spark, lambda: spark.read.parquet(source), "ts", out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_read_page_log_narrow_and_filled(spark, tmp_path):
    lines = [
        '{"request_key":"k","offset":0,"values":[{"id":1,"name":"a","account":{"id":5,"x":1}},{"id":2}]}',
        '{"request_key":"k","offset":2,"status":304}',
        '{"request_key":"bad","offset":0,"values":7}',
    ]
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "pages.json").write_text("\n".join(lines[:2]))
    record = T.StructType.fromDDL("id long, account struct<id long>")
    log = read_page_log(spark, str(tmp_path / "log"), record, "json")
    assert rows(log, "attempt", "offset", "status", "n_values") == [(1, 0, 200, 2), (1, 2, 304, 0)]
    assert rows(paging.scan_pages(log, {"id": ("id",), "account_id": ("account", "id")})) == [(1, 5), (2, None)]
    (tmp_path / "log" / "bad.json").write_text(lines[2])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_page_log(spark, str(tmp_path / "log"), record, "json").collect()


def test_replay_gives_back_the_landed_rows(spark, tmp_path):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("s"), "id", F.col("id").cast("string").alias("v"))
    log = spark.createDataFrame(paging.cut_pages(df, "s", "id", 7).collect(), paging.cut_pages(df, "s", "id", 7).schema)
    root = str(tmp_path / "pages")
    land_pages(log, root)
    scopes = replay_scopes(log, least_rows=100)
    assert len(scopes) > 4  # large scopes are split at page boundaries
    raw = read_pages(spark, ReplayFetch(root), scopes, "replay_test", max_tasks=3)
    got = paging.scan_pages(decode_pages(raw, log.schema["values"].dataType.elementType))
    assert rows(got.select("request_key", "id", "v")) == rows(df)


def test_a_single_row_is_found_in_one_row_group_of_a_long_scope(spark, tmp_path):
    import pyarrow.dataset as ds

    df = spark.range(60_000).select(F.lit("a").alias("s"), "id", F.sha2(F.col("id").cast("string"), 512).alias("v"))
    root = str(tmp_path / "pages")
    land_pages(paging.cut_pages(df, "s", "id", 10), root)
    fetch = ReplayFetch(root)
    for at in (0, 29_999, 59_999, 60_000, 70_000):
        values = fetch(PageRequest("a", {"from": at, "count": 1}, {})).body["values"]
        assert [v["id"] for v in values] == [at] * (at < 60_000)
    first, after, n = (ds.field(name) for name in ("offset", "after", "n_values"))
    held = fetch._folder("a")
    groups = lambda where: sum(len(f.split_by_row_group(where)) for f in held.get_fragments())
    assert groups(None) > 4
    assert groups((first <= 29_999) & ((after > 29_999) | (n == 0))) <= 2  # its own, and the one that holds the end


def test_an_unchanged_scope_is_asked_where_it_ended_last():
    rows, asked = {"a": 700, "b": 90, "c": 0}, []

    def fetch(request):
        at, count = request.params["from"], request.params["count"]
        asked.append(request.path)
        return PageResponse(body={"values": [{}] * max(0, min(count, rows[request.path] - at)), "versionDigest": digests[request.path]})

    digests = {"a": "1", "b": "1", "c": "1"}
    reader = PageStreamReader(fetch, [ScopeRequest(k, k, {}, 50) for k in rows], 100)
    assert reader.latestOffset() == {"a": [700, "1"], "b": [90, "1"], "c": [0, "1"]}
    asked.clear()
    assert reader.latestOffset() == {"a": [700, "1"], "b": [90, "1"], "c": [0, "1"]}
    assert len(asked) == 3 + 3 + 1
    rows.update(a=1003, b=91, c=4)
    assert reader.latestOffset() == {"a": [1003, "1"], "b": [91, "1"], "c": [4, "1"]}
    rows.update(a=20, b=60)
    digests.update(a="2")
    assert reader.latestOffset() == {"a": [20, "2"], "b": [60, "1"], "c": [4, "1"]}


def test_a_cluster_session_must_name_its_scratch_folder():
    local = SimpleNamespace(conf=SimpleNamespace(get={"spark.master": "local[2]"}.get))
    cluster = SimpleNamespace(conf=SimpleNamespace(get={"spark.master": "yarn"}.get))
    named = SimpleNamespace(conf=SimpleNamespace(get={"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:/x/"}.get))
    assert scratch_dir(local, "t") != scratch_dir(local, "t")
    assert scratch_dir(named, "t").startswith("hdfs:/x/t-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(cluster, "t")
