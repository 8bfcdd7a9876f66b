"""Whole reads against scripted sources: requests sent, rows returned, state left behind."""

import datetime as dt
import json
import re

import pytest

from feedlake.catalog import CATALOG
from feedlake.errors import AuthenticationError, AuthorizationError, ReadError, SourceConnectionError
from feedlake.functions.keys import scope_key
from feedlake.operators.state import STATE_SCHEMA
from feedlake.plans.reader import FeedReader
from feedlake.sources.requests import PageResponse
from feedlake.sources.state_store import StateStore
from feedlake.spec import ReadSettings

from .conftest import rows

DEPARTMENT = CATALOG["department"]
KEY = scope_key(DEPARTMENT.path, DEPARTMENT.fields, "id")


def scripted(tmp_path, answers):
    """A source that gives its answers in order, within one task, and notes every request in a file."""
    log = str(tmp_path / f"requests-{len(list(tmp_path.iterdir()))}.jsonl")
    open(log, "w").close()

    def fetch(request):
        with open(log, "a") as out:
            out.write(json.dumps({"path": request.path, "params": request.params, "headers": request.headers}) + "\n")
        with open(log) as done:
            n = sum(1 for _ in done)
        if n > len(answers):
            raise ConnectionError("no more answers")
        answer = answers[n - 1]
        if isinstance(answer, Exception):
            raise answer
        return answer

    def requests():
        with open(log) as noted:
            return [json.loads(line) for line in noted]

    return fetch, requests


def answer(ids=(), digest="d1", status=200, **more):
    return PageResponse(status, {"values": [{"id": i, **more} for i in ids], "versionDigest": digest})


def make(spark, tmp_path, answers, state=(), entity="department", **settings):
    fetch, requests = scripted(tmp_path, answers)
    root = str(tmp_path / "feed")
    if state:
        StateStore(spark, f"{root}/state").publish(spark.createDataFrame(list(state), STATE_SCHEMA), "before")
    return FeedReader(spark, fetch, root, ReadSettings(entity=entity, **settings), max_tasks=1), requests


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_full_load_and_its_requests(spark, tmp_path):
    reader, requests = make(spark, tmp_path, [answer([1, 2, 3]), answer([4, 5]), answer()], count=10)
    assert ids(reader.read()) == [1, 2, 3, 4, 5]
    assert [r["params"]["from"] for r in requests()] == [0, 3, 5]
    assert all(r["headers"] == {"If-None-Match": "magic-value"} for r in requests())
    assert all(r["params"]["count"] == 10 and r["params"]["sorting"] == "id" for r in requests())
    assert requests()[0]["params"]["fields"] == "id,name,departmentNumber,departmentManager(id),displayName,isInactive"
    assert rows(reader.state) == [(KEY, "digest", "d1")]


def test_output_is_flat_and_typed(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1], name="A", departmentManager={"id": 7}), answer()])
    got = reader.read()
    assert got.columns == ["id", "name", "departmentNumber", "displayName", "isInactive", "departmentManager_id"]
    assert rows(got) == [(1, "A", None, None, None, 7)]


def test_empty_result_is_typed(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer()])
    got = reader.read()
    assert got.count() == 0 and got.schema["departmentManager_id"].dataType.simpleString() == "bigint"


def test_stored_digest_is_sent_and_304_changes_nothing(spark, tmp_path):
    before = [(KEY, "digest", "d1"), ("other", "digest", "x"), ("stray", "resume_offset", "5")]
    reader, requests = make(spark, tmp_path, [answer(status=304)], before)
    assert ids(reader.read()) == []
    assert [r["headers"]["If-None-Match"] for r in requests()] == ["d1"]
    assert rows(reader.state) == sorted([(KEY, "digest", "d1"), ("other", "digest", "x")], key=repr)


def test_changed_scope_replaces_its_digest(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1], "d2"), answer((), "d2")], [(KEY, "digest", "d1"), ("other", "digest", "x")])
    assert ids(reader.read()) == [1]
    assert rows(reader.state) == sorted([(KEY, "digest", "d2"), ("other", "digest", "x")], key=repr)


def test_null_digest_is_never_current(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1], None), answer((), None)], [(KEY, "digest", "d1")])
    reader.read()
    assert rows(reader.state) == [(KEY, "digest", None)]
    again, requests = make(spark, tmp_path, [answer([1], None), answer((), None)])
    again.read()
    assert requests()[0]["headers"] == {"If-None-Match": "magic-value"}


def test_failure_keeps_rows_watermarks_and_a_resume_position(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1]), RuntimeError("broken")], [(KEY, "digest", "stale")], count=1)
    with pytest.raises(ReadError, match="broken") as caught:
        reader.read()
    assert caught.value.details["entity"] == "department" and caught.value.details["path"] == "department"
    assert ids(reader.output) == [1]
    assert rows(reader.state) == sorted(
        [(KEY, "digest", "stale"), (KEY, "resume_offset", "1"), (KEY, "resume_digest", "d1")], key=repr)


def test_failure_without_digest_leaves_no_resume_position(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1], None), RuntimeError("broken")])
    with pytest.raises(ReadError):
        reader.read()
    assert rows(reader.state) == []


@pytest.mark.parametrize("error", [AuthenticationError("no"), AuthorizationError("no"), SourceConnectionError("no")])
def test_some_failures_keep_their_type(spark, tmp_path, error):
    reader, _ = make(spark, tmp_path, [error])
    with pytest.raises(type(error), match="no"):
        reader.read()


def test_running_out_of_answers_is_a_connection_error(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1])])
    with pytest.raises(SourceConnectionError):
        reader.read()


RESUME = [(KEY, "resume_offset", "2"), (KEY, "resume_digest", "d1"), (KEY, "digest", "d1")]


def test_verified_resume_goes_on(spark, tmp_path):
    reader, requests = make(spark, tmp_path, [answer([3]), answer()], RESUME, count=1)
    assert ids(reader.read()) == [3]
    assert [r["params"]["from"] for r in requests()] == [2, 3]
    assert requests()[0]["headers"] == {"If-None-Match": "magic-value"}
    assert rows(reader.state) == [(KEY, "digest", "d1")]


def test_resume_with_another_digest_starts_over(spark, tmp_path):
    answers = [answer([99], "d2"), answer([1], "d2"), answer([99], "d2"), answer((), "d2")]
    reader, requests = make(spark, tmp_path, answers, RESUME, count=1)
    assert ids(reader.read()) == [1, 99]
    assert [r["params"]["from"] for r in requests()] == [2, 0, 1, 2]
    assert rows(reader.state) == [(KEY, "digest", "d2")]


def test_fail_then_resume_covers_everything(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1, 2]), answer([3]), RuntimeError("x")])
    with pytest.raises(ReadError):
        reader.read()
    first = ids(reader.output)
    again, requests = make(spark, tmp_path, [answer([4]), answer()])
    assert sorted(first + ids(again.read())) == [1, 2, 3, 4]
    assert [r["params"]["from"] for r in requests()] == [3, 4]


CUSTOMER = CATALOG["customer_lite"]
CUSTOMER_KEY = scope_key(CUSTOMER.path, CUSTOMER.fields, "id")


def test_changed_since_first_run_and_watermark(spark, tmp_path):
    begun = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    reader, requests = make(spark, tmp_path, [answer([1]), answer()], entity="customer_lite", params={"foo": "bar"})
    reader.read()
    assert all("changedSince" not in r["params"] and r["headers"] == {} for r in requests())
    assert all(r["params"]["foo"] == "bar" and r["params"]["sorting"] == "id" for r in requests())
    ((_, kind, mark),) = rows(reader.state)
    assert kind == "changed_since" and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", mark) and mark >= begun


def test_changed_since_sends_the_watermark_and_ignores_positions(spark, tmp_path):
    before = [(CUSTOMER_KEY, "changed_since", "2024-01-01T00:00:00Z"), (CUSTOMER_KEY, "resume_offset", "2")]
    reader, requests = make(spark, tmp_path, [answer([3]), answer()], before, entity="customer_lite", count=1)
    assert ids(reader.read()) == [3]
    assert [(r["params"]["from"], r["params"]["changedSince"]) for r in requests()] == [
        (0, "2024-01-01T00:00:00Z"), (1, "2024-01-01T00:00:00Z")]
    assert len(rows(reader.state)) == 1 and rows(reader.state)[0][2] > "2024-01-01T00:00:00Z"


def test_changed_since_failure_is_not_resumable(spark, tmp_path):
    before = [("stale", "changed_since", "2020-01-01T00:00:00Z")]
    reader, _ = make(spark, tmp_path, [answer([1]), RuntimeError("x")], before, entity="customer_lite")
    with pytest.raises(ReadError):
        reader.read()
    assert rows(reader.state) == before


POSTING = CATALOG["ledger_posting"]
AS_OF = dt.date(2024, 2, 10)


def posting_key(start, stop):
    return scope_key(POSTING.path, POSTING.fields, "id", None, (start, stop))


def windowed(spark, tmp_path, answers, state=(), **settings):
    return make(spark, tmp_path, answers, state, entity="ledger_posting", as_of=AS_OF, date_from="0", **settings)


def test_one_window_up_to_and_including_today(spark, tmp_path):
    reader, requests = windowed(spark, tmp_path, [answer([1], account={"id": 5}), answer()], params={"x": 1})
    assert ids(reader.read()) == [1]
    assert [(r["params"]["dateFrom"], r["params"]["dateTo"], r["params"]["x"]) for r in requests()] == [
        ("2024-02-01", "2024-02-11", 1)] * 2


def custom_windows(spark, tmp_path, fetch, state=()):
    root = str(tmp_path / "feed")
    if state:
        StateStore(spark, f"{root}/state").publish(spark.createDataFrame(list(state), STATE_SCHEMA), "before")
    settings = ReadSettings(path="p", fields=["id"], pagination="date_window", changed_since=False, as_of=AS_OF, date_from="1")
    return FeedReader(spark, fetch, root, settings, max_tasks=4)


def window_key(start, stop):
    return scope_key("p", ["id"], "id", None, (start, stop))


def by_window(plan):
    """Pages per window start, one id per page; an exception in the list is raised."""
    def fetch(request):
        digest = plan.get(request.params["dateFrom"], [])
        if request.headers["If-None-Match"] == "same":
            return PageResponse(304)
        n = request.params["from"]
        if n < len(digest):
            if digest[n] is None:
                raise RuntimeError("window failed")
            return PageResponse(200, {"values": [{"id": digest[n]}], "versionDigest": "w" + request.params["dateFrom"]})
        return PageResponse(200, {"values": [], "versionDigest": "w" + request.params["dateFrom"]})

    return fetch


def test_windows_are_separate_scopes(spark, tmp_path):
    plan = {"2023-02-01": [1, 2], "2023-05-01": [3], "2024-02-01": [4]}
    reader = custom_windows(spark, tmp_path, by_window(plan), [(window_key("2023-02-01", "2023-03-01"), "digest", "same")])
    assert ids(reader.read()) == [3, 4]
    state = {key: value for key, kind, value in rows(reader.state)}
    assert len(state) == 13
    assert state[window_key("2023-02-01", "2023-03-01")] == "same"
    assert state[window_key("2024-02-01", "2024-02-11")] == "w2024-02-01"


def test_a_failing_window_commits_no_window(spark, tmp_path):
    reader = custom_windows(spark, tmp_path, by_window({"2023-02-01": [1], "2023-05-01": [3, None]}))
    with pytest.raises(ReadError, match="window failed"):
        reader.read()
    key = window_key("2023-05-01", "2023-06-01")
    assert rows(reader.state) == sorted([(key, "resume_offset", "1"), (key, "resume_digest", "w2023-05-01")], key=repr)
    assert ids(reader.output) == [1, 3]


def bank(spark, tmp_path, *records):
    page = PageResponse(200, {"values": list(records), "versionDigest": "brand-new"})
    return make(spark, tmp_path, [page, PageResponse(200, {"values": []})], entity="supplier_bank_accounts_lite")


def test_exploding_entity(spark, tmp_path):
    two = [{"iban": "", "bban": "111", "provider": "AUTOPAY"}, {"iban": "NO123", "bban": "222", "provider": "NETS"}]
    reader, _ = bank(spark, tmp_path, {"id": 1, "isInactive": False, "bankAccountPresentation": two},
                     {"id": 2, "isInactive": False, "bankAccountPresentation": []}, {"id": 3})
    got = reader.read()
    assert got.columns == ["id", "isInactive", "bankAccountPresentation_iban", "bankAccountPresentation_bban",
                           "bankAccountPresentation_provider"]
    assert rows(got) == [(1, False, "", "111", "AUTOPAY"), (1, False, "NO123", "222", "NETS")]


@pytest.mark.parametrize("value", [0, "not-a-list"])
def test_bad_records_commit_nothing(spark, tmp_path, value):
    reader, _ = bank(spark, tmp_path, {"id": 1, "isInactive": False, "bankAccountPresentation": value})
    with pytest.raises(ReadError, match="could not be turned into rows"):
        reader.read()
    assert rows(reader.state) == []


def test_wide_lists_stay_whole_in_the_full_entity(spark, tmp_path):
    record = {"id": 1, "bankAccountPresentation": [{"iban": "x", "country": {"id": 4}}]}
    page = PageResponse(200, {"values": [record]})
    reader, _ = make(spark, tmp_path, [page, answer()], entity="supplier")
    row = reader.read().first()
    assert row["bankAccountPresentation"][0].asDict(recursive=True) == {
        "iban": "x", "bban": None, "bic": None, "country": {"id": 4}, "provider": None}


def test_refused_settings_send_no_request(spark, tmp_path):
    reader, requests = make(spark, tmp_path, [], params={"from": 1})
    with pytest.raises(ReadError, match="from"):
        reader.read()
    assert requests() == []


def test_separator(spark, tmp_path):
    reader, _ = make(spark, tmp_path, [answer([1], departmentManager={"id": 7}), answer()], sep="__")
    assert "departmentManager__id" in reader.read().columns


@pytest.mark.parametrize("status, error", [(401, AuthenticationError), (403, AuthorizationError), (404, ReadError), (503, SourceConnectionError)])
def test_error_status_fails_the_read(spark, tmp_path, status, error):
    reader, _ = make(spark, tmp_path, [PageResponse(status, {"message": "sorry"})], [(KEY, "digest", "kept")])
    with pytest.raises(error, match=str(status)):
        reader.read()
    assert (KEY, "digest", "kept") in rows(reader.state)


def test_state_stays_when_rows_of_a_failed_read_cannot_be_shaped(spark, tmp_path):
    before = [(KEY, "digest", "kept")]
    reader, _ = make(spark, tmp_path, [answer([1], departmentManager=[5]), RuntimeError("late")], before, count=1)
    with pytest.raises(ReadError, match="could not be turned into rows"):
        reader.read()
    assert rows(reader.state) == before
