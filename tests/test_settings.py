"""Catalogue and setting checks."""

import pytest
from pyspark.sql import types as T

from feedlake.catalog import CATALOG, Pagination, derive_schema, entity_from_metadata
from feedlake.errors import ReadError, ValidationError
from feedlake.functions.selector import roots
from feedlake.spec import ReadSettings, reader_kind, resolve

CUSTOM = {"path": "custom/thing", "fields": ["id", "name"], "pagination": "offset", "changed_since": False}


def test_catalogue_shape():
    assert len(CATALOG) == 18
    assert [n for n, e in CATALOG.items() if e.pagination is Pagination.DATE_WINDOW] == ["ledger_posting", "balance_sheet"]
    assert [n for n, e in CATALOG.items() if e.explode_columns] == ["supplier_bank_accounts_lite"]
    assert {n for n, e in CATALOG.items() if e.changed_since} == {
        "customer", "customer_lite", "supplier", "supplier_lite", "supplier_bank_accounts_lite",
    }


@pytest.mark.parametrize("name", CATALOG)
def test_every_entity_resolves_and_has_a_schema(name):
    spec = resolve(ReadSettings(entity=name))
    assert spec.path and spec.fields
    assert set(spec.record_schema().fieldNames()) == roots(spec.fields)
    assert spec.stable_sort_field == ("account.id" if name == "balance_sheet" else "id")


@pytest.mark.parametrize("name", [n for n in CATALOG if n.endswith("_lite")])
def test_lite_entities_share_a_path(name):
    assert any(n != name and not n.endswith("_lite") and e.path == CATALOG[name].path for n, e in CATALOG.items())


@pytest.mark.parametrize("name", [n for n in CATALOG if n.endswith("_lite")])
def test_lite_types_agree_with_the_full_entity(name):
    full = next((e for n, e in CATALOG.items() if not n.endswith("_lite") and e.path == CATALOG[name].path))
    for field in CATALOG[name].record_schema().fields:
        if field.name in full.record_schema().fieldNames() and not isinstance(field.dataType, (T.StructType, T.ArrayType)):
            assert field.dataType == full.record_schema()[field.name].dataType


def test_derived_types():
    got = derive_schema(["id", "isInactive", "amount", "startDate", "name", "percentage", {"currency": ["id"]}, "account",
                         {"employments": ["id"]}])
    assert got.simpleString() == (
        "struct<id:bigint,isInactive:boolean,amount:double,startDate:string,name:string,percentage:double,"
        "currency:struct<id:bigint>,account:struct<id:bigint,number:bigint,name:string>,employments:array<struct<id:bigint>>>"
    )


def test_reader_kinds():
    kinds = {name: reader_kind(resolve(ReadSettings(entity=name))) for name in ("department", "customer", "ledger_posting")}
    assert kinds == {"department": "digest", "customer": "changed_since", "ledger_posting": "windowed"}


def test_custom_path():
    spec = resolve(ReadSettings(**CUSTOM, explode_columns=["rows"], stable_sort_field="name"))
    assert (spec.path, spec.pagination, spec.explode_columns, spec.stable_sort_field) == (
        "custom/thing", Pagination.OFFSET, ("rows",), "name",
    )
    for nothing in (None, ""):
        assert not resolve(ReadSettings(**CUSTOM | {"fields": ["x"]}, stable_sort_field=nothing)).stable_sort_field


def test_nested_sort_field_needs_its_root():
    assert resolve(ReadSettings(**CUSTOM | {"fields": [{"account": ["id"]}]}, stable_sort_field="account.id"))


@pytest.mark.parametrize(
    ("settings", "message"),
    [
        ({"entity": "not-a-real-one"}, "unknown entity"),
        ({}, "entity or a path"),
        (CUSTOM | {"fields": None}, "fields"),
        (CUSTOM | {"fields": []}, "fields"),
        (CUSTOM | {"pagination": None}, "pagination"),
        (CUSTOM | {"pagination": "sideways"}, "sideways"),
        (CUSTOM | {"changed_since": None}, "changed_since"),
        ({"entity": "department", "path": "x"}, "path"),
        ({"entity": "department", "fields": ["id"]}, "fields"),
        ({"entity": "department", "pagination": "offset"}, "pagination"),
        ({"entity": "department", "changed_since": False}, "changed_since"),
        ({"entity": "department", "explode_columns": ["a"]}, "explode_columns"),
        ({"entity": "department", "date_from": "3"}, "date_from"),
        (CUSTOM | {"date_from": "3"}, "date_from"),
        (CUSTOM | {"pagination": "date_window", "changed_since": True}, "date windows"),
        ({"entity": "department", "params": {"sorting": "x"}}, "sorting"),
        (CUSTOM | {"fields": ["name"]}, "stable_sort_field"),
        (CUSTOM | {"stable_sort_field": "-id"}, "stable_sort_field"),
    ],
)
def test_refused_settings(settings, message):
    with pytest.raises(ReadError, match=message):
        resolve(ReadSettings(**settings))


def test_settings_that_go_with_an_entity():
    spec = resolve(ReadSettings(entity="balance_sheet", stable_sort_field="id", count=10, params={"a": 1}, explode_columns=[]))
    assert spec.stable_sort_field == "account.id"


def test_schema_override():
    schema = T.StructType([T.StructField("id", T.StringType())])
    assert resolve(ReadSettings(entity="employee_lite", schema=schema)).record_schema() == schema


GOOD = {"path": "p", "fields": ["id"], "pagination": "offset", "changed_since": False}


def test_extra_entities():
    spec = resolve(ReadSettings(entity="mine"), {"mine": GOOD})
    assert (spec.path, spec.explode_columns, spec.stable_sort_field) == ("p", (), "id")


@pytest.mark.parametrize("bad", [{k: v for k, v in GOOD.items() if k != gone} for gone in GOOD] + [GOOD | {"pagination": "x"}])
def test_bad_metadata(bad):
    with pytest.raises(ValidationError):
        entity_from_metadata("mine", bad)
    with pytest.raises(ReadError) as caught:
        resolve(ReadSettings(entity="mine"), {"mine": bad})
    assert isinstance(caught.value.__cause__, ValidationError)
