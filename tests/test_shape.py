"""Flatten, explode and stack."""

import pytest

from feedlake.errors import ReadError
from feedlake.operators import shape

from .conftest import rows

ACCOUNTS = "id long, isInactive boolean, list array<struct<iban string, bban string, provider string>>"


def test_flatten_names_and_order(spark):
    df = spark.createDataFrame([((5, 1500), 1), (None, 2)], "account struct<id long, number long>, id long")
    flat = shape.flatten(df)
    assert flat.columns == ["id", "account_id", "account_number"]
    assert rows(flat) == [(1, 5, 1500), (2, None, None)]


def test_flatten_deep_and_separator(spark):
    df = spark.createDataFrame([(((7, (8,)),), [1])], "a struct<b struct<c long, d struct<e long>>>, l array<long>")
    assert shape.flatten(df, ".").columns == ["l", "a.b.c", "a.b.d.e"]
    assert rows(shape.flatten(df)) == [([1], 7, 8)]


def test_flatten_names_with_dots_in_them(spark):
    df = spark.createDataFrame([(1, (2,))], "`x.y` long, a struct<`b.c` long>")
    assert rows(shape.flatten(df)) == [(1, 2)]


def test_flatten_clash(spark):
    with pytest.raises(ReadError, match="account_id"):
        shape.flatten(spark.createDataFrame([], "account_id long, account struct<id long>"))


def test_explode_one_row_per_element(spark):
    df = spark.createDataFrame([(1, False, [("", "111", "AUTOPAY"), ("NO123", "222", "NETS")])], ACCOUNTS)
    got = shape.explode_list(df, "list")
    assert got.columns == ["id", "isInactive", "list_iban", "list_bban", "list_provider"]
    assert rows(got) == [(1, False, "", "111", "AUTOPAY"), (1, False, "NO123", "222", "NETS")]


def test_explode_drops_null_and_empty_lists_and_keeps_null_elements(spark):
    df = spark.createDataFrame([(1, False, []), (2, False, None), (3, False, [None, ("", "3", "N")])], ACCOUNTS)
    assert rows(shape.explode_list(df, "list")) == [(3, False, "", "3", "N"), (3, False, None, None, None)]


def test_explode_empty_frame_keeps_types(spark):
    got = shape.explode_list(spark.createDataFrame([], ACCOUNTS), "list")
    assert got.count() == 0
    assert got.schema["list_iban"].dataType.simpleString() == "string"


def test_explode_nested_element(spark):
    df = spark.createDataFrame([(1, [((9,), "x")])], "id long, list array<struct<country struct<id long>, iban string>>")
    got = shape.explode_list(df, "list")
    assert got.columns == ["id", "list_iban", "list_country_id"]
    assert rows(got) == [(1, "x", 9)]


def test_explode_two_lists(spark):
    df = spark.createDataFrame(
        [(1, [(1,), (2,)], [("a",), ("b",)]), (2, [(1,)], [])], "id long, m array<struct<v long>>, n array<struct<w string>>"
    )
    assert rows(shape.explode_lists(df, ["m", "n"])) == [(1, 1, "a"), (1, 1, "b"), (1, 2, "a"), (1, 2, "b")]


@pytest.mark.parametrize(
    ("schema", "message"),
    [
        ("id long", "not in the data"), ("id long, list long", "not a list"),
        ("id long, list string", "not a list"), ("id long, list array<long>", "not a list"),
        ("list_v long, list array<struct<v long>>", "list_v"),
    ],
)
def test_explode_refuses(spark, schema, message):
    with pytest.raises(ReadError, match=message):
        shape.explode_list(spark.createDataFrame([], schema), "list")


def test_stack_ragged(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a")], "id long, x string")
    two = spark.createDataFrame([("b", 2)], "y string, id long")
    assert rows(shape.stack([one, two]), "id", "x", "y") == [(1, "a", None), (1, "a", None), (2, None, "b")]
