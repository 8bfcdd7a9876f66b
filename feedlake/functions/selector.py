"""Field selectors: a list whose items are a field name or a one-key dict for a nested group."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ReadError

Selector = Sequence[Any]


def entries(selector: Selector) -> list[tuple[str, Selector | None]]:
    """``(name, children)`` per selected field; ``children`` is None for a field taken whole."""
    pairs: list[tuple[str, Selector | None]] = []
    for item in selector:
        pairs.extend(item.items() if isinstance(item, dict) else [(item, None)])
    return pairs


def render(selector: Selector) -> str:
    """The selector as a request argument: ``["id", {"a": ["b"]}]`` gives ``id,a(b)``."""
    return ",".join(name if kids is None else f"{name}({render(kids)})" for name, kids in entries(selector))


def roots(selector: Selector) -> set[str]:
    """Top-level names of the selector."""
    return {name for name, _ in entries(selector)}


def narrow_schema(schema: T.StructType, selector: Selector, path: str = "") -> T.StructType:
    """The part of ``schema`` that the selector keeps, at any depth and through lists."""
    kept = []
    for name, kids in entries(selector):
        where = path + name
        if name not in schema.fieldNames():
            raise ReadError(f"selected field {where!r} is not in the data", column=where)
        dtype = schema[name].dataType
        kept.append(T.StructField(name, dtype if kids is None else _narrow_type(dtype, kids, where), True))
    return T.StructType(kept)


def _narrow_type(dtype: T.DataType, kids: Selector, path: str) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_narrow_type(dtype.elementType, kids, path), True)
    if isinstance(dtype, T.StructType):
        return narrow_schema(dtype, kids, f"{path}.")
    raise ReadError(f"field {path!r} has no nested fields to select", column=path)


def project(df: DataFrame, selector: Selector) -> DataFrame:
    """Keep only the selected fields, at any depth and through lists; null objects stay null."""
    wanted = narrow_schema(df.schema, selector)
    return df.select(*[conform(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in wanted.fields])


def conform(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """Rebuild a value of type ``have`` with only the fields of ``want``."""
    if have == want:
        return column
    if isinstance(have, T.ArrayType):
        return F.transform(column, lambda element: conform(element, have.elementType, want.elementType))
    if isinstance(have, T.StructType):
        kept = [conform(column.getField(f.name), have[f.name].dataType, f.dataType).alias(f.name) for f in want.fields]
        return F.when(column.isNotNull(), F.struct(*kept))
    return column


def field_type(schema: T.StructType, path: Sequence[str]) -> T.DataType:
    """Type of the field at a path through nested objects."""
    dtype = schema[path[0]].dataType
    return dtype if len(path) == 1 else field_type(dtype, path[1:])
