"""Flatten nested objects, explode lists of objects, stack ragged inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ReadError
from ..functions.lattice import joined, shaped

SEPARATOR = "_"


def leaf_paths(schema: T.StructType, sep: str = SEPARATOR, prefix: str = "") -> dict[str, tuple[str, ...]]:
    """Flat column name to field path, for every field that is not an object; lists count as one field.

    On each level the plain fields come first, then the nested groups.
    """
    plain: list[tuple[str, tuple[str, ...]]] = []
    nested: list[tuple[str, tuple[str, ...]]] = []
    for field in schema.fields:
        name = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            below = leaf_paths(field.dataType, sep, name + sep)
            nested += [(leaf, (field.name, *path)) for leaf, path in below.items()]
        else:
            plain.append((name, (field.name,)))
    return distinct_names(plain + nested)


def distinct_names(named: Sequence[tuple[str, Any]]) -> dict[str, Any]:
    """The pairs as a mapping; two equal names (ignoring case, as Spark does) are an error."""
    seen: set[str] = set()
    for name, _ in named:
        if name.lower() in seen:
            raise ReadError(f"two fields would both become column {name!r}", column=name)
        seen.add(name.lower())
    return dict(named)


def dotted(path: Sequence[str]) -> str:
    """A field path as a column reference."""
    return ".".join(f"`{name}`" for name in path)


def flatten(df: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """Turn nested objects into ``parent<sep>child`` columns; lists stay whole.

    A null object gives null columns. Pure projection: no shuffle, and unused leaves are pruned from
    the scan.
    """
    return df.select(*[F.col(dotted(path)).alias(name) for name, path in leaf_paths(df.schema, sep).items()])


def explode_list(df: DataFrame, column: str, sep: str = SEPARATOR) -> DataFrame:
    """One row per element of a list of objects, its fields appended as ``column<sep>field``.

    Rows whose list is null or empty are dropped; a null element stays, as a row of nulls.
    """
    if column not in df.columns:
        raise ReadError(
            f"explode column {column!r} is not in the data; check that the selector asks for it",
            column=column, available_columns=df.columns,
        )
    dtype = df.schema[column].dataType
    if not (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)):
        raise ReadError(f"explode column {column!r} is not a list of objects but {dtype.simpleString()}", column=column)
    rest = [name for name in df.columns if name != column]
    leaves = leaf_paths(dtype.elementType, sep, f"{column}{sep}")
    distinct_names([(name, None) for name in (*rest, *leaves)])
    kept = [F.col(f"`{name}`") for name in rest]
    rows = df.select(*kept, F.explode(F.col(f"`{column}`")).alias("__element"))
    return rows.select(*kept, *[F.col(dotted(("__element", *path))).alias(name) for name, path in leaves.items()])


def explode_lists(df: DataFrame, columns: Sequence[str], sep: str = SEPARATOR) -> DataFrame:
    """Explode several lists one after the other; a row with two lists yields their combinations."""
    return reduce(lambda acc, name: explode_list(acc, name, sep), columns, df)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns that a frame lacks are null. Nothing is de-duplicated.

    A column takes the least type that holds those of all frames: whole numbers widen, numbers beside text become text, and
    objects and lists are joined by their parts.
    """
    names = distinct_names([(name, None) for name in dict.fromkeys(c for frame in frames for c in frame.columns)])
    types = {name: reduce(joined, [f.schema[name].dataType for f in frames if name in f.columns]) for name in names}

    def widened(frame: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in frame.schema}
        return frame.select([
            (shaped(F.col(f"`{name}`"), have[name], want) if name in have else F.lit(None).cast(want)).alias(name)
            for name, want in types.items()
        ])

    return reduce(DataFrame.union, map(widened, frames))
