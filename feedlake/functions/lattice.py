"""The least type that holds values of several: for records whose types are only known once they have landed.

Null is below every type, whole numbers below wider ones, decimals and doubles, and text above all; objects and lists are
joined by their parts. The order in which types are joined makes no difference, so partial results of tasks and
of runs can be combined.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}  # digits of the largest value
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def joined(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both. A field that only one object has is kept."""
    if a == b:
        return a
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.NullType):
            return other
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f.dataType for f in b}
        fields = [T.StructField(f.name, joined(f.dataType, theirs.pop(f.name, T.NullType()))) for f in a]
        return T.StructType(fields + [T.StructField(name, dtype) for name, dtype in theirs.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(joined(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _number(a, b)
    return T.StringType()


def _number(a: T.DataType, b: T.DataType) -> T.DataType:
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.get)
    parts = [(_WHOLE[t], 0) if t in _WHOLE else (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else None for t in (a, b)]
    if None in parts:
        return T.DoubleType()
    digits, scale = (max(values) for values in zip(*parts))
    return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.DoubleType()


def shaped(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of type ``have`` as the wider type ``want``; objects and lists that become text do so as JSON."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        mine = {f.name: f.dataType for f in have}
        parts = [
            (shaped(column.getField(f.name), mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: shaped(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, _NESTED):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column.cast(want)


def found_type(bodies: DataFrame, body: str) -> T.DataType:
    """The least type of the JSON texts in a column, from one aggregate that combines partial types per task.

    Texts that are no JSON are passed over. Whole numbers are longs, other numbers doubles; where values differ beyond
    that, the type is text and holds the JSON of each value. What is null everywhere has the null type.
    """
    ddl = bodies.select(F.schema_of_variant_agg(F.try_parse_json(body))).first()[0]
    named = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", ddl)  # names in backticks stay
    return _landed(T.DataType.fromDDL(named))


def _landed(found: T.DataType) -> T.DataType:
    if isinstance(found, T.StructType):
        return T.StructType([T.StructField(f.name, _landed(f.dataType)) for f in found])
    if isinstance(found, T.ArrayType):
        return T.ArrayType(_landed(found.elementType))
    if isinstance(found, (T.NullType, T.BooleanType, T.LongType)):
        return found
    return T.DoubleType() if isinstance(found, T.NumericType) else T.StringType()
