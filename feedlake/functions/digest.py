"""Order-free content digests of groups of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIMB = 20  # bits; three limbs make up the 60 bits that are kept of each row's hash


def row_text(columns: Sequence[Column | str]) -> Column:
    """One unambiguous text per row: every value length-prefixed, null marked with a dash."""
    return F.concat(*[_prefixed((F.col(c) if isinstance(c, str) else c).cast("string")) for c in columns])


def text_columns(schema: T.StructType, names: Sequence[str] | None = None) -> list[Column]:
    """The named columns (default all) ready for :func:`row_text`; nested ones as JSON, nulls kept."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return [
        F.to_json(name, {"ignoreNullFields": "false"}) if isinstance(schema[name].dataType, nested) else F.col(name)
        for name in names or schema.fieldNames()
    ]


def _prefixed(text: Column) -> Column:
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(columns: Sequence[Column | str]) -> Column:
    """The first 60 bits of the MD5 of :func:`row_text`, as a long."""
    return F.conv(F.substring(F.md5(row_text(columns)), 1, 15), 16, 10).cast("long")


def scope_limbs(df: DataFrame, scope: Sequence[str], columns: Sequence[Column | str]) -> DataFrame:
    """Per scope the row count and the sum of the row hashes as three sums of 20-bit limbs: what a digest is made of.

    The sums do not depend on order or partitioning, and count copies. Plain longs, unlike a 38-digit decimal, stay in the
    fast hash aggregate, they combine map-side (a scope with a third of all rows shuffles one row per task),
    and they cannot overflow below 2^43 rows.
    """
    mask = (1 << _LIMB) - 1
    hashed = df.select(*scope, row_hash(columns).alias("_h"))
    limbs = {
        "limb_high": F.shiftright("_h", 2 * _LIMB),
        "limb_middle": F.shiftright("_h", _LIMB).bitwiseAND(F.lit(mask)),
        "limb_low": F.col("_h").bitwiseAND(F.lit(mask)),
    }
    return hashed.groupBy(*scope).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(v).alias(k) for k, v in limbs.items()])


def limb_digest() -> Column:
    """The digest text of a row of :func:`scope_limbs`: the row count and the exact sum of the hashes."""
    whole = sum(
        (F.col(name).cast("decimal(20,0)") * F.lit(1 << shift).cast("decimal(14,0)") for name, shift in
         (("limb_high", 2 * _LIMB), ("limb_middle", _LIMB))),
        F.col("limb_low").cast("decimal(20,0)"),
    )
    return F.concat_ws("-", F.col("n_rows").cast("string"), whole.cast("string"))


def scope_digests(df: DataFrame, scope: Sequence[str], columns: Sequence[Column | str]) -> DataFrame:
    """Per scope ``n_rows`` and ``digest``."""
    return scope_limbs(df, scope, columns).select(*scope, "n_rows", limb_digest().alias("digest"))


def shifted_limbs(stored: DataFrame, scope: Sequence[str], added: DataFrame, removed: DataFrame) -> DataFrame:
    """The limbs of every scope after a delta, from those ``stored`` and those of the rows ``added`` and ``removed`` only: the
    digest of a large scope follows a small change without reading the scope again. A replaced row is removed in
    its old form and added in its new one. A scope that has lost all its rows is gone.
    """
    sums = ["n_rows", "limb_high", "limb_middle", "limb_low"]
    signed = [side.select(*scope, *[(sign * F.col(c)).alias(c) for c in sums]) for side, sign in ((stored, 1), (added, 1), (removed, -1))]
    whole = signed[0].unionByName(signed[1]).unionByName(signed[2])
    return whole.groupBy(*scope).agg(*[F.sum(c).alias(c) for c in sums]).where("n_rows <> 0")
