"""Reading only what changed: by timestamp, and by content digest per scope."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ReadError
from ..functions.dates import watermark_moment
from ..session import landed, null_safe, sized

IN_LIST_ROWS = 500
STORED_SCOPES = 20_000  # partition values of a filter

# Request parameters that the readers generate themselves.
RESERVED_PARAMS = ("from", "count", "fields", "changedSince", "dateFrom", "dateTo", "sorting")


def check_params(params: dict[str, Any] | None) -> None:
    """Refuse caller filters that would collide with generated request parameters."""
    clash = sorted(set(params or {}) & set(RESERVED_PARAMS))
    if clash:
        raise ReadError(f"params must not set {clash}; every request generates these itself", reserved_params=clash)


def filter_params(df: DataFrame, params: dict[str, Any] | None) -> DataFrame:
    """Equality filters ``{column: value}``; they reach the scan."""
    check_params(params)
    for name, value in (params or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def changed_since(df: DataFrame, column: str, watermark: str | None, before: str | None = None) -> DataFrame:
    """Rows with ``column >= watermark`` (and ``< before``); everything when there is no watermark.

    The bound is a literal of the column's own type, so that it reaches the scan uncast. Text is compared as the instant
    that it names, in UTC where it names no zone. Text that names none is kept by every read, since what it marks may have
    changed; a row without a change time is part of reads without a watermark only.
    """
    dtype, moment, unreadable = df.schema[column].dataType, F.col(column), None
    if isinstance(dtype, T.StringType):
        moment, dtype = text_moment(moment), T.TimestampType()
        unreadable = moment.isNull() & F.col(column).isNotNull()
    keep = []
    if watermark is not None:
        keep.append(moment >= _moment(watermark, dtype))
    if before is not None:
        upper = moment < _moment(before, dtype)
        keep.append(upper | moment.isNull() if watermark is None else upper)
    for wanted in keep:
        df = df.where(wanted if unreadable is None else wanted | unreadable)
    return df


def text_moment(text: Column) -> Column:
    """The instant that a text names, in UTC where it names no zone, whatever the zone of the session; null if it names none."""
    bare = F.trim(text)
    day = F.concat(bare, F.lit("T00:00:00Z"))
    zoned = F.when(bare.rlike(r"[0-9](Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2})$"), bare).otherwise(F.concat(bare, F.lit("Z")))
    return F.when(bare.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), day).otherwise(zoned).try_cast("timestamp")


def _moment(watermark: str, dtype: T.DataType) -> Column:
    text = watermark_moment(watermark).strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    if isinstance(dtype, T.TimestampType):
        return F.expr(f"TIMESTAMP'{text} UTC'")
    raise ReadError(f"a changed-since scan needs a timestamp column, not {dtype.simpleString()}")


def changed_scopes(current: DataFrame, saved: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Scopes of ``current`` whose ``digest`` is null, unknown to ``saved``, or different from it.

    Both sides hold one row per scope.
    """
    old = saved.select(*scope, F.col("digest").alias("saved_digest"))
    moved = F.col("digest").isNull() | F.col("saved_digest").isNull() | (F.col("digest") != F.col("saved_digest"))
    return null_safe(current, old, list(scope), "left").where(moved)


def conditional_scan(df: DataFrame, changed: DataFrame, scope: Sequence[str], stored: bool = False) -> DataFrame:
    """All rows of the changed scopes. A changed scope comes back whole, never as a difference.

    A null scope is a scope.

    A short list of scopes becomes an IN filter, which needs no join and, on a stored column, prunes partitions and row
    groups; a longer one is joined, broadcast if its size allows. ``stored`` says that the scope is a partition column of
    the files, as :func:`land_scopes` writes it: then a list of any length up to a broadcast is a filter on the partitions.
    """
    changed = landed(df.sparkSession, changed.select(*scope).distinct(), "changed")
    if len(scope) == 1:
        most = STORED_SCOPES if stored else IN_LIST_ROWS
        keys = [key[0] for key in changed.limit(most + 1).collect()]
        if len(keys) <= most:
            named = F.col(scope[0]).isin([key for key in keys if key is not None])
            return df.where(named | F.col(scope[0]).isNull() if None in keys else named)
    return null_safe(df, sized(changed), list(scope), "left_semi")


def land_scopes(df: DataFrame, scope: str, folder: str) -> DataFrame:
    """``df`` with ``scope`` as partition column of its files, so that a conditional scan opens changed scopes only.

    Rows are dealt out by scope, and a scope above the advisory partition size over several tasks (and files).
    """
    df.hint("rebalance", F.col(scope)).write.partitionBy(scope).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
