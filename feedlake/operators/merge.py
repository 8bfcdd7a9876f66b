"""Applying what an incremental read brings to a table that holds what earlier reads brought."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import null_safe
from .shape import stack


def latest_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per ``key`` the row that is last in ``order``; of rows alike in that, always the same one.

    An aggregate, not a window: tasks keep one row per key before anything is shuffled, so a key with very many versions
    costs one row a task. Nulls are equal keys, and come first in ``order``.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    tie = F.to_json(F.struct(*map(_text_safe(df), rest)))
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order], tie))
    return df.groupBy(*key).agg(last.alias("_last")).select(*key, *[F.col(f"_last.`{c}`").alias(c) for c in rest]).select(df.columns)


def _text_safe(df: DataFrame):
    return lambda name: (F.base64(name) if df.schema[name].dataType.simpleString() == "binary" else F.col(f"`{name}`")).alias(name)


def apply_delta(snapshot: DataFrame, delta: DataFrame, key: Sequence[str], order: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """``snapshot`` with the rows of ``delta`` in place of those with their key, unless they are older; new keys are added.

    ``deleted`` marks rows (of both sides) that say that their key is gone. Applying a delta twice changes nothing, as the
    last row of a key stays the last. Columns that only one side has are null in the other's rows.
    """
    rows = latest_rows(stack([snapshot, delta]), key, order)
    return rows if deleted is None else rows.where(~F.coalesce(deleted, F.lit(False)))


def replace_windows(snapshot: DataFrame, delta: DataFrame, scope: Sequence[str], read: DataFrame) -> DataFrame:
    """``snapshot`` with all rows of the scopes in ``read`` replaced by those of ``delta``.

    ``read`` names the scopes that were read anew, also those that came back empty: their rows go.
    """
    wanted = read.select(*scope).distinct()
    return stack([null_safe(snapshot, wanted, list(scope), "left_anti"), null_safe(delta, wanted, list(scope), "left_semi")])
