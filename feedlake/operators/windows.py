"""Monthly date windows: as a table, per row of a table, and assigned to dated rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import back_to, month_windows


def window_table(spark: SparkSession, date_from: dt.date, date_to: dt.date) -> DataFrame:
    """The windows of ``[date_from, date_to)`` as rows ``period_from, period_to``."""
    bounds = month_windows(F.lit(date_from), F.lit(date_to))
    return spark.range(1).select(F.inline(bounds))


def read_span(as_of: dt.date, date_from: str | None = None) -> tuple[dt.date, dt.date]:
    """The span a windowed read covers: some years back, up to and including ``as_of``."""
    return back_to(as_of, date_from), as_of + dt.timedelta(days=1)


def expand_windows(df: DataFrame, start: Column, stop: Column) -> DataFrame:
    """One row per monthly window of each row's own ``[start, stop)``; empty ranges yield no row."""
    return df.select("*", F.inline(month_windows(start, stop)))


def assign_windows(df: DataFrame, column: str, date_from: dt.date, date_to: dt.date) -> DataFrame:
    """Keep the rows dated inside the windows of ``[date_from, date_to)`` and add their window.

    The window of a date follows from the date alone, so there is no join and no shuffle, and the
    range reaches the scan as a filter on the bare column.
    """
    first = date_from.replace(day=1)
    inside = (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(date_to)) & F.lit(date_from < date_to)
    period_from = F.trunc(column, "MM")
    return df.where(inside).select(
        "*",
        period_from.alias("period_from"),
        F.least(F.add_months(period_from, 1), F.lit(date_to)).alias("period_to"),
    )
