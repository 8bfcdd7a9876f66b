"""Calendar helpers: year shift, monthly windows, the watermark format."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import ReadError

# The request window defaults to three years back, and a watermark is UTC to the second.
DEFAULT_YEARS_BACK = 3
WATERMARK_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def shift_years(day: Column, years: int | Column) -> Column:
    """Same month and day in another year; 29 February falls back to the 28th."""
    return F.add_months(day, F.lit(12) * years)


def back_to(today: dt.date, date_from: str | None) -> dt.date:
    """The first day asked for: ``date_from`` is a number of years back, its sign ignored."""
    try:
        years = DEFAULT_YEARS_BACK if date_from is None else abs(int(date_from))
    except ValueError as exc:
        raise ReadError(f"date_from is not a number of years: {date_from!r}", date_from=date_from) from exc
    target = today.year - years
    if target < dt.MINYEAR:
        raise ReadError(f"date_from reaches before year {dt.MINYEAR}: {date_from!r}", date_from=date_from)
    leap_day_lost = (today.month, today.day) == (2, 29) and not _is_leap(target)
    return dt.date(target, today.month, 28 if leap_day_lost else today.day)


def _is_leap(year: int) -> bool:
    return year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)


def month_windows(start: Column, stop: Column) -> Column:
    """Array of half-open monthly ``struct(period_from, period_to)`` covering ``[start, stop)``.

    The first window starts on day one of its month, only the last is cut off at ``stop``. Null when
    the range is empty, so that ``explode`` yields nothing.
    """
    firsts = F.sequence(F.trunc(start, "MM").cast("date"), F.date_sub(stop, 1), F.expr("interval 1 month"))
    pairs = F.transform(
        firsts,
        lambda first: F.struct(first.alias("period_from"), F.least(F.add_months(first, 1), stop).alias("period_to")),
    )
    return F.when(start < stop, pairs)


def format_watermark(ts: Column) -> Column:
    """UTC instant to ``YYYY-MM-DDThh:mm:ssZ``; the text of a zone-less timestamp is read as UTC."""
    return F.concat(F.translate(F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def parse_watermark(text: Column) -> Column:
    """Watermark text back to a zone-less UTC timestamp."""
    return F.to_timestamp_ntz(text, F.lit(WATERMARK_PATTERN))


def watermark_text(moment: dt.datetime) -> str:
    """Driver-side form of :func:`format_watermark` for a zone-aware moment."""
    return moment.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def watermark_moment(text: str) -> dt.datetime:
    """Watermark text as a zone-less UTC ``datetime``."""
    return dt.datetime.strptime(text, "%Y-%m-%dT%H:%M:%SZ")
