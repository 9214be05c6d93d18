"""Date bounds, calendar parts and ISO text."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: str | date | datetime) -> Column:
    """A zone-free timestamp literal."""
    if isinstance(value, datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.to_timestamp_ntz(F.lit(str(value)))


def _is_plain_date(value: object) -> bool:
    return (isinstance(value, date) and not isinstance(value, datetime)) or (
        isinstance(value, str) and len(value) == 10
    )


def in_period(ts: Column, start: str | date | datetime | None = None,
              end: str | date | datetime | None = None) -> Column:
    """Inclusive range with either bound optional.

    A bound given as a plain date means the whole day, so the end becomes the
    half-open bound `< end + 1 day`; a bound with a time is compared as it is.
    """
    keep = F.lit(True)
    if start is not None:
        keep = keep & (ts >= moment(start))
    if end is not None:
        if _is_plain_date(end):
            day = end if isinstance(end, date) else date.fromisoformat(end)
            keep = keep & (ts < moment(day + timedelta(days=1)))
        else:
            keep = keep & (ts <= moment(end))
    return keep


def last_days(now: datetime | str, days: int) -> tuple[datetime, datetime]:
    """The period [now - days, now]; `now` is a parameter, so a rerun sees the same rows."""
    stop = datetime.fromisoformat(now) if isinstance(now, str) else now
    return stop - timedelta(days=days), stop


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def week_of_year(ts: Column) -> Column:
    """Week number where week 1 holds January 1 and weeks start on Sunday (not ISO)."""
    first_weekday = F.dayofweek(F.trunc(ts.cast("date"), "year"))
    return (F.floor((F.dayofyear(ts) + first_weekday - 2) / 7) + 1).cast("int")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
