"""Time expressions. Every "now" is an explicit ``as_of`` literal."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlens.config import DEFAULT_AS_OF

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def as_of_lit(as_of: str | _dt.datetime | None = None) -> Column:
    """``TIMESTAMP_NTZ`` literal (the test data is zone-less UTC)."""
    if as_of is None:
        as_of = DEFAULT_AS_OF
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp_ntz")


def days_before(as_of: str | None, days: int | Column) -> Column:
    """``as_of - INTERVAL days DAYS`` (folded to a constant by Catalyst)."""
    n = days if isinstance(days, Column) else F.lit(int(days))
    return as_of_lit(as_of) - F.make_dt_interval(days=n)


def micros_between(earlier: Column, later: Column) -> Column:
    """Exact microsecond difference ``later - earlier`` (no calendar, no zone)."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def whole_days(earlier: Column, later: Column) -> Column:
    """Floor of elapsed days; not a calendar-date difference."""
    return F.floor(micros_between(earlier, later) / F.lit(MICROS_PER_DAY)).cast("long")
