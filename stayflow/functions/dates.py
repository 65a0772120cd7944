"""Calendar columns from epoch milliseconds, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The years 1 to 9999 in epoch milliseconds; outside of them a number is not a date.
_FIRST_MS = -62135596800000
_LAST_MS = 253402300799999


def instant(ms: Column) -> Column:
    """Timestamp of an epoch-millisecond number, null when it is no possible date."""
    return F.when(ms.between(_FIRST_MS, _LAST_MS), F.timestamp_millis(ms))


def day_of(ms: Column) -> Column:
    return F.to_date(instant(ms))


def span_days(first: Column, last: Column) -> Column:
    """Number of calendar days from ``first`` to ``last``, both included."""
    return F.datediff(last, first) + 1


def window_start(date_to: Column, registered: Column, days: int) -> Column:
    """First day of the last ``days`` days, or the registration day when that is later."""
    return F.when(F.datediff(date_to, registered) < days, registered).otherwise(F.date_add(date_to, 1 - days))
