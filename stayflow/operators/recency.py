"""Each user's last N days, counted back from that user's own last event."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import window_start


def user_last_day(events: DataFrame, date_col: str = "event_date") -> DataFrame:
    return events.groupBy("userId").agg(F.max(date_col).alias("date_to"))


def kept_days(events: DataFrame, days: int, date_col: str = "event_date") -> DataFrame:
    """The users' active days within their last ``days`` days, with ``date_to``; one row per user and day."""
    active = events.select("userId", date_col).distinct()
    last = F.max(date_col).over(Window.partitionBy("userId"))
    return active.withColumn("date_to", last).where(F.datediff("date_to", date_col) < days)


def past_n_days(events: DataFrame, days: int, date_col: str = "event_date") -> DataFrame:
    """Events of each user's last ``days`` days, with ``date_to`` and ``date_from`` added.

    Events meet their user's last day through the kept (user, day) pairs. The join key holds the day, so the
    events of a very active user are spread over many tasks, which a window or a join per user would not do, and
    aggregates per user that follow still combine before they shuffle.
    """
    return (
        events.join(kept_days(events, days, date_col), ["userId", date_col])
        .withColumn("date_from", window_start(F.col("date_to"), F.col("registration_date"), days))
        .select(*[F.col(f"`{c}`") for c in events.columns], "date_to", "date_from")
    )
