"""The batch jobs: raw events to user features, and silver to gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import underscore_columns
from ..operators.clean import add_dates, valid_events
from ..operators.features import choose_features, chosen_pages, user_features
from ..schema import ALL_DAYS, EXPORT_FEATURES, PAGES
from ..sources.files import read_events, write_user_table
from ..sources.lake import read_zone
from ..sources.versions import read_newest, write_version


def churn_user_table(events: DataFrame, days: int = ALL_DAYS, pages: Sequence[str] | str = PAGES) -> DataFrame:
    """The wide user table with the churn flag, from raw events in one pass."""
    dated = events.transform(valid_events).transform(add_dates)
    return user_features(dated, days, pages, churn=True)


def churn_feature_table(
    events: DataFrame, days: int = ALL_DAYS, columns: Sequence[str] = EXPORT_FEATURES
) -> DataFrame:
    """``userId``, ``churn`` and the chosen feature columns, nulls as 0, from raw events."""
    return choose_features(churn_user_table(events, days), columns)


def run_features(
    spark: SparkSession,
    source: str,
    target: str,
    days: int = ALL_DAYS,
    wide: bool = False,
    files: int | None = None,
    mode: str = "error",
    pages: Sequence[str] | str = "auto",
) -> None:
    """JSON events to a user CSV: the export columns, or every column with ``wide``.

    ``pages``: ``auto`` for the pages that occur (one more pass over one column), or a list, after which all other pages
    are counted in ``other_pages``. The export columns are always there.
    """
    events = read_events(spark, source)
    chosen = chosen_pages(pages) if wide else PAGES
    users = churn_user_table(events, days, chosen)
    out = users.na.fill(0) if wide else choose_features(users, EXPORT_FEATURES)
    write_user_table(out, target, files, mode)


def gold_users(silver: DataFrame, days: int = ALL_DAYS, pages: Sequence[str] | str = PAGES) -> DataFrame:
    """The wide user table of the silver zone, with column names free of blanks."""
    return underscore_columns(user_features(silver, days, pages))


def rebuild_gold(
    spark: SparkSession, silver_path: str, gold_path: str, days: int = ALL_DAYS, pages: Sequence[str] | str = "auto"
) -> DataFrame:
    """A new version of the user table; readers of the version before are not disturbed.

    ``pages``: ``auto`` for the pages that occur, ``map`` for one map of counts, or exactly the given ones.
    """
    write_version(gold_users(read_zone(spark, silver_path), days, pages), gold_path)
    return read_newest(spark, gold_path)
