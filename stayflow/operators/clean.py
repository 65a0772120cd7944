"""Row checks, JSON parsing and calendar columns of the activity log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_of
from ..schema import EVENT_SCHEMA


def has_user():
    return F.col("userId").isNotNull() & (F.col("userId") != "")


def valid_events(events: DataFrame) -> DataFrame:
    """Rows that name a user."""
    return events.where(has_user())


def missing_id_count(events: DataFrame) -> DataFrame:
    """How many rows name no user."""
    return events.agg(F.count_if(~F.coalesce(has_user(), F.lit(False))).alias("missing_ids"))


def add_dates(events: DataFrame) -> DataFrame:
    """Add ``event_date``, ``registration_date`` and the days between them."""
    return events.withColumns(
        {"event_date": day_of(F.col("ts")), "registration_date": day_of(F.col("registration"))}
    ).withColumn("days_from_registration", F.datediff("event_date", "registration_date"))


def add_date_parts(events: DataFrame) -> DataFrame:
    """``add_dates`` plus zero-padded year, month and day texts of both dates."""
    formats = {"year": "yyyy", "month": "MM", "day": "dd"}
    return add_dates(events).withColumns(
        {
            f"{stem}_{part}": F.date_format(f"{stem}_date", fmt)
            for stem in ("event", "registration")
            for part, fmt in formats.items()
        }
    )


BROKEN = "broken"


def parse_json_checked(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed event columns of JSON text and ``broken``: the raw text where it is no JSON object of that form, else null.

    Text that is no JSON gives null columns. A field of another type is null and the others are kept; such a line is broken too.
    """
    schema = T.StructType([*EVENT_SCHEMA, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    raw = lines.select(F.col(column).alias("_raw"), F.from_json(column, schema, options).alias("event"))
    # Blank text is parsed to no row at all.
    broken = F.coalesce(F.col(f"event.{BROKEN}"), F.when(F.col("event").isNull() & (F.trim("_raw") != ""), F.col("_raw")))
    return raw.select(*[F.col(f"event.{c}").alias(c) for c in EVENT_SCHEMA.names], broken.alias(BROKEN))


def parse_json_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed event columns of JSON text; text that is no JSON object gives a row of nulls."""
    return lines.select(F.from_json(column, EVENT_SCHEMA).alias("event")).select("event.*")
