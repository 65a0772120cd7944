"""The generic ``events`` table seen as an activity log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EVENT_SCHEMA


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def activity_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of ``events`` as one event of the log's schema; see FIXTURES.md F-7 for the mapping."""
    events = read_table(spark, folder, "events")
    kind, share = F.col("event_type"), F.col("k")
    page = (
        F.when(kind == "view", "NextSong")
        .when(kind == "click", F.when(share < 50, "Thumbs Up").otherwise("Add to Playlist"))
        .when(kind == "purchase", F.when(share < 20, "Submit Upgrade").otherwise("Add Friend"))
        .when(kind == "signup", F.when(share < 20, "Downgrade").otherwise("Home"))
        .when(
            kind == "error",
            F.when(share >= 98, "Cancellation Confirmation").when(share < 50, "Error").otherwise("Thumbs Down"),
        )
    )
    registered = F.lit("2024-01-10").cast("date")
    mapped = {
        "ts": F.unix_millis(F.col("ts").cast("timestamp")),
        "userId": F.when(F.col("event_id") % 89 == 0, None)
        .when(F.col("event_id") % 97 == 0, "")
        .otherwise(F.col("user_id").cast("string")),
        "sessionId": F.floor(F.col("event_id") / 20),
        "page": page,
        "level": F.when(F.col("value") >= 20, "paid").otherwise("free"),
        "itemInSession": F.col("event_id") % 20,
        "registration": F.unix_millis(F.date_sub(registered, (F.col("user_id") % 200).cast("int")).cast("timestamp")),
        "song": F.when(kind == "view", F.concat(F.lit("s"), share.cast("string"))),
        "artist": F.when(kind == "view", F.concat(F.lit("a"), (share % 25).cast("string"))),
        "length": F.when(kind == "view", F.col("value")),
    }
    parsed = events.withColumn("k", F.from_json("props", "k INT")["k"])
    return parsed.select(
        *[mapped.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
    )
