"""Who cancelled, and the flag on the user table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..schema import CHURN_PAGE


def churn_users(events: DataFrame) -> DataFrame:
    """Distinct users with a confirmed cancellation, with a constant flag."""
    cancelled = events.where(F.col("page") == CHURN_PAGE)
    return cancelled.select("userId").distinct().withColumn("churn", F.lit(1))


def with_churn_flag(users: DataFrame, churned: DataFrame) -> DataFrame:
    """Add ``churn``: 1 for the users in ``churned``, else 0."""
    flags = churned.select("userId", "churn")
    return users.join(flags, "userId", "left").withColumn("churn", F.when(F.col("churn") == 1, 1).otherwise(0))


def churn_rate(events: DataFrame) -> DataFrame:
    """Users, churned users and their ratio; users are reduced to one row each before the total."""
    per_user = events.groupBy("userId").agg(F.max((F.col("page") == CHURN_PAGE).cast("int")).alias("left"))
    return per_user.agg(
        F.count("userId").alias("total_users"),
        F.count_if((F.col("left") == 1) & F.col("userId").isNotNull()).alias("churn_users"),
    ).withColumn("churn_rate", ratio(F.col("churn_users"), F.col("total_users")))
