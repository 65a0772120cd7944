"""Active and paid days of a user as bitmaps, so that one table answers every window length.

A user has one row with a sorted array of words; bit ``b`` of word ``w`` stands for day ``64 * w + b`` since 1970. A user who is active
on every day of ten years has 58 words. Bitmaps of several deliveries are merged by OR, whatever the order and however often.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import PAID_LEVEL

WORD = 64


def _by_user(words: DataFrame) -> DataFrame:
    """Words of the same user and number are ORed before they are shuffled; then a user's words come together."""
    merged = words.groupBy("userId", "word").agg(F.bit_or("active").alias("active"), F.bit_or("paid").alias("paid"))
    return merged.groupBy("userId").agg(F.array_sort(F.collect_list(F.struct("word", "active", "paid"))).alias("days"))


def user_day_bitmaps(dated: DataFrame) -> DataFrame:
    """(userId, days) of dated events; rows without a date set no bit."""
    day = F.unix_date("event_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), day.bitwiseAND(F.lit(WORD - 1)))
    marked = dated.where("event_date is not null").select(
        "userId",
        F.shiftright(day, 6).alias("word"),
        bit.alias("active"),
        F.when(F.col("level") == PAID_LEVEL, bit).otherwise(F.lit(0).cast("long")).alias("paid"),
    )
    return _by_user(marked)


def merged_bitmaps(one: DataFrame, other: DataFrame) -> DataFrame:
    """The days of both tables."""
    return _by_user(one.unionByName(other).select("userId", F.inline("days")))


def last_day(days: Column) -> Column:
    """Number of the last active day since 1970."""
    last = F.element_at(days, -1)
    return last["word"] * WORD + F.length(F.bin(last["active"])) - 1


def days_in_window(days: Column, window: int, kind: str = "active") -> Column:
    """How many active (or paid) days the last ``window`` days up to the user's last active day hold."""
    first = last_day(days) - window + 1

    def inside(total: Column, word: Column) -> Column:
        outside = first - word["word"] * WORD
        kept = F.when(outside <= 0, word[kind]).when(
            outside < WORD, F.call_function("shiftleft", F.call_function("shiftrightunsigned", word[kind], outside), outside)
        )
        return total + F.bit_count(F.coalesce(kept, F.lit(0).cast("long")))

    return F.aggregate(days, F.lit(0), inside).cast("long")


def active_days(bitmaps: DataFrame, windows: Sequence[int]) -> DataFrame:
    """One row per user and window length: its last day, active days, and paid days (null if there are none)."""
    per_window = F.array(
        *[
            F.struct(
                F.lit(n).alias("days"),
                days_in_window(F.col("days"), n).alias("num_active_days"),
                F.nullif(days_in_window(F.col("days"), n, "paid"), F.lit(0).cast("long")).alias("num_active_days_paid"),
            )
            for n in windows
        ]
    )
    date_to = F.date_from_unix_date(last_day(F.col("days"))).alias("date_to")
    return bitmaps.select("userId", date_to, F.inline(per_window))
