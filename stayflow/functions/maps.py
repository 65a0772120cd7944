"""Maps of counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNTS = "map<string,bigint>"


def added(left: Column, right: Column) -> Column:
    """Counts of both maps, added by key."""
    return F.map_zip_with(left, right, lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def total_counts(maps: Column) -> Column:
    """One map from an array of maps, counts added by key; an empty array gives an empty map."""
    return F.aggregate(maps, F.expr(f"cast(map() AS {COUNTS})"), added)
