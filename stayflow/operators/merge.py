"""Deduplication and insert-only merging of events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENT_KEY = ("ts", "userId")
SURVIVOR_ORDER = ("page", "itemInSession")


def dedup_events(
    events: DataFrame, keys: Sequence[str] = EVENT_KEY, order: Sequence[str] = SURVIVOR_ORDER
) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns, so the choice is repeatable.

    A minimum is combined before the shuffle, so even a key with very many copies sends one row per task.
    """
    first = [c for c in order if c in events.columns and c not in keys]
    rest = [c for c in events.columns if c not in keys and c not in first]
    kept = events.groupBy(*keys).agg(F.min(F.struct(*first, *rest)).alias("kept"))
    return kept.select(*[c if c in keys else F.col("kept")[c].alias(c) for c in events.columns])


def missing_from(source: DataFrame, target: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Source rows whose key is absent in the target; nulls in a key are equal, so a replay adds nothing."""
    known = target.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)])
    same = [source[k].eqNullSafe(known[f"_known_{i}"]) for i, k in enumerate(keys)]
    return source.join(known, reduce(and_, same), "left_anti")


def insert_only_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str] = EVENT_KEY, dedup: bool = True
) -> DataFrame:
    """The target followed by the source rows with new keys; existing rows stay as they are."""
    rows = dedup_events(source, keys) if dedup else source
    return target.unionByName(missing_from(rows, target, keys))
