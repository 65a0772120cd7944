"""Running totals over a globally ordered column, spread over many tasks.

A window without partition keys would pull every row into one task. Here the value range is cut into
buckets: totals per bucket give each bucket its starting point, and a window inside each bucket does the rest.
The cut points come from an approximate sketch; they only balance the tasks and never change a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 128
_SKETCH_ACCURACY = 2000


def cut_points(value: Column, buckets: int = BUCKETS) -> Column:
    """Aggregate: about evenly filled bucket limits of ``value``, as a sorted array."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    return F.array_sort(F.array_distinct(F.percentile_approx(value, shares, _SKETCH_ACCURACY)))


def bucket_of(value: Column, cuts: Column) -> Column:
    """Number of cut points below ``value``: equal values always share a bucket."""
    return F.size(F.filter(cuts, lambda c: c < value))


def running_totals(
    df: DataFrame, order_by: str, totals: Sequence[str], descending: bool = True, buckets: int | None = None
) -> DataFrame:
    """Add ``cum_<t>`` for each of ``totals``; ``df`` must hold one row per ``order_by`` value.

    By default there are as many buckets as the session has shuffle partitions, ``BUCKETS`` at least.
    """
    buckets = buckets or max(BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(cut_points(F.col(order_by), buckets).alias("cuts")).scalar()
    placed = df.withColumn("_cuts", cuts).withColumn("_bucket", bucket_of(F.col(order_by), F.col("_cuts")))
    placed = placed.drop("_cuts")
    direction = F.desc if descending else F.asc

    # At most ``buckets`` rows, so this window and the broadcast have a fixed size.
    earlier = Window.orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_bucket")
        .agg(*[F.sum(t).alias(t) for t in totals])
        .select("_bucket", *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_start_{t}") for t in totals])
    )
    inside = Window.partitionBy("_bucket").orderBy(direction(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(starts), "_bucket")
        .select(*df.columns, *[(F.col(f"_start_{t}") + F.sum(t).over(inside)).alias(f"cum_{t}") for t in totals])
    )
