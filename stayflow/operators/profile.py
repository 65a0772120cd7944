"""Counts, describe tables and correlations of the event log and the user table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named, quoted
from ..functions.ordering import leading, ordered_bits
from ..schema import LIVE_PAGES, PAGES, SONG_PAGE

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
#: Bits of the ordered value that a scan tells apart.
STEP_BITS = 16
#: Groups whose wanted buckets are sent to all tasks.
MAX_GROUPS = 10_000
STATISTICS = ["count", "mean", "std", "min", *QUARTILES, "max"]


def page_counts(events: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows with a user id per page."""
    named = events.where(F.col("page").isNotNull())
    kept = named.where(~F.col("page").isin(list(exclude))) if exclude else named
    return kept.groupBy("page").agg(F.count("userId").alias("events"))


def column_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column, one row per column."""
    counts = df.agg(*[F.count(c).alias(n) for c, n in zip(quoted(df.columns), df.columns)])
    return counts.unpivot([], quoted(df.columns), "column_name", "non_null")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, by: str | None = None, max_groups: int = MAX_GROUPS
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each numeric column.

    Quartiles are exact, with linear interpolation between the two ranks around them. Three scans of one value per row: a
    histogram per column, group and leading 16 bits of the ordered value, from which all other statistics come too; then
    the buckets that hold a wanted rank by their next 16 bits; then those that are left by value. Every step is combined
    before its shuffle, and no task gets more than the buckets of one column and group.

    ``by`` splits the table by the values of a column, such as ``churn``. The wanted buckets, six at most per column and
    group, are sent to all tasks if a count of the groups shows at most ``max_groups``; beyond, they are joined by shuffling.
    """
    columns = [c for c in (columns or numeric_columns(df)) if c != by]
    group = F.col(named(by)) if by else F.lit(0)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), c.cast("double").alias("value")) for i, c in enumerate(quoted(columns))])
    values = df.select(group.alias("g"), F.inline(cells)).withColumn("bits", ordered_bits(F.col("value")))

    first = values.groupBy("g", "i", leading(F.col("bits"), STEP_BITS).alias("part")).agg(
        F.count("value").alias("rows"),
        F.avg("value").alias("mean"),
        F.var_pop("value").alias("spread"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    )
    wanted = _wanted_ranks(_with_starts(first, "g", "i"))
    small = by is None or _at_most(df, by, max_groups)
    if small:
        wanted = F.broadcast(wanted)
    second = _refined(values, wanted, STEP_BITS).groupBy(
        "g", "i", "slot", "rank", "stats", leading(F.col("bits"), 2 * STEP_BITS).alias("part")
    )
    inside = _holding_rank(_with_starts(second.agg(F.count(F.lit(1)).alias("rows")), "g", "i", "slot"))
    if small:
        inside = F.broadcast(inside)
    third = _refined(values, inside, 2 * STEP_BITS).groupBy(
        "g", "i", "slot", "rank", "stats", F.col("bits").alias("part"), "value"
    )
    found = _holding_rank(_with_starts(third.agg(F.count(F.lit(1)).alias("rows")), "g", "i", "slot"))
    merged = found.groupBy("g", "i").agg(
        F.any_value("stats").alias("stats"),
        *[_interpolated(2 * n, q).alias(name) for n, (name, q) in enumerate(QUARTILES.items())],
    )
    names = F.array(*map(F.lit, columns)) if columns else F.array(F.lit(""))
    metric = F.get(names, F.col("i")).alias("metric")
    out = [F.col("stats")[s].alias(s) if s not in QUARTILES else F.col(s) for s in STATISTICS]
    return merged.select(*([F.col("g").alias(by)] if by else []), metric, *out)


def _with_starts(buckets: DataFrame, *keys: str) -> DataFrame:
    """Add the number of rows in earlier buckets."""
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return buckets.withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def _wanted_ranks(buckets: DataFrame) -> DataFrame:
    """Six rows per column and group: a rank beside a quartile, the bucket that holds it, and the other statistics.

    Moments of buckets add up to those of the column. A column without values has one row, whose bucket is null.
    """
    per_column = Window.partitionBy("g", "i")
    total, weighted = F.sum("rows").over(per_column), F.sum(F.col("rows") * F.col("mean")).over(per_column)
    centred = buckets.withColumns({"total": total, "centre": weighted / F.nullif(total, F.lit(0))})
    squares = F.sum(F.col("rows") * (F.col("spread") + F.pow(F.col("mean") - F.col("centre"), F.lit(2.0))))
    stats = F.struct(
        F.sum("rows").alias("count"),
        F.first("centre").alias("mean"),
        F.when(F.sum("rows") > 1, F.sqrt(squares / (F.sum("rows") - 1))).alias("std"),
        F.min("least").alias("min"),
        F.max("most").alias("max"),
    )
    slots = []
    for q in QUARTILES.values():
        for side in (F.floor, F.ceil):
            rank = side(F.lit(q) * (F.col("total") - 1)).cast("long")
            holds = (rank >= F.col("start")) & (rank < F.col("start") + F.col("rows"))
            slots.append(F.max(F.when(holds, F.struct("part", (rank - F.col("start")).alias("rank")))))
    merged = centred.groupBy("g", "i").agg(stats.alias("stats"), F.array(*slots).alias("slots"))
    each = merged.select("g", "i", "stats", F.posexplode("slots").alias("slot", "at"))
    return each.select("g", "i", "slot", F.col("at.rank").alias("rank"), "stats", F.col("at.part").alias("part"))


def _at_most(df: DataFrame, column: str, many: int) -> bool:
    """Whether a column has at most so many values (runs a job over that column)."""
    return df.select(named(column)).distinct().limit(many + 1).count() <= many


def _refined(values: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """The values of the wanted buckets, once per wanted rank; ranks of empty columns stay with a null value."""
    place = wanted.select(F.col("g").alias("_g"), F.col("i").alias("_i"), "slot", "rank", "stats", F.col("part").alias("_part"))
    same = (
        F.col("g").eqNullSafe(F.col("_g"))
        & (F.col("i") == F.col("_i"))
        & leading(F.col("bits"), bits).eqNullSafe(F.col("_part"))
    )
    return values.join(place, same)


def _holding_rank(buckets: DataFrame) -> DataFrame:
    """The bucket of each slot that holds its rank, with the rank inside; slots of empty columns stay."""
    inside = F.col("rank") - F.col("start")
    held = buckets.where(F.col("rank").isNull() | ((inside >= 0) & (inside < F.col("rows"))))
    return held.withColumn("rank", inside)


def _interpolated(slot: int, quantile: float) -> Column:
    """Aggregate over the values of the slots: between the two ranks around a quantile."""
    low, high = (F.max(F.when(F.col("slot") == s, F.col("value"))) for s in (slot, slot + 1))
    rank = F.lit(quantile) * (F.any_value("stats.count") - 1)
    return low + (high - low) * (rank - F.floor(rank))


def describe_difference(users: DataFrame, columns: Sequence[str] | None = None, by: str = "churn") -> DataFrame:
    """Describe of the retained users minus describe of the churned users, one row per column."""
    sides = describe(users, columns, by)

    def difference(stat: str) -> Column:
        kept = F.max(F.when(F.col(by) == 0, F.col(stat)))
        left = F.max(F.when(F.col(by) == 1, F.col(stat)))
        return kept - left

    return sides.groupBy("metric").agg(*[difference(s).alias(s) for s in STATISTICS])


def churn_counts(users: DataFrame) -> DataFrame:
    return users.groupBy("churn").agg(F.count("userId").alias("users"))


def churn_group_means(
    users: DataFrame,
    columns: Sequence[str] = ("num_active_days_paid", "num_active_days", "days_since_registration"),
) -> DataFrame:
    return users.groupBy("churn").agg(*[F.avg(c).alias(n) for c, n in zip(quoted(columns), columns)])


def page_totals(
    users: DataFrame, pages: Sequence[str] = PAGES, exclude: Sequence[str] = (), names=("page", "total")
) -> DataFrame:
    """Sum of each page column of the user table, one row per page."""
    kept = [p for p in pages if p not in exclude]
    sums = users.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(p) for c, p in zip(quoted(kept), kept)])
    return sums.unpivot([], quoted(kept), *names)


def live_baseline(users: DataFrame, pages: Sequence[str] = LIVE_PAGES) -> DataFrame:
    """Page totals in the form the live counters are added to."""
    return page_totals(users, pages, names=("Page", "Cnt"))


def totals_without_songs(users: DataFrame) -> DataFrame:
    return page_totals(users, exclude=[SONG_PAGE])


def feature_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, one row per pair, in a single pass."""
    pairs = list(combinations(columns, 2))
    values = dict(zip(columns, quoted(columns)))
    row = df.agg(*[F.corr(values[a], values[b]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*entries)))


def quartile_cuts(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """The quartiles of each column as limits of bins (runs a job); a column without values has none."""
    rows = {r["metric"]: r for r in describe(df, columns).collect()}
    return {c: sorted({rows[c][q] for q in QUARTILES} - {None}) if c in rows else [] for c in columns}


def joint_histograms(df: DataFrame, columns: Sequence[str], cuts: dict[str, Sequence[float]]) -> DataFrame:
    """Rows per pair of bins of every pair of columns, one row per bin pair that occurs, in one scan.

    Bin ``k`` of a column holds the values above ``k`` of its sorted limits; rows with a null in a pair are left out of that pair. The
    pairs of a row are counted before the shuffle, which then carries at most one row per bin pair and task.
    """
    bins = dict(zip(columns, quoted(columns)))
    bins = {
        c: F.when(v.isNotNull(), sum(((v > float(cut)).cast("int") for cut in sorted(cuts[c])), F.lit(0))) for c, v in bins.items()
    }
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), bins[a].alias("left_bin"), bins[b].alias("right_bin"))
            for a, b in combinations(columns, 2)
        ]
    )
    rows = df.select(F.inline(pairs)).where("left_bin is not null and right_bin is not null")
    return rows.groupBy("left", "right", "left_bin", "right_bin").agg(F.count(F.lit(1)).alias("users"))


def prediction_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("users"))
