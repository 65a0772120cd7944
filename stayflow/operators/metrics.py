"""Quality of scores: curves, area under the ROC curve and accuracy.

All curves start from one row per distinct score with its positives and negatives, then running totals from the
highest score down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..functions.running import running_totals


def score_totals(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Per distinct score: positives and negatives at it, and running totals at or above it."""
    per_score = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    )
    running = running_totals(per_score, "threshold", ["positives", "negatives"])
    whole = per_score.agg(F.struct(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))).scalar()
    return running.withColumn("all", whole).select(
        "threshold",
        "positives",
        "negatives",
        F.col("cum_positives").alias("tp"),
        F.col("cum_negatives").alias("fp"),
        F.col("all.p").alias("all_positives"),
        F.col("all.n").alias("all_negatives"),
    )


def _with_ends(points: DataFrame, *ends: str) -> DataFrame:
    spark = points.sparkSession
    for end in ends:
        points = points.unionByName(spark.range(1).selectExpr(end.split(";")[0], *end.split(";")[1:]))
    return points


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """False and true positive rate at each threshold, with the two end points of the curve."""
    points = score_totals(scored, score, label).select(
        "threshold",
        ratio(F.col("fp"), F.col("all_negatives")).alias("FPR"),
        ratio(F.col("tp"), F.col("all_positives")).alias("TPR"),
    )
    return _with_ends(
        points,
        "double(null) AS threshold;0.0D AS FPR;0.0D AS TPR",
        "double(null) AS threshold;1.0D AS FPR;1.0D AS TPR",
    )


def _precision() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return ratio(F.col("tp"), F.col("all_positives"))


def pr_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Recall and precision at each threshold; the curve starts at recall 0 with the first precision."""
    points = score_totals(scored, score, label).select(
        "threshold", _recall().alias("recall"), _precision().alias("precision")
    )
    start = points.agg(F.max_by("precision", "threshold").alias("precision")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), "precision"
    )
    return points.unionByName(start)


def f_measure_curve(scored: DataFrame, score: str = "score", label: str = "label", beta: float = 1.0) -> DataFrame:
    """F-measure at each threshold."""
    weight = beta * beta
    p, r = _precision(), _recall()
    measure = F.coalesce(ratio((1 + weight) * p * r, weight * p + r), F.lit(0.0))
    return score_totals(scored, score, label).select("threshold", measure.alias("F_Measure"))


def area_under_roc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half: the exact area, as one row."""
    totals = score_totals(scored, score, label)
    above = F.col("tp") - F.col("positives") / F.lit(2.0)
    return totals.agg(
        ratio(
            F.sum(F.col("negatives") * above), F.max("all_positives").cast("double") * F.max("all_negatives")
        ).alias("area_under_roc")
    )


def accuracy(scored: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Matched rows, all rows and their ratio."""
    counts = scored.agg(
        F.count_if(F.col(prediction) == F.col(label)).alias("matched"), F.count(F.lit(1)).alias("total")
    )
    return counts.withColumn("accuracy", ratio(F.col("matched"), F.col("total")))
