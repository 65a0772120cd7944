"""Scoring user tables with fitted pipelines and comparing models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.features import choose_features_tolerant, user_features
from ..operators.profile import prediction_counts
from ..schema import ALL_DAYS, EXPORT_FEATURES
from .training import evaluator


def score_users(model: PipelineModel, users: DataFrame) -> DataFrame:
    """The users with ``rawPrediction``, ``probability`` and ``prediction``."""
    return model.transform(users)


def churn_scores(scored: DataFrame, keep: Sequence[str] = ("userId",)) -> DataFrame:
    """Plain columns of a scored table: the kept ones, the churn probability and the class."""
    return scored.select(*keep, vector_to_array("probability")[1].alias("churn_probability"), "prediction")


def compare_predictions(models: dict[str, PipelineModel], users: DataFrame) -> DataFrame:
    """One column of predicted classes per model next to the true flag, one row per user.

    Scoring works row by row, so the models score the same rows one after the other: the outcome of joining their
    predictions on the user id, without a shuffle.
    """
    scored = users
    for name, model in models.items():
        made = [c for c in score_users(model, users).columns if c not in users.columns and c != "prediction"]
        scored = score_users(model, scored).withColumnRenamed("prediction", f"{name}_pred").drop(*made)
    return scored.select("userId", *[f"{name}_pred" for name in models], "churn")


def join_predictions(tables: dict[str, DataFrame], truth: DataFrame, key: str = "userId") -> DataFrame:
    """Prediction tables (key, prediction) made anywhere, side by side with the true flag (key, churn).

    Only users that every table holds come out.
    """
    joined = truth.select(key, "churn")
    for name, table in tables.items():
        joined = joined.join(table.select(key, F.col("prediction").alias(f"{name}_pred")), key)
    return joined.select(key, *[f"{name}_pred" for name in tables], "churn")


def scorecard_of(model: PipelineModel, users: DataFrame) -> DataFrame:
    """(label, score, prediction) of a model, for the metrics and curves; the score is the churn probability."""
    scored = score_users(model, users)
    return scored.select("label", vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("prediction"))


def evaluate_models(models: dict[str, PipelineModel], users: DataFrame) -> DataFrame:
    """Area under the ROC curve and accuracy of every model over the same users, one row per model."""
    rows = []
    for name, model in models.items():
        found = metrics.accuracy(scorecard_of(model, users)).first()
        rows.append((name, evaluator().evaluate(score_users(model, users)), found["matched"], found["total"], found["accuracy"]))
    kinds = "model string, area_under_roc double, matched long, total long, accuracy double"
    return users.sparkSession.createDataFrame(rows, kinds)


def compare_areas(models: dict[str, PipelineModel], users: DataFrame) -> list[tuple[str, float]]:
    """Area under the ROC curve per model."""
    return [(name, evaluator().evaluate(score_users(model, users))) for name, model in models.items()]


def score_silver(
    model: PipelineModel, silver: DataFrame, days: int = ALL_DAYS, columns: Sequence[str] = EXPORT_FEATURES
) -> DataFrame:
    """Users per predicted class for the current content of the silver zone."""
    users = choose_features_tolerant(user_features(silver, days), columns)
    return prediction_counts(score_users(model, users))
