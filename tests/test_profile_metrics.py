"""Describe tables, running totals and curves against brute force and against Spark's own summaries."""

import random

import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayflow.functions.running import running_totals
from stayflow.operators import metrics, profile
from stayflow.plans import training


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        # A third of all values is the same, the rest is spread over a wide range; some are missing.
        spread = 7.0 if rng.random() < 0.33 else rng.choice([None, rng.gauss(0, 1e6), float(rng.randrange(50))])
        rows.append((i % 2 if i % 7 else 0, spread, rng.randrange(5), None if i % 2 else float(i)))
    return pd.DataFrame(rows, columns=["churn", "spread", "few", "half"])


def check(row, expected):
    for ours, theirs in zip(profile.STATISTICS, ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]):
        if pd.isna(expected[theirs]):
            assert row[ours] is None
        else:
            assert row[ours] == pytest.approx(expected[theirs], rel=1e-9, abs=1e-9)


def table(spark, pdf):
    return spark.createDataFrame(
        [tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)],
        "churn int, spread double, few int, half double",
    ).repartition(7)


def test_describe_is_exact(spark, numbers):
    expected = numbers.describe()
    rows = {r.metric: r for r in profile.describe(table(spark, numbers)).collect()}
    assert set(rows) == set(numbers.columns)
    for name, row in rows.items():
        check(row, expected[name])


def test_describe_per_group_and_difference(spark, numbers):
    sides = {c: numbers[numbers.churn == c].drop(columns="churn").describe() for c in (0, 1)}
    for r in profile.describe(table(spark, numbers), by="churn").collect():
        check(r, sides[r.churn][r.metric])
    gap = (sides[0] - sides[1]).transpose()
    for r in profile.describe_difference(table(spark, numbers)).collect():
        check(r, gap.loc[r.metric])


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    rows = {r.metric: r for r in profile.describe(df).collect()}
    assert rows["b"]["count"] == 0 and rows["b"].p50 is None and rows["a"].p50 == 1.5


@pytest.mark.parametrize("buckets", [2, 16, 128])
@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(spark, buckets, descending):
    rng = random.Random(buckets)
    rows = [(rng.gauss(0, 1), rng.randrange(5)) for _ in range(700)]
    df = spark.createDataFrame(rows, "x double, n int").repartition(5)
    total, expected = 0, {}
    for x, n in sorted(rows, reverse=descending):
        total += n
        expected[x] = total
    got = {r.x: r.cum_n for r in running_totals(df, "x", ["n"], descending, buckets).collect()}
    assert got == expected


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        label = float(rng.random() < 0.3)
        rows.append((str(i), label, label + rng.choice([0.0, 0.5, 1.0]) + rng.gauss(0, 0.7), rng.randrange(4)))
    df = spark.createDataFrame(rows, "userId string, label double, a double, b int")
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = LogisticRegression(maxIter=20).fit(ready)
    scored = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    return model, scored


def as_set(df, *columns):
    return sorted(tuple(round(r[c], 9) for c in columns) for r in df.collect())


def test_curves_equal_the_model_summary(fitted):
    model, scored = fitted
    summary = model.summary
    assert as_set(metrics.roc_curve(scored), "FPR", "TPR") == as_set(summary.roc, "FPR", "TPR")
    assert as_set(metrics.pr_curve(scored), "recall", "precision") == as_set(summary.pr, "recall", "precision")
    ours = as_set(metrics.f_measure_curve(scored), "threshold", "F_Measure")
    theirs = summary.fMeasureByThreshold
    assert ours == as_set(theirs, "threshold", "F-Measure")


def test_area_and_accuracy(fitted):
    model, scored = fitted
    area = metrics.area_under_roc(scored).first().area_under_roc
    assert area == pytest.approx(model.summary.areaUnderROC, abs=1e-12)
    assert area == pytest.approx(training.evaluator().evaluate(scored), abs=1e-12)
    row = metrics.accuracy(scored).first()
    assert row.accuracy == pytest.approx(model.summary.accuracy) and row.total == 400


def test_correlation_of_pairs(spark):
    df = spark.range(50).select((F.col("id") * 2.0).alias("a"), (-F.col("id")).cast("double").alias("b"), (F.col("id") % 3).alias("c"))
    rows = {(r.left, r.right): r.correlation for r in profile.feature_correlation(df, ["a", "b", "c"]).collect()}
    assert len(rows) == 3 and rows[("a", "b")] == pytest.approx(-1.0)
