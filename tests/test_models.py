"""Classifiers, splits, grids and scoring on the sample-like user table."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from log_data import frame, random_rows
from stayflow.operators import clean, metrics, profile, split
from stayflow.plans import batch, scoring, training
from stayflow.schema import EXPORT_FEATURES, MODEL_FEATURES
from stayflow.session import new_folder
from stayflow.sources import lake


@pytest.fixture(scope="module")
def users(spark):
    """Users whose downgrades tell churn apart, with some noise."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        churned = int(rng.random() < 0.3)
        row = {c: float(rng.randrange(1, 40)) for c in EXPORT_FEATURES}
        row["Downgrade"] = float(rng.randrange(20, 60) if churned else rng.randrange(0, 25))
        rows.append((f"u{i}", churned, *row.values()))
    schema = "userId string, churn int, " + ", ".join(f"`{c}` double" for c in EXPORT_FEATURES)
    return training.with_label(spark.createDataFrame(rows, schema)).cache()


def test_grid_sizes(spark):
    assert len(training.lr_study_family().grid) == 27
    assert len(training.gbt_family().grid) == 12
    assert len(training.dt_family().grid) == 2
    assert [len(f.grid) for f in training.families()] == [12, 12, 1]


def test_split_depends_on_the_key_alone(users):
    train, test = split.hash_split(users, 20)
    again, _ = split.hash_split(users.repartition(13), 20)
    keys = {r.userId for r in train.collect()}
    assert keys == {r.userId for r in again.collect()}
    assert train.count() + test.count() == 300 and 30 < test.count() < 90
    folds = [r["count"] for r in split.with_fold(users, 3).groupBy("fold").count().collect()]
    assert len(folds) == 3 and min(folds) > 60


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([tuple([0.0] * 7), (3.0, 4.0, 0.0, 0.0, 0.0, 0.0, 0.0)], ", ".join(f"`{c}` double" for c in MODEL_FEATURES))
    for stage in training.feature_stages():
        df = stage.transform(df)
    vectors = [r.v for r in df.select(vector_to_array("features").alias("v")).collect()]
    assert vectors == [[0.0] * 7, [0.6, 0.8, 0.0, 0.0, 0.0, 0.0, 0.0]]


def test_null_feature_is_an_error(users):
    broken = users.selectExpr("userId", "label", *[f"nullif(`{c}`, `{c}`) as `{c}`" for c in MODEL_FEATURES])
    with pytest.raises(Exception, match="null"):
        training.fit_one(broken, training.decision_tree())


@pytest.mark.parametrize(
    "classifier",
    [
        lambda: training.logistic_regression(maxIter=20, regParam=0.01),
        lambda: training.decision_tree(2),
        training.random_forest,
        lambda: training.boosted_trees(maxIter=5),
    ],
)
def test_models_separate_and_repeat(spark, users, classifier):
    train, test = split.hash_split(users, 20)
    model = training.fit_one(train, classifier())
    scored = scoring.score_users(model, test)
    assert training.evaluator().evaluate(scored) > 0.75
    assert metrics.accuracy(scored).first().accuracy > 0.7
    again = scoring.score_users(training.fit_one(train, classifier()), test)
    rows = {r.userId: r.churn_probability for r in scoring.churn_scores(scored).collect()}
    assert rows == pytest.approx({r.userId: r.churn_probability for r in scoring.churn_scores(again).collect()})
    path = new_folder(spark, "model")
    training.save_model(model, path)
    loaded = scoring.score_users(training.load_model(path), test)
    assert rows == {r.userId: r.churn_probability for r in scoring.churn_scores(loaded).collect()}


def small(family):
    family.grid = family.grid[:2]
    return family


def test_selection_takes_the_highest_area_and_the_first_of_equals(spark, users):
    path = new_folder(spark, "models")
    searches = training.search_all(users, [small(training.lr_family()), training.rf_family()], folds=2, save_to=path)
    best = training.select_best(searches)
    assert best.best_area == max(s.best_area for s in searches) > 0.75
    assert [len(s.areas) for s in searches] == [2, 1]
    twin = training.Search("other", best.model, best.areas, best.params)
    assert training.select_best([best, twin]) is best
    assert training.load_model(f"{path}/RandomForestClassifier").stages[-1].getNumTrees == 20


def test_parallel_searches_equal_serial_ones(users):
    serial = training.grid_search(users, training.lr_family(), folds=3, parallelism=1)
    for _ in range(5):
        assert training.grid_search(users, training.lr_family(), folds=3, parallelism=8).areas == serial.areas
    best = max(range(12), key=serial.areas.__getitem__)
    assert serial.best_params == serial.params[best] and len(serial.areas) == 12


def test_a_fold_without_both_classes_is_named(users):
    one_churned = users.where("label = 0").unionByName(users.where("label = 1").orderBy("userId").limit(1))
    with pytest.raises(ValueError, match=r"fold \d of 3"):
        training.grid_search(one_churned, training.dt_family(), folds=3)


def test_scaler_is_learnt_from_the_training_part(users):
    train, test = split.hash_split(users, 20)
    model = training.fit_one(train, training.decision_tree(2), scale=True)
    names = [type(s).__name__ for s in model.stages]
    assert names == ["VectorAssembler", "Normalizer", "StandardScalerModel", "DecisionTreeClassificationModel"]
    assert scoring.score_users(model, test).count() == test.count()


def test_predictions_of_tables_are_joined(spark):
    table = lambda rows: spark.createDataFrame(rows, "userId string, prediction double")
    truth = spark.createDataFrame([("a", 1), ("b", 0)], "userId string, churn int")
    joined = scoring.join_predictions({"x": table([("a", 1.0), ("b", 1.0)]), "y": table([("a", 0.0)])}, truth)
    assert [tuple(r) for r in joined.collect()] == [("a", 1.0, 0.0, 1)]


def test_models_are_measured_and_have_curves(users):
    train, test = split.hash_split(users, 20)
    model = training.fit_one(train, training.random_forest())
    row = scoring.evaluate_models({"rf": model}, test).first()
    card = scoring.scorecard_of(model, test)
    assert row.total == test.count() and row.accuracy == pytest.approx(row.matched / row.total)
    assert metrics.area_under_roc(card).first()[0] == pytest.approx(row.area_under_roc)


def test_comparison_of_models(users):
    models = {k: training.fit_one(users, c) for k, c in (("gbt", training.boosted_trees(maxIter=3)), ("rf", training.random_forest()))}
    joined = scoring.compare_predictions(models, users)
    assert joined.columns == ["userId", "gbt_pred", "rf_pred", "churn"] and joined.count() == 300
    assert [name for name, area in scoring.compare_areas(models, users) if area > 0.75] == ["gbt", "rf"]


def test_silver_is_scored_with_the_same_feature_names(spark, users):
    path = new_folder(spark, "silver")
    log = clean.valid_events(frame(spark, random_rows(20, events=400)))
    lake.write_zone(clean.add_date_parts(log), path)
    model = training.fit_one(users, training.random_forest())
    counts = scoring.score_silver(model, lake.read_zone(spark, path))
    assert sum(r.users for r in counts.collect()) == batch.gold_users(lake.read_zone(spark, path)).count()
    assert counts.columns == profile.prediction_counts(counts).columns


def test_a_model_that_has_learnt_nothing_fails_the_checks(spark):
    """What the registered queries report about models would be false for constant scores."""
    rows = [(f"u{i}", float(i % 7), float(i % 3), float(i % 7 > 3)) for i in range(210)]
    users = spark.createDataFrame(rows, "userId string, a double, b double, label double")
    family = training.Family("LogisticRegression", training.logistic_regression(maxIter=50), [{}])
    constant = training.logistic_regression(regParam=1e6, elasticNetParam=1.0)
    good = training.grid_search(users, family, ["a", "b"])
    assert abs(training.fold_area(users, family, {}, ["a", "b"]) - good.best_area) < 1e-9
    dull = training.Family("LogisticRegression", constant, [{}])
    assert training.fold_area(users, dull, {}, ["a", "b"]) == 0.5 < good.best_area
    scored = scoring.score_users(training.fit_one(users, constant, ["a", "b"]), users)
    off = F.col("label") - vector_to_array("probability")[1]
    misses = scored.agg(F.sum(off * vector_to_array("features")[0])).first()[0]
    assert abs(misses) / len(rows) > 1e-4
