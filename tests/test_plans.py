"""The physical plans that the large runs rely on."""

import re

from pyspark.sql import functions as F

from log_data import event, frame, ms, random_rows
from stayflow.operators import clean, features, merge, metrics, profile, recency
from stayflow.plans import batch
from stayflow.session import new_folder


def stored_log(spark):
    path = new_folder(spark, "log")
    frame(spark, random_rows(30)).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_feature_table_reads_once_and_shuffles_three_times(spark):
    table = batch.churn_feature_table(stored_log(spark))
    text = plan(table)
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 3
    assert "Join" not in text and "SinglePartition" not in text and "Python" not in text
    details = spark._jvm.PythonSQLUtils.explainString(table._jdf.queryExecution(), "formatted")
    columns = re.search(r"ReadSchema: struct<(.*?)>", details).group(1)
    for unused in ("location", "userAgent", "sessionId", "firstName"):
        assert unused not in columns
    assert "IsNotNull(userId)" in text


def test_aggregates_combine_before_the_shuffle(spark):
    log = clean.add_dates(stored_log(spark))
    for df in (recency.user_last_day(log), merge.dedup_events(log), features.daily_activity(log)):
        text = plan(df)
        first = text.rindex("Exchange hashpartitioning")
        assert "partial_" in text[first:]


def test_no_unbounded_single_task_and_no_cross_join(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("label"), F.rand(1).alias("score"))
    text = plan(metrics.roc_curve(df))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_events_of_a_hot_user_are_spread_by_day(spark):
    windowed = recency.past_n_days(clean.add_dates(stored_log(spark)), 7)
    assert re.search(r"Join \[userId#\d+, event_date#\d+\]", plan(windowed))
    songs = plan(features.user_song_metrics(windowed))
    assert "partial_count" in songs[: songs.index("Join")]


def test_even_a_hot_user_day_is_split(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    path = new_folder(spark, "skew")
    rows = random_rows(31, users=60, events=4000, hot=0)
    burst = [event("hot", ms("2018-10-20", 0) + i * 20000, length=float(i), song=f"song {i}") for i in range(4000)]
    frame(spark, rows + burst).repartition(12).write.parquet(path)
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        windowed = recency.past_n_days(clean.add_dates(spark.read.parquet(path)), 3000)
        assert "skew=true" in final_plan(windowed)
        songs = features.user_song_metrics(windowed)
        assert "skew=true" in final_plan(songs)
        assert songs.where("userId = 'hot'").count() == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_describe_scans_at_most_three_times_and_unpivots_late(spark):
    users = spark.read.parquet(stored_users(spark))
    text = final_plan(profile.describe(users, by="churn"))
    assert text.count("FileScan") - text.count("ReusedExchange") <= 3 or text.count("FileScan parquet") <= 3
    assert "Expand" not in text


def stored_users(spark):
    path = new_folder(spark, "plan-users")
    rows = spark.range(500).selectExpr("cast(id as string) userId", "cast(id % 2 as int) churn", "id * 1.5 x", "id % 7 y")
    rows.write.parquet(path)
    return path
