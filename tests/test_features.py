"""The one-pass user table equals the table joined from the single metric groups."""

import pytest
from pyspark.sql import functions as F

from log_data import frame, random_rows
from stayflow.operators import churn, clean, features, recency


def joined_user_table(dated, events, days):
    windowed = recency.past_n_days(dated, days)
    users = features.user_song_metrics(windowed)
    for part in (
        features.user_artist_metrics,
        features.user_day_metrics,
        features.user_paid_days,
        features.user_page_pivot,
        features.user_current_level,
    ):
        users = users.join(part(windowed), "userId", "left")
    users = churn.with_churn_flag(features.with_ratios(users), churn.churn_users(events))
    return users.select([F.col(f"`{c}`") for c in features.user_columns(churn=True)])


def rows_of(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("seed, days", [(1, 3000), (2, 7), (3, 1), (4, 20)])
def test_one_pass_equals_the_joins(spark, seed, days):
    log = frame(spark, random_rows(seed))
    dated = clean.add_dates(log)
    fused = features.user_features(dated, days, churn=True)
    expected = joined_user_table(dated, log, days)
    assert fused.columns == expected.columns
    assert rows_of(fused.na.fill("?")) == rows_of(expected.na.fill("?"))


def test_invariants(spark):
    log = clean.add_dates(frame(spark, random_rows(5)))
    users = features.user_features(log, 10)
    assert users.count() == users.select("userId").distinct().count()
    assert users.where("num_artist > num_songs or num_songs_unique > num_songs").count() == 0
    assert users.where("num_active_days > 10 or num_active_days < 1").count() == 0
    assert users.where("NextSong <> num_songs").count() == 0
