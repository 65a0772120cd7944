"""Hand-made cases with known answers."""

from datetime import date

import pytest
from pyspark.errors import AnalysisException

from log_data import event, frame
from stayflow.functions.columns import underscore_columns
from stayflow.operators import churn, clean, features, profile, recency
from stayflow.plans import batch
from stayflow.schema import EXPORT_FEATURES, user_table_schema


def dated(spark, rows):
    return clean.add_dates(clean.valid_events(frame(spark, rows)))


def one_user(spark, rows, days=3000, **options):
    return features.user_features(dated(spark, rows), days, **options).collect()


def test_rows_without_user_are_dropped_and_counted(spark):
    log = frame(spark, [event(None, "2018-10-01"), event("", "2018-10-01"), event("a", "2018-10-01")])
    assert [r.userId for r in clean.valid_events(log).collect()] == ["a"]
    assert clean.missing_id_count(log).first().missing_ids == 2


def test_user_without_a_song_in_the_window_is_left_out(spark):
    rows = [event("a", "2018-10-01"), event("a", "2018-10-20", "Home"), event("b", "2018-10-20")]
    assert [r.userId for r in one_user(spark, rows, 3)] == ["b"]
    kept = {r.userId: r for r in one_user(spark, rows, 3, keep_inactive=True)}
    assert kept["a"].num_songs == 0 and kept["a"].NextSong is None and kept["a"].Home == 1


def test_free_wins_on_the_last_day(spark):
    rows = [
        event("a", "2018-10-01", level="paid"),
        event("a", "2018-10-02", level="free", hour=1),
        event("a", "2018-10-02", level="paid", hour=9),
    ]
    user = one_user(spark, rows)[0]
    assert (user.current_level, user.current_level_paid, user.num_active_days_paid) == ("free", 0, 2)


@pytest.mark.parametrize("days, kept", [(1, 1), (2, 2), (3, 3), (4, 3)])
def test_window_holds_exactly_n_calendar_days(spark, days, kept):
    rows = [event("a", d) for d in ("2018-10-08", "2018-10-09", "2018-10-10")]
    windowed = recency.past_n_days(dated(spark, rows), days)
    assert windowed.count() == kept
    assert {str(r.date_to) for r in windowed.collect()} == {"2018-10-10"}


def test_window_is_anchored_on_each_user(spark):
    rows = [event("a", "2018-10-01"), event("b", "2018-11-01")]
    assert {r.userId: r.date_to for r in recency.past_n_days(dated(spark, rows), 1).collect()} == {
        "a": date(2018, 10, 1),
        "b": date(2018, 11, 1),
    }


def test_missing_registration(spark):
    user = one_user(spark, [event("a", "2018-10-10", registered=None)], 7)[0]
    assert user.date_from == date(2018, 10, 4) and user.days_since_registration is None
    log = frame(spark, [event("a", "2018-10-10", registered=None)])
    assert batch.churn_feature_table(log).first().days_since_registration == 0


def test_registration_inside_the_window_starts_it(spark):
    assert one_user(spark, [event("a", "2018-10-10", registered="2018-10-08")], 7)[0].date_from == date(2018, 10, 8)
    assert one_user(spark, [event("a", "2018-10-10", registered="2018-10-03")], 7)[0].date_from == date(2018, 10, 4)


def test_registration_after_the_last_event_gives_null_ratios(spark):
    user = one_user(spark, [event("a", "2018-10-10", registered="2018-10-11")])[0]
    assert user.days_in_member == 0
    assert user.active_pct is None and user.avg_songs_per_day is None
    assert user.avg_songs_per_active_day == 1.0


def test_page_never_seen_is_null_then_zero(spark):
    rows = [event("a", "2018-10-10")]
    assert one_user(spark, rows)[0]["Thumbs Up"] is None
    assert one_user(spark, rows)[0].num_active_days_paid is None
    assert batch.churn_feature_table(frame(spark, rows)).first()["Thumbs Up"] == 0


def test_cancellation_before_the_window_still_counts(spark):
    rows = [event("a", "2018-10-01", "Cancellation Confirmation"), event("a", "2018-11-01")]
    user = batch.churn_user_table(frame(spark, rows), 3).first()
    assert user.churn == 1 and user["Cancellation Confirmation"] is None


def test_song_played_before_and_inside_the_window_counts_once(spark):
    rows = [event("a", "2018-10-01"), event("a", "2018-10-31"), event("a", "2018-10-30", song="other")]
    user = one_user(spark, rows, 7)[0]
    assert (user.num_songs, user.num_songs_unique, user.num_artist) == (2, 2, 1)


def test_churn_flag_and_rate(spark):
    log = frame(spark, [event("a", "2018-10-01", "Cancellation Confirmation"), event("b", "2018-10-01")])
    users = log.select("userId").distinct()
    flags = churn.with_churn_flag(users, churn.churn_users(log))
    assert {r.userId: r.churn for r in flags.collect()} == {"a": 1, "b": 0}
    rate = churn.churn_rate(log).first()
    assert (rate.total_users, rate.churn_users, rate.churn_rate) == (2, 1, 0.5)


def test_dates_are_utc_days(spark):
    row = clean.add_date_parts(frame(spark, [event("a", 1538352000000 - 1, registered=None)])).first()
    assert (row.event_date, row.event_year, row.event_month, row.event_day) == (date(2018, 9, 30), "2018", "09", "30")
    assert row.registration_date is None and row.registration_day is None


def test_impossible_time_gives_a_null_date(spark):
    assert clean.add_dates(frame(spark, [event("a", 2**62)])).first().event_date is None


def test_malformed_lines_give_null_rows(spark):
    lines = spark.createDataFrame([("{oops",), ('{"userId":"7","page":"Thumbs Up","ts":5,"length":277.89016}',)], "value string")
    rows = clean.valid_events(clean.parse_json_lines(lines)).collect()
    assert [(r.userId, r.page, r.ts, r.length) for r in rows] == [("7", "Thumbs Up", 5, 277.89016)]


def test_strict_choice_needs_every_column_and_tolerant_fills_in(spark):
    users = batch.churn_user_table(frame(spark, [event("a", "2018-10-10")]))
    with pytest.raises(AnalysisException):
        features.choose_features(users, ["no such"])
    chosen = features.choose_features_tolerant(users, ["num_songs", "no such"])
    assert chosen.columns == ["userId", "num_songs", "no such"] and chosen.first()["no such"] == 0


def test_user_table_schema_is_the_declared_one(spark):
    users = batch.churn_user_table(frame(spark, [event("a", "2018-10-10")]))
    assert [(f.name, f.dataType) for f in users.schema] == [(f.name, f.dataType) for f in user_table_schema()]
    assert "Thumbs_Up" in underscore_columns(users).columns
    assert set(EXPORT_FEATURES) < set(users.columns)


def test_pages_outside_the_list(spark):
    log = dated(spark, [event("a", "2018-10-10"), event("a", "2018-10-10", "Brand New")])
    pages = features.distinct_pages(log)
    assert pages == ["Brand New", "NextSong"]
    user = features.user_features(log, pages=pages, churn=True).first()
    assert user["Brand New"] == 1 and user.churn == 0 and "Home" not in user
    assert features.user_features(log).first().num_active_days == 1


def test_previews_are_ordered(spark):
    users = spark.createDataFrame([("b",), ("a",), ("c",)], "userId string")
    assert [r.userId for r in features.preview(users, 2).collect()] == ["a", "b"]


def test_page_counts_skip_missing_users(spark):
    log = frame(spark, [event("a", "2018-10-10"), event(None, "2018-10-10"), event("a", "2018-10-10", "Home")])
    assert {r.page: r.events for r in profile.page_counts(log).collect()} == {"NextSong": 1, "Home": 1}
    assert {r.page for r in profile.page_counts(log, ["NextSong"]).collect()} == {"Home"}


def test_column_counts(spark):
    counts = {r.column_name: r.non_null for r in profile.column_counts(frame(spark, [event(None, "2018-10-10")])).collect()}
    assert counts["userId"] == 0 and counts["page"] == 1 and len(counts) == 18


def test_wide_to_long_totals(spark):
    users = spark.createDataFrame([(1, 2, None), (3, 4, None)], "About long, Cancel long, Downgrade long")
    totals = {r.Page: r.Cnt for r in profile.live_baseline(users).collect()}
    assert totals == {"About": 4, "Cancel": 6, "Downgrade": 0}


def test_negative_or_zero_spans_do_not_fail(spark):
    user = one_user(spark, [event("a", "2018-10-10", registered="2018-12-01")])[0]
    assert user.days_in_member < 0 and user.days_since_registration == user.days_in_member
