"""The incremental user table beside a full rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from log_data import event, frame, random_rows
from stayflow.operators import clean, features
from stayflow.plans.incremental import UserState
from stayflow.schema import PAGES
from stayflow.session import new_folder
from stayflow.streaming import zones
from stayflow.streaming.runs import drain


def dated(spark, rows):
    return clean.add_dates(clean.valid_events(frame(spark, rows)))


def plain(df):
    def value(v):
        return round(v, 6) if isinstance(v, float) else v

    return sorted(tuple(value(v) for v in r) for r in features.with_page_columns(df, PAGES).collect()), df.columns


def full(spark, rows, days, **options):
    return features.user_features(dated(spark, rows), days, pages="map", **options)


@pytest.mark.parametrize("days", [7, 3000])
def test_deliveries_in_any_order_give_the_full_table(spark, days):
    rows = random_rows(41, events=900) + [event("quiet", "2018-10-03", "Home"), event("broken", None, "Home")]
    random.Random(days).shuffle(rows)
    state = UserState(spark, new_folder(spark, "state"), days, buckets=4)
    for number, at in enumerate(range(0, len(rows), 301)):
        assert state.apply(dated(spark, rows[at : at + 301]), number)
        assert plain(state.users()) == plain(full(spark, rows[: at + 301], days, churn=True))
    assert not state.apply(dated(spark, rows[:50]), 1)  # a replay
    assert plain(state.users()) == plain(full(spark, rows, days, churn=True))


def test_users_without_songs_leave_and_come(spark):
    state = UserState(spark, new_folder(spark, "state"), 7, buckets=2, keep_inactive=False)
    first, second = [event("a", "2018-10-01")], [event("a", "2018-10-20", "Home")]
    state.apply(dated(spark, first), 0)
    assert [r.userId for r in state.users().collect()] == ["a"]
    state.apply(dated(spark, second), 1)  # the song is not in the window any more
    assert state.users().count() == 0
    state.apply(dated(spark, [event("a", "2018-10-19")]), 2)
    assert plain(state.users()) == plain(full(spark, first + second + [event("a", "2018-10-19")], 7, churn=True))


def test_only_buckets_of_touched_users_are_read_and_written(spark):
    base = new_folder(spark, "state")
    state = UserState(spark, base, buckets=16)
    rows = random_rows(42, users=60, events=700)
    state.apply(dated(spark, rows), 0)
    before = state.current()
    read = []
    inner = state.read
    state.read = lambda table, buckets=None: read.append(inner(table, buckets)) or read[-1]
    more = [event("u7", "2018-11-20"), event("u8", "2018-11-21", "Home")]
    state.apply(dated(spark, more), 1)
    touched = {b for b, (version, _) in state.current().items() if version == 1}
    assert 1 <= len(touched) <= 2 and len(before) > 10
    for df in read:
        assert {int(f.split("bucket=")[1].split("/")[0]) for f in df.inputFiles()} <= touched
    state.read = inner
    assert {b: v for b, v in state.current().items() if b not in touched} == {b: v for b, v in before.items() if b not in touched}
    assert plain(state.users()) == plain(full(spark, rows + more, 3000, churn=True))


def test_a_delivery_that_failed_before_its_commit_is_repeated(spark, monkeypatch):
    base = new_folder(spark, "state")
    rows = random_rows(43, events=300)
    state = UserState(spark, base, buckets=4)
    state.apply(dated(spark, rows[:200]), 0)
    before = plain(state.users())

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(state, "_commit", fail)
    with pytest.raises(RuntimeError):
        state.apply(dated(spark, rows[200:]), 1)
    again = UserState(spark, base)
    assert again.buckets == 4 and plain(again.users()) == before  # readers still see the delivery before
    again.apply(dated(spark, rows[200:]), 1)
    assert plain(again.users()) == plain(full(spark, rows, 3000, churn=True))


def test_old_folders_are_removed_and_readers_of_the_last_commits_stay(spark):
    state = UserState(spark, new_folder(spark, "state"), buckets=2)
    rows = random_rows(44, events=400)
    for number in range(4):
        state.apply(dated(spark, rows[number * 100 : number * 100 + 100]), number)
    whole = plain(state.users())
    assert state.clean() > 0 and state.clean() == 0
    assert plain(state.users()) == whole == plain(full(spark, rows, 3000, churn=True))


def test_an_empty_delivery(spark):
    state = UserState(spark, new_folder(spark, "state"), buckets=2)
    assert state.users().count() == 0
    assert state.apply(dated(spark, []), 0) and state.users().count() == 0
    state.apply(dated(spark, [event("a", "2018-10-01")]), 1)
    state.apply(dated(spark, []), 2)
    assert state.users().count() == 1


def test_the_stream_keeps_the_table_of_silver(spark):
    lake = zones.Lake(new_folder(spark, "lake"))
    rows = random_rows(45, events=500)
    expected = clean.add_date_parts(frame(spark, rows).dropDuplicates(["ts", "userId"]))
    for part in (rows[:300], rows[200:], rows):
        zones.merge_batch(clean.add_date_parts(frame(spark, part)), lake.data("silver"))
        drain(zones.write_users(spark, lake, buckets=4))
    silver = zones.read_zone(spark, lake.data("silver"))
    assert silver.count() == expected.count()
    users = zones.user_state(spark, lake).users()
    assert plain(users) == plain(features.user_features(silver, pages="map", churn=True))
    assert users.where(F.col("churn") > 0).count() > 0
