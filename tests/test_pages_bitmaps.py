"""Page counts as a map, and bitmaps of days."""

import random
from collections import Counter
from datetime import date, timedelta

from pyspark.sql import functions as F

from log_data import event, frame, random_rows
from stayflow.functions.maps import total_counts
from stayflow.operators import bitmaps, clean, features
from stayflow.plans import batch
from stayflow.schema import PAGES
from stayflow.session import new_folder
from stayflow.sources import files


def dated(spark, rows):
    return clean.add_dates(clean.valid_events(frame(spark, rows)))


def test_maps_are_added_by_key(spark):
    df = spark.createDataFrame([([{"a": 1, "b": 2}, {"b": 5}, {}],), ([],)], "maps array<map<string,bigint>>")
    assert [r.t for r in df.select(total_counts(F.col("maps")).alias("t")).collect()] == [{"a": 1, "b": 7}, {}]


def test_columns_read_off_the_map_are_the_counted_ones(spark):
    log = dated(spark, random_rows(5))
    for days in (7, 3000):
        wide = features.user_features(log, days, churn=True)
        mapped = features.user_features(log, days, pages="map", churn=True)
        again = features.with_page_columns(mapped, PAGES)
        assert again.columns == wide.columns
        assert again.exceptAll(wide).count() == wide.exceptAll(again).count() == 0


def test_two_thousand_pages(spark):
    rng = random.Random(3)
    rows = [event(f"u{i % 9}", "2018-10-05", f"Page {i % 2000}", hour=i % 24) for i in range(4000)]
    rows += [event(f"u{i}", "2018-10-05") for i in range(9)] + random_rows(6, events=200)
    rng.shuffle(rows)
    log = dated(spark, rows)
    mapped = features.user_features(log, pages="map")
    got = {r.userId: r.pages for r in mapped.collect()}
    want: dict[str, Counter] = {}
    for r in rows:
        want.setdefault(r["userId"], Counter())[r["page"]] += 1
    assert got == {u: dict(c) for u, c in want.items() if c["NextSong"]}
    wide = features.user_features(log, pages="auto")
    assert {f"Page {i}" for i in range(2000)} <= set(wide.columns)
    assert wide.where("userId = 'u3'").first()["Page 12"] == want["u3"]["Page 12"]


def test_a_page_may_be_named_like_a_column(spark):
    rows = [event("a", "2018-10-05"), event("a", "2018-10-05", "churn"), event("a", "2018-10-05", "userId")]
    users = features.user_features(dated(spark, rows), pages="auto", churn=True)
    assert users.columns[10:13] == ["NextSong", "churn", "userId"]
    assert list(users.first())[10:13] == [1, 1, 1] and users.first()[0] == "a"


def test_job_with_many_pages(spark):
    source, target = new_folder(spark, "json"), new_folder(spark, "csv")
    frame(spark, random_rows(7, events=150) + [event("u1", "2018-10-01", f"P{i}") for i in range(1100)]).write.json(source)
    batch.run_features(spark, source, target, wide=True)
    assert "P1099" in files.read_user_table(spark, target).columns


def days_of(rows):
    return {
        r.userId: (
            {r_w.word * 64 + b for r_w in r.days for b in range(64) if r_w.active >> b & 1},
            {r_w.word * 64 + b for r_w in r.days for b in range(64) if r_w.paid >> b & 1},
        )
        for r in rows
    }


def random_days(seed):
    rng = random.Random(seed)
    start = date(1969, 10, 1)
    rows = []
    for user in range(40):
        for _ in range(rng.randrange(1, 60)):
            rows.append((f"u{user}", start + timedelta(days=rng.randrange(rng.choice([3, 70, 700]))), rng.choice(["free", "paid", None])))
    return rows + [("none", None, "paid")]


def test_bitmaps_hold_the_days(spark):
    rows = random_days(1)
    epoch = date(1970, 1, 1)
    want: dict[str, tuple[set, set]] = {}
    for user, day, level in rows:
        if day:
            active, paid = want.setdefault(user, (set(), set()))
            active.add((day - epoch).days)
            if level == "paid":
                paid.add((day - epoch).days)
    df = spark.createDataFrame(rows, "userId string, event_date date, level string").repartition(5)
    maps = bitmaps.user_day_bitmaps(df)
    assert days_of(maps.collect()) == want
    one, other = bitmaps.user_day_bitmaps(df.where("level is null")), bitmaps.user_day_bitmaps(df)
    assert days_of(bitmaps.merged_bitmaps(one, other).collect()) == want
    for r in bitmaps.active_days(maps, [1, 3, 7, 30, 63, 64, 65, 128, 3000]).collect():
        active, paid = want[r.userId]
        last = max(active)
        assert (r.date_to - epoch).days == last
        assert r.num_active_days == sum(last - d < r.days for d in active)
        assert (r.num_active_days_paid or 0) == sum(0 <= last - d < r.days for d in paid)
        assert r.num_active_days_paid != 0


def test_one_scan_answers_every_window(spark):
    path = new_folder(spark, "days")
    dated(spark, random_rows(9)).write.parquet(path)
    df = bitmaps.active_days(bitmaps.user_day_bitmaps(spark.read.parquet(path)), [3, 7, 30, 3000])
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "partial_bit_or" in text
