"""Deduplication, insert-only merging and the streaming zones."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from log_data import event, frame, ms, random_rows
from stayflow.functions.columns import underscore_columns
from stayflow.operators import clean, features, merge
from stayflow.plans import batch
from stayflow.schema import DAY_PARTITION, PAGES
from stayflow.session import new_folder
from stayflow.sources import files, lake
from stayflow.streaming import counts, runs, zones


def deliver(spark, folder, rows, broken=0):
    lines = [json.dumps({k: v for k, v in r.items() if v is not None}) for r in rows] + ["{broken"] * broken
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)


@pytest.fixture
def places(spark):
    return new_folder(spark, "incoming"), zones.Lake(new_folder(spark, "lake"))


def test_dedup_keeps_the_smallest_and_all_columns(spark):
    at = ms("2018-10-01")
    rows = [event("a", at, "Home", status=3), event("a", at, "About", status=9), event("b", at, "Home")]
    kept = merge.dedup_events(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r.userId, r.page, r.status) for r in kept.collect()) == [("a", "About", 9), ("b", "Home", None)]


def test_dedup_of_a_key_with_very_many_copies(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("ts"), F.lit("u").alias("userId"), "id"
    )
    kept = merge.dedup_events(df.withColumn("page", F.lit("Home")))
    assert kept.count() == df.select("ts").distinct().count()
    assert kept.where("ts = 1").first().id == 0


def test_upsert_keeps_known_rows_and_rows_with_null_keys(spark):
    target = spark.createDataFrame([(1, "a", "old")], "ts long, userId string, page string")
    source = spark.createDataFrame([(1, "a", "new"), (2, "a", "new"), (None, "a", "new")], target.schema)
    result = merge.insert_only_upsert(target, source)
    assert sorted((r.ts or 0, r.page) for r in result.collect()) == [(0, "new"), (1, "old"), (2, "new")]
    # A replay adds nothing, not even for the null time.
    assert merge.insert_only_upsert(result, source).count() == 3


def test_dedup_goes_by_the_keys_of_the_caller(spark):
    empty = spark.createDataFrame([], "ts long, userId string, page string")
    source = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (1, "a", "y")], empty.schema)
    assert merge.insert_only_upsert(empty, source, ["ts", "userId", "page"]).count() == 2
    assert merge.insert_only_upsert(empty, source).count() == 1


def test_zone_keeps_texts_and_prunes_days(spark):
    path = new_folder(spark, "zone")
    log = clean.add_date_parts(frame(spark, [event("a", "2018-10-01"), event("a", "2018-10-02"), event("b", "2018-11-01")]))
    lake.write_zone(log, path)
    assert lake.zone_exists(spark, path) and not lake.zone_exists(spark, path + "-none")
    days = lake.read_days(spark, path, ["2018-10-01", "2018-11-01"])
    assert sorted(r.event_month for r in days.collect()) == ["10", "11"]
    assert len(days.inputFiles()) == 2  # the folder of the other day is not even listed
    assert lake.read_days(spark, path, ["2018-12-24"]).count() == 0


def silver_of(rows_in, spark, places, **options):
    incoming, zone = places
    for rows in rows_in:
        deliver(spark, incoming, rows, broken=2)
        silver = zones.ingest(spark, incoming, zone, **options)
    return silver


def test_every_event_arrives_once(spark, places):
    first = [event("a", "2018-10-01", hour=h) for h in range(5)] + [event(None, "2018-10-01")]
    late = [event("a", "2018-09-01"), event("b", "2018-10-01")]
    silver = silver_of([first + first[:2], first + late], spark, places)
    assert silver.count() == 7
    assert silver.where("event_month = '09'").count() == 1
    # Nothing new has arrived: running all three queries again changes nothing.
    assert zones.ingest(spark, *places).count() == 7


def test_replayed_batch_adds_nothing(spark):
    path = new_folder(spark, "silver")
    rows = clean.add_date_parts(frame(spark, random_rows(8, events=300)))
    zones.merge_batch(rows, path)
    once = lake.read_zone(spark, path).count()
    zones.merge_batch(rows, path)
    assert lake.read_zone(spark, path).count() == once == rows.dropDuplicates(["ts", "userId"]).count()


def test_half_written_batch_is_completed(spark):
    path = new_folder(spark, "silver")
    rows = clean.add_date_parts(frame(spark, random_rows(9, events=200)))
    lake.write_zone(merge.dedup_events(rows).where("event_day < '15'"), path)
    zones.merge_batch(rows, path)
    silver = lake.read_zone(spark, path)
    assert silver.count() == silver.dropDuplicates(["ts", "userId"]).count() == rows.dropDuplicates(["ts", "userId"]).count()


def test_rows_without_a_time_are_rejected_and_replays_change_nothing(spark, places):
    rows = [event("a", "2018-10-01"), {"userId": "b", "page": "Home"}, {"userId": "", "page": "Home"}]
    silver = silver_of([rows, rows], spark, places)
    assert silver.count() == 1
    assert [r.userId for r in zones.read_rejected(spark, places[1]).collect()] == ["b", "b"]


def test_bronze_has_one_file_per_day_and_batch(spark, places):
    incoming, zone = places
    rows = random_rows(21, events=400)
    deliver(spark, incoming, rows)
    zones.ingest(spark, incoming, zone)
    bronze = spark.read.parquet(zone.data("bronze"))
    assert len(bronze.inputFiles()) == bronze.select(*DAY_PARTITION).distinct().count()


def test_newest_complete_counts_are_read(spark):
    out = new_folder(spark, "versions")
    assert counts.latest_counts(spark, out).count() == 0
    frame_of = lambda n: spark.createDataFrame([("Home", n)], counts.COUNT_SCHEMA)
    frame_of(1).write.parquet(f"{out}/batch=9")
    frame_of(2).write.parquet(f"{out}/batch=10")
    assert counts.latest_counts(spark, out).first()["count"] == 2


def test_variant_without_dedup_keeps_copies_of_one_batch(spark, places):
    twice = [event("a", "2018-10-01")] * 2
    keys = ["event_date", "ts", "userId"]
    silver = silver_of([twice, twice], spark, places, keys=keys, dedup=False)
    assert silver.count() == 2


def test_stream_and_batch_give_the_same_users(spark, places):
    rows = random_rows(12, events=400)
    silver = silver_of([rows], spark, places, files_per_batch=1)
    assert set(DAY_PARTITION) < set(silver.columns)
    gold = batch.rebuild_gold(spark, places[1].data("silver"), new_folder(spark, "gold"), pages=PAGES)
    log = clean.add_dates(clean.valid_events(frame(spark, rows)).dropDuplicates(["ts", "userId"]))
    direct = underscore_columns(features.user_features(log))
    assert gold.columns == direct.columns
    assert gold.exceptAll(direct).count() == direct.exceptAll(gold).count() == 0


def test_counts_of_tokens_and_pages(spark, places):
    incoming, zone = places
    rows = [event("a", "2018-10-01", p) for p in ("Thumbs Up", "Thumbs Down", "Home", "Thumbs Up")]
    deliver(spark, incoming, rows)
    deliver(spark, incoming, rows[:1])
    out = new_folder(spark, "pages")
    stream = files.stream_lines(spark, incoming, 1)
    run = runs.drain(counts.keep_latest(counts.page_counts(stream), out, new_folder(spark, "ckpt")))
    pages = counts.latest_counts(spark, out)
    assert {r["Page"]: r["count"] for r in pages.collect()} == {"Thumbs Up": 3, "Thumbs Down": 1, "Home": 1}
    seen = runs.progress(spark, run).collect()
    assert [r.input_rows for r in seen if r.input_rows] == [4, 1] or [r.input_rows for r in seen if r.input_rows] == [1, 4]

    words = new_folder(spark, "words")
    text = spark.createDataFrame([("Thumbs Up",), ("Thumbs Down",)], "value string")
    text.coalesce(1).write.text(words)
    tokens_out = new_folder(spark, "tokens")
    runs.drain(counts.keep_latest(counts.token_counts(files.stream_lines(spark, words)), tokens_out, new_folder(spark, "ckpt")))
    tokens = {r["Page"]: r["count"] for r in counts.latest_counts(spark, tokens_out).collect()}
    assert tokens == {"Thumbs": 2, "Up": 1, "Down": 1}

    baseline = spark.createDataFrame([("Home", 10), ("About", 5)], "Page string, Cnt long")
    live = {r["Page"]: r["count"] for r in counts.live_totals(baseline, pages).collect()}
    assert live == {"Home": 11, "About": 5}


def test_queries_at_an_interval_stop_when_idle(spark, places):
    incoming, zone = places
    deliver(spark, incoming, [event("a", "2018-10-01")])
    raw = zones.land_raw(files.stream_lines(spark, incoming), zone, every="200 milliseconds")
    try:
        raw.processAllAvailable()
        assert files.read_lines(spark, zone.data("raw")).count() == 1
        assert raw.isActive
    finally:
        raw.stop()


def test_csv_round_trip(spark):
    users = batch.churn_user_table(frame(spark, random_rows(13, events=300))).na.fill(0)
    path = new_folder(spark, "csv")
    files.write_user_table(users, path, 1)
    back = files.read_user_table(spark, path)
    assert back.schema.simpleString() == users.schema.simpleString()
    assert back.exceptAll(users).count() == 0 and back.count() == users.count()
    assert len(back.inputFiles()) == 1
    inferred = files.read_user_table(spark, path, infer=True)
    assert inferred.columns == users.columns and dict(inferred.dtypes)["num_songs"] == "int"


def test_feature_job_from_json_to_csv(spark):
    source, target = new_folder(spark, "json"), new_folder(spark, "csv")
    rows = random_rows(14, events=300)
    frame(spark, rows + [event("", "2018-10-01")]).write.json(source)
    batch.run_features(spark, source, target, files=1)
    back = files.read_user_table(spark, target)
    assert back.columns[:3] == ["userId", "churn", "num_songs"] and len(back.columns) == 12
    assert back.count() == batch.churn_feature_table(frame(spark, rows)).count()
    wide = f"{target}-{uuid.uuid4().hex}"
    batch.run_features(spark, source, wide, wide=True, pages=PAGES)
    assert len(files.read_user_table(spark, wide).columns) == 43  # with other_pages
    odd = f"{target}-{uuid.uuid4().hex}"
    source = new_folder(spark, "json")
    frame(spark, rows + [event("u1", "2018-10-01", "Brand New")] * 2).write.json(source)
    batch.run_features(spark, source, odd, wide=True)
    table = files.read_user_table(spark, odd)
    assert "Brand New" in table.columns
    assert dict(table.dtypes)["Brand New"] == "bigint"
