"""Bounded batches, recent copies, broken lines and the log of progress."""

import json

import pytest

from log_data import event, random_rows
from stayflow.catalog import queries
from stayflow.operators import clean
from stayflow.schema import EVENT_SCHEMA
from stayflow.session import new_folder
from stayflow.sources import files, versions
from stayflow.streaming import counts, runs, zones


def lines_of(rows):
    return [json.dumps({k: v for k, v in r.items() if v is not None}) for r in rows]


def deliver(spark, folder, lines, parts=1):
    spark.createDataFrame([(line,) for line in lines], "value string").repartition(parts).write.mode("append").text(folder)


@pytest.fixture
def places(spark):
    return new_folder(spark, "incoming"), zones.Lake(new_folder(spark, "lake"))


def test_a_batch_of_one_day_is_written_by_several_tasks(spark):
    lake = zones.Lake(new_folder(spark, "lake"))
    lines = lines_of([event(f"u{i}", "2018-10-01", hour=i % 24, song=f"song {i}" * 40) for i in range(6000)])
    raw = spark.createDataFrame([(line,) for line in lines], "value string").repartition(8)
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        zones.split_batch(raw, 0, lake)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(spark.read.parquet(lake.data("bronze")).inputFiles()) > 1


def test_a_replayed_batch_is_written_once(spark):
    lake = zones.Lake(new_folder(spark, "lake"))
    raw = spark.createDataFrame([(line,) for line in lines_of(random_rows(50, events=100)) + ["{no", "nor"]], "value string")
    for _ in range(2):
        zones.split_batch(raw, 3, lake)
    rows = clean.valid_events(clean.parse_json_lines(raw))
    assert spark.read.parquet(lake.data("bronze")).count() == rows.count()
    assert sorted(r.raw for r in zones.read_broken(spark, lake).collect()) == ["nor", "{no"]
    # A batch that was interrupted after bronze, with files left behind in the next zone.
    zones.write_zone(clean.add_date_parts(rows), f"{lake.data('bronze')}/batch=4", "overwrite")
    raw.write.parquet(f"{lake.data('broken')}/batch=4")
    versions.remove_folder(spark, f"{lake.data('broken')}/batch=4/_SUCCESS")
    zones.split_batch(raw, 4, lake)
    assert zones.read_broken(spark, lake).count() == 4


def test_recent_copies_never_reach_the_merge(spark, places, monkeypatch):
    incoming, lake = places
    seen = []
    inner = zones.merge_batch
    monkeypatch.setattr(zones, "merge_batch", lambda batch, *rest: seen.append(batch.count()) or inner(batch, *rest))
    rows = random_rows(51, events=200)
    other = [{**r, "page": "Home", "itemInSession": 5} for r in rows[:20]]  # known keys with other content
    n = len({(r["ts"], r["userId"]) for r in rows})
    deliver(spark, incoming, lines_of(rows + rows))
    assert zones.ingest(spark, incoming, lake, recent="1 hour").count() == n
    first = sum(seen)
    assert first == len({json.dumps(r, sort_keys=True) for r in rows})
    deliver(spark, incoming, lines_of(rows + other))  # the queries are started anew
    assert zones.ingest(spark, incoming, lake, recent="1 hour").count() == n
    assert sum(seen) - first == len({json.dumps(r, sort_keys=True) for r in other} - {json.dumps(r, sort_keys=True) for r in rows})
    old = [event("late", "2001-01-01")]
    deliver(spark, incoming, lines_of(old))
    assert zones.ingest(spark, incoming, lake, recent="1 hour").count() == n + 1  # old events are not late


def test_broken_lines_are_kept_as_they_came(spark, places):
    incoming, lake = places
    good = lines_of([event("a", "2018-10-01"), event("a", "2018-10-02")])
    half = '{"userId": "h", "ts": 1538352000000, "page": "Home", "length": "long"}'
    broken = ["{broken", "plain text", '["a"', '"text"', "  odd  "]
    deliver(spark, incoming, good + broken + [half, "", "   "])
    silver = zones.ingest(spark, incoming, lake)
    assert sorted(r.userId for r in silver.collect()) == ["a", "a", "h"]
    assert sorted(r.raw for r in zones.read_broken(spark, lake).collect()) == sorted([*broken, half])
    events, bad = files.read_events_checked(spark, incoming)
    assert sorted(r.userId for r in events.collect() if r.userId) == ["a", "a", "h"]
    assert sorted(r.raw for r in bad.collect()) == sorted([*broken, half])
    assert events.columns == EVENT_SCHEMA.names


def test_csv_rows_that_do_not_fit(spark):
    path = new_folder(spark, "csv")
    rows = ["userId,churn,num_songs,total_play_length", "a,1,5,1.5", "b,0,many,2.5", "c,1", "d,0,7,1.0,9,9", 'e,0,8,"2.5"']
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    users, bad = files.read_user_table_checked(spark, path)
    assert sorted((r.userId, r.num_songs) for r in users.collect()) == [("a", 5), ("e", 8)]
    assert sorted(r.raw for r in bad.collect()) == sorted(rows[2:5])


def test_all_batches_of_a_long_run_are_logged(spark):
    incoming, out = new_folder(spark, "incoming"), new_folder(spark, "counts")
    lines = lines_of(random_rows(52, events=450))
    spark.createDataFrame([(line,) for line in lines], "value string").repartition(150).write.text(incoming)
    with runs.ProgressLog(spark, new_folder(spark, "progress")) as log:
        stream = files.stream_lines(spark, incoming, 1).select("value")
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_folder(spark, "ckpt"))
        run = runs.drain(query.queryName("many").trigger(availableNow=True).start())
        log.wait(run)
    rows = log.table().collect()
    assert len(rows) >= 150 and sum(r.input_rows for r in rows) == 450
    assert sorted(r.batch_id for r in rows) == list(range(len(rows)))
    assert runs.progress(spark, run).count() <= 100 < len(rows)
    assert {r.name for r in rows} == {"many"}


def test_log_counts_a_batch_once_over_restarts(spark):
    incoming, out, checkpoint = (new_folder(spark, n) for n in ("incoming", "counts", "ckpt"))
    with runs.ProgressLog(spark, new_folder(spark, "progress")) as log:
        for k in range(3):
            deliver(spark, incoming, lines_of(random_rows(60 + k, events=30)))
            counted = counts.page_counts(files.stream_lines(spark, incoming))
            log.wait(runs.drain(counts.keep_latest(counted, out, checkpoint)))
    assert log.table().agg({"input_rows": "sum"}).first()[0] == 90


def test_silver_batches_are_bounded_by_bytes(spark, places):
    incoming, lake = places
    deliver(spark, incoming, lines_of(random_rows(53, events=600)))
    runs.drain(zones.land_raw(files.stream_lines(spark, incoming), lake))
    runs.drain(zones.write_bronze(files.stream_lines(spark, lake.data("raw")), lake))
    batches = []
    for size in (zones.BYTES_PER_BATCH, 1):
        run = runs.drain(zones.write_silver(spark, OtherSilver(lake.base, new_folder(spark, "silver")), bytes_per_batch=size))
        batches.append(len([p for p in run.recentProgress if p["numInputRows"]]))
    assert batches[0] == 1 and batches[1] > 10


class OtherSilver(zones.Lake):
    """The bronze zone of one lake, the silver zone somewhere else."""

    def __init__(self, base, silver):
        super().__init__(base)
        object.__setattr__(self, "silver", silver)

    def data(self, zone):
        return self.silver if zone == "silver" else super().data(zone)

    def checkpoint(self, zone):
        return f"{self.data(zone)}-checkpoint"


def test_a_delivery_has_a_file_per_task_of_its_scan(spark):
    path = new_folder(spark, "incoming")
    assert queries._deliver(spark.range(0, 240, 1, 12).selectExpr("string(id) AS value"), path) == 6
    assert len(spark.read.text(path).inputFiles()) == 12
    assert queries._deliver(spark.range(0, 240, 1, 1).selectExpr("string(id) AS value"), path, batches=4) == 1
    assert len(spark.read.text(path).inputFiles()) == 16
    assert spark.read.text(path).distinct().count() == 240


def test_bronze_batches_do_not_depend_on_the_number_of_raw_files(spark, places):
    incoming, lake = places
    rows = random_rows(54, events=300)
    deliver(spark, incoming, lines_of(rows), parts=6)
    silver = zones.ingest(spark, incoming, lake, files_per_batch=2)
    assert silver.count() == len({(r["ts"], r["userId"]) for r in rows})
    assert versions.versions(spark, lake.data("bronze"), zones.BATCH) == [0]


def test_new_days_are_merged_without_a_join(spark, monkeypatch):
    path = new_folder(spark, "silver")
    joined = []
    inner = zones.missing_from
    monkeypatch.setattr(zones, "missing_from", lambda *args: joined.append(args[2]) or inner(*args))
    rows = random_rows(55, events=200)
    events = clean.add_date_parts(spark.createDataFrame([json.dumps(r) for r in rows], "string").transform(clean.parse_json_lines))
    zones.merge_batch(events, path)
    assert not joined
    zones.merge_batch(events, path)
    assert len(joined) == 1
    assert spark.read.parquet(path).count() == len({(r["ts"], r["userId"]) for r in rows})


def test_a_key_without_a_day_is_known_by_day(spark):
    path = new_folder(spark, "silver")
    dated = lambda *days: clean.add_date_parts(
        spark.createDataFrame(lines_of([event("a", d, page=p) for d, p in days]), "string").transform(clean.parse_json_lines)
    )
    for _ in range(2):
        zones.merge_batch(dated(("2018-10-02", "Home"), ("2018-10-01", "About")), path, ["userId"])
    zones.merge_batch(dated(("2018-10-03", "Home")), path, ["userId"])
    assert sorted(str(r.event_date) for r in spark.read.parquet(path).collect()) == ["2018-10-01", "2018-10-03"]


def test_users_are_kept_over_two_deliveries(spark, monkeypatch):
    folder, delivered = new_folder(spark, "tables"), []
    events = spark.range(2000).selectExpr(
        "id AS event_id", "timestamp'2024-01-10 00:00:00' + make_interval(0, 0, 0, 0, id div 200, id % 60, 0) AS ts", "id % 7 AS user_id",
        "if(id % 3 = 0, 'view', 'click') AS event_type", "double(id % 40) AS value", "concat('{\"k\": ', id % 100, '}') AS props",
    )
    events.write.parquet(f"{folder}/events.parquet")
    inner = queries._deliver
    monkeypatch.setattr(queries, "_deliver", lambda lines, path, *rest: delivered.append(path) or inner(lines, path, *rest))
    assert queries.REGISTRY["stream_users"](spark, folder).count() == 7
    assert len(delivered) == 2
