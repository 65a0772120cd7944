"""The registered queries: every operator applied to the activity log of a data folder."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import wraps

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named, underscore_columns, underscored
from ..operators import bitmaps, churn, clean, features, merge, metrics, profile, recency, split
from ..plans import batch, incremental, scoring, training
from ..schema import (
    ALL_DAYS,
    DATE_FIELDS,
    DAY_PARTITION,
    EVENT_SCHEMA,
    EXPORT_FEATURES,
    LOG_COLUMNS,
    MODEL_FEATURES,
    PAGE_MAP,
    PAGES,
    PART_FIELDS,
    RATIO_COLUMNS,
    SONG_PAGE,
)
from ..session import new_folder, settle
from ..sources import files, lake
from ..sources.activity import activity_log, read_table
from ..streaming import counts, runs, zones

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

WEEK = 7
WINDOWS = [3, 7, 30, ALL_DAYS]
SHORT_PAGES = ["NextSong", "Cancellation Confirmation", "Home", "Thumbs Up"]
REDELIVERED_FROM = "2024-01-15"


def query(name: str, **options) -> Callable:
    """Register a function under a name; it runs with the package's session settings (UTC days)."""

    def register(function):
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(settle(spark), folder, **options)

        REGISTRY[name] = run
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because sums of doubles depend on the order of addition.

    The small step before rounding makes an exact half in the next digit fall upwards whatever that order was.
    """
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.selectExpr(
        *[f"round({named(n)} + 1e-8D, {digits}) AS {named(n)}" if n in doubles else named(n) for n in df.columns]
    )


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several jobs read to the shared folder, and go on from there."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def valid_log(spark, folder) -> DataFrame:
    return clean.valid_events(activity_log(spark, folder))


def dated_log(spark, folder) -> DataFrame:
    return clean.add_dates(valid_log(spark, folder))


def windowed_log(spark, folder, days: int = WEEK) -> DataFrame:
    return recency.past_n_days(dated_log(spark, folder), days)


def user_table(spark, folder, days: int = ALL_DAYS) -> DataFrame:
    return batch.churn_user_table(activity_log(spark, folder), days)


# --- sources and sinks ---------------------------------------------------------------------------------------


@query("scan_json_events")
def scan_json_events(spark, folder):
    path = new_folder(spark, "json-events")
    activity_log(spark, folder).write.json(path)
    return files.read_events(spark, path).select(*LOG_COLUMNS)


def _csv_round_trip(spark, users, files_wanted):
    path = new_folder(spark, "csv-users")
    files.write_user_table(users, path, files_wanted)
    return path


@query("scan_csv_users")
def scan_csv_users(spark, folder):
    path = _csv_round_trip(spark, user_table(spark, folder).na.fill(0), None)
    return rounded(underscore_columns(files.read_user_table(spark, path)))


@query("sink_csv_users")
def sink_csv_users(spark, folder):
    path = _csv_round_trip(spark, batch.churn_feature_table(activity_log(spark, folder)), 1)
    return rounded(underscore_columns(files.read_user_table(spark, path)))


def _zone(spark, folder) -> str:
    path = new_folder(spark, "zone")
    lake.write_zone(clean.add_date_parts(valid_log(spark, folder)), path)
    return path


ZONE_COLUMNS = LOG_COLUMNS + [f.name for f in DATE_FIELDS + PART_FIELDS]


@query("sink_partitioned")
def sink_partitioned(spark, folder):
    return lake.read_zone(spark, _zone(spark, folder)).select(*ZONE_COLUMNS)


@query("scan_partitioned")
def scan_partitioned(spark, folder):
    """Events per user of three days, read from their partitions only."""
    days = lake.read_days(spark, _zone(spark, folder), ["2024-01-05", "2024-01-06", "2024-01-20"])
    return days.groupBy("event_date", "userId").agg(F.count(F.lit(1)).alias("events"))


@query("packed_days")
def packed_days(spark, folder):
    """A zone that grew in many small files, packed: its rows, and how many files each day has."""
    path = new_folder(spark, "zone")
    log = clean.add_date_parts(valid_log(spark, folder)).repartition(4)
    for part in range(3):
        log.where(F.pmod(F.xxhash64("ts"), F.lit(3)) == part).write.mode("append").partitionBy(*DAY_PARTITION).parquet(path)
    lake.pack_days(spark, path)
    rows = lake.read_zone(spark, path).select("event_date", "userId", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("userId").alias("users"), F.count_distinct("file").alias("files")
    )


@query("gold_user_features")
def gold_user_features(spark, folder):
    return rounded(batch.rebuild_gold(spark, _zone(spark, folder), new_folder(spark, "gold"), pages=PAGES))


# --- projections and filters ---------------------------------------------------------------------------------


@query("valid_events")
def valid_events(spark, folder):
    return valid_log(spark, folder).select(*LOG_COLUMNS)


@query("missing_id_count")
def missing_id_count(spark, folder):
    return clean.missing_id_count(activity_log(spark, folder))


@query("event_dates")
def event_dates(spark, folder):
    return dated_log(spark, folder).select(
        "ts", "userId", "registration", "event_date", "registration_date", "days_from_registration"
    )


@query("event_date_parts")
def event_date_parts(spark, folder):
    return clean.add_date_parts(valid_log(spark, folder)).select(*ZONE_COLUMNS)


@query("choose_features")
def choose_features(spark, folder):
    chosen = features.choose_features(user_table(spark, folder, WEEK), EXPORT_FEATURES)
    return rounded(underscore_columns(chosen))


@query("choose_features_tolerant")
def choose_features_tolerant(spark, folder):
    columns = [*MODEL_FEATURES, "num_active_days_paid", "never_recorded"]
    chosen = features.choose_features_tolerant(user_table(spark, folder, WEEK), columns)
    return rounded(underscore_columns(chosen))


@query("rename_columns")
def rename_columns(spark, folder):
    return underscore_columns(features.user_page_pivot(windowed_log(spark, folder, ALL_DAYS)))


def json_lines(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct(*LOG_COLUMNS)).alias("value"))


@query("parse_json_events")
def parse_json_events(spark, folder):
    """All events as JSON text among all documents, which are no JSON: only the events come out."""
    noise = read_table(spark, folder, "documents").select(F.col("text").alias("value"))
    lines = json_lines(activity_log(spark, folder)).union(noise)
    return clean.valid_events(clean.parse_json_lines(lines)).select(*LOG_COLUMNS)


@query("preview_users")
def preview_users(spark, folder):
    top = features.preview(batch.churn_feature_table(activity_log(spark, folder)), 10)
    return rounded(underscore_columns(top))


# --- joins ---------------------------------------------------------------------------------------------------


@query("past_n_days", days=WEEK)
@query("past_n_days_all", days=ALL_DAYS)
def past_n_days(spark, folder, days):
    return windowed_log(spark, folder, days).select(
        "ts", "userId", "page", "level", "event_date", "registration_date", "date_to", "date_from"
    )


@query("churn_flag")
def churn_flag(spark, folder):
    users = recency.user_last_day(dated_log(spark, folder))
    return churn.with_churn_flag(users, churn.churn_users(valid_log(spark, folder)))


@query("insert_only_upsert")
def insert_only_upsert(spark, folder):
    """A target with the first days, and the whole log delivered again: known rows stay, new ones are added."""
    log = clean.add_date_parts(valid_log(spark, folder)).select(*ZONE_COLUMNS)
    target = log.where(F.col("event_date") < REDELIVERED_FROM).withColumn("delivery", F.lit(1))
    source = log.withColumn("delivery", F.lit(2))
    return merge.insert_only_upsert(target, source, [*DAY_PARTITION, *merge.EVENT_KEY])


@query("dedup_events")
def dedup_events(spark, folder):
    """The log and a second copy of it under another page: one row per key, the smaller page wins."""
    log = valid_log(spark, folder).select(*LOG_COLUMNS)
    return merge.dedup_events(log.union(log.withColumn("page", F.lit("Help"))))


# --- aggregations --------------------------------------------------------------------------------------------


@query("user_last_day")
def user_last_day(spark, folder):
    return recency.user_last_day(dated_log(spark, folder))


@query("user_day_metrics")
def user_day_metrics(spark, folder):
    return features.user_day_metrics(windowed_log(spark, folder))


@query("user_current_level")
def user_current_level(spark, folder):
    return features.user_current_level(windowed_log(spark, folder))


@query("user_page_pivot")
def user_page_pivot(spark, folder):
    return underscore_columns(features.user_page_pivot(windowed_log(spark, folder)))


@query("user_page_pivot_auto")
def user_page_pivot_auto(spark, folder):
    """Page columns from the data; rows instead of columns here, as their names depend on the log."""
    log = windowed_log(spark, folder)
    pages = features.distinct_pages(log)
    pivot = features.user_page_pivot(log, pages)
    return pivot.unpivot(["userId"], [named(p) for p in pages], "page", "events").where("events is not null")


@query("user_features_other_pages")
def user_features_other_pages(spark, folder):
    """A short list of pages: all others are counted in one column."""
    listed = features.chosen_pages(SHORT_PAGES)
    users = features.user_features(dated_log(spark, folder), WEEK, listed)
    return underscore_columns(users.select("userId", *[named(p) for p in listed]))


@query("user_song_metrics")
def user_song_metrics(spark, folder):
    return features.user_song_metrics(windowed_log(spark, folder))


@query("user_artist_metrics")
def user_artist_metrics(spark, folder):
    return rounded(features.user_artist_metrics(windowed_log(spark, folder)))


@query("user_paid_days")
def user_paid_days(spark, folder):
    return features.user_paid_days(windowed_log(spark, folder))




@query("user_ratio_metrics")
def user_ratio_metrics(spark, folder):
    return rounded(user_table(spark, folder, WEEK).select("userId", *RATIO_COLUMNS))


@query("churn_users")
def churn_users(spark, folder):
    return churn.churn_users(valid_log(spark, folder))


@query("churn_rate")
def churn_rate(spark, folder):
    return rounded(churn.churn_rate(valid_log(spark, folder)))


@query("page_counts", exclude=())
@query("page_counts_excl", exclude=(SONG_PAGE,))
def page_counts(spark, folder, exclude):
    return profile.page_counts(activity_log(spark, folder), exclude)


@query("column_counts")
def column_counts(spark, folder):
    return profile.column_counts(activity_log(spark, folder))


def _metric_names(df: DataFrame) -> DataFrame:
    return df.withColumn("metric", F.translate("metric", " ", "_"))


@query("describe_users")
def describe_users(spark, folder):
    users = stored(user_table(spark, folder), "users")
    return rounded(_metric_names(profile.describe(users)))


@query("describe_diff")
def describe_diff(spark, folder):
    users = stored(user_table(spark, folder), "users")
    return rounded(_metric_names(profile.describe_difference(users)))


@query("churn_counts")
def churn_counts(spark, folder):
    return profile.churn_counts(user_table(spark, folder))


@query("churn_group_means")
def churn_group_means(spark, folder):
    return rounded(profile.churn_group_means(user_table(spark, folder).na.fill(0)))


@query("page_totals", exclude=())
@query("page_totals_excl", exclude=(SONG_PAGE,))
def page_totals(spark, folder, exclude):
    return profile.page_totals(user_table(spark, folder), exclude=exclude)


@query("page_totals_unpivot")
def page_totals_unpivot(spark, folder):
    return profile.live_baseline(user_table(spark, folder))


@query("feature_correlation")
def feature_correlation(spark, folder):
    users = underscore_columns(batch.churn_feature_table(activity_log(spark, folder)))
    return rounded(profile.feature_correlation(users, [underscored(c) for c in EXPORT_FEATURES]))


@query("joint_histograms")
def joint_histograms(spark, folder):
    """The 45 pairs of export features, each cut at its quartiles."""
    users = stored(underscore_columns(batch.churn_feature_table(activity_log(spark, folder))), "users")
    columns = [underscored(c) for c in EXPORT_FEATURES]
    return profile.joint_histograms(users, columns, profile.quartile_cuts(users, columns))


# --- user table ----------------------------------------------------------------------------------------------


@query("user_features", days=ALL_DAYS)
@query("user_features_7d", days=WEEK)
def user_features(spark, folder, days):
    return rounded(underscore_columns(features.user_features(dated_log(spark, folder), days)))


@query("user_features_with_inactive")
def user_features_with_inactive(spark, folder):
    users = features.user_features(dated_log(spark, folder), 3, keep_inactive=True)
    return rounded(underscore_columns(users))


@query("churn_feature_table", days=ALL_DAYS)
@query("churn_feature_table_7d", days=WEEK)
def churn_feature_table(spark, folder, days):
    return rounded(underscore_columns(batch.churn_feature_table(activity_log(spark, folder), days)))


@query("user_features_pages", days=ALL_DAYS)
@query("user_features_pages_7d", days=WEEK)
def user_features_pages(spark, folder, days):
    """Page counts as one map for any number of pages; here a page per document source too. In long form."""
    log = dated_log(spark, folder)
    sources = read_table(spark, folder, "documents").select("doc_id", "source", "lang")
    visits = sources.select(
        F.date_add(F.lit(REDELIVERED_FROM).cast("date"), (F.col("doc_id") % 20).cast("int")).alias("event_date"),
        F.concat(F.lit("u"), (F.col("doc_id") % 30).cast("string")).alias("userId"),
        F.concat_ws(" ", F.lit("Read"), "source", "lang", (F.col("doc_id") % 2500).cast("string")).alias("page"),
    )
    songs = visits.withColumn("page", F.lit(SONG_PAGE)).distinct()
    more = visits.unionByName(songs).withColumns({f.name: F.lit(None).cast(f.dataType) for f in EVENT_SCHEMA if f.name not in visits.columns})
    more = more.withColumns({"registration_date": F.lit(None).cast("date"), "days_from_registration": F.lit(None).cast("int")})
    users = features.user_features(log.unionByName(more), days, pages="map")
    return users.select("userId", "num_songs", "num_active_days", F.explode(PAGE_MAP).alias("page", "events"))


@query("user_active_days")
def user_active_days(spark, folder):
    """Active and paid days of the last 3, 7, 30 and 3000 days, all from one table of bitmaps."""
    return bitmaps.active_days(bitmaps.user_day_bitmaps(dated_log(spark, folder)), WINDOWS)


@query("incremental_user_features", days=ALL_DAYS)
@query("incremental_user_features_7d", days=WEEK)
def incremental_user_features(spark, folder, days):
    """Three deliveries, the second of them out of order and the last one given twice: the user table of the whole log."""
    state = incremental.UserState(spark, new_folder(spark, "user-state"), days, buckets=8, churn=False)
    log = dated_log(spark, folder)
    late = F.pmod(F.xxhash64("userId"), F.lit(3)) == 0
    early = F.col("event_date") < REDELIVERED_FROM
    for number, part in enumerate([early & ~late, ~early, early & late]):
        state.apply(log.where(part), number)
    state.apply(log.where(early & late), 2)
    return rounded(underscore_columns(features.with_page_columns(state.users(), PAGES)))


# --- streaming -----------------------------------------------------------------------------------------------


def _deliver(lines: DataFrame, path: str, parts: int = 4, batches: int = 2) -> int:
    """Append lines as at least ``parts`` files; returns how many of them a batch takes, so that there are ``batches``.

    Each task of the scan writes its own file, so none grows with the table. Only a scan of fewer tasks is dealt out.
    """
    scanned = lines.rdd.getNumPartitions()
    (lines if scanned >= parts else lines.repartition(parts)).write.mode("append").text(path)
    return -(-max(scanned, parts) // batches)


def _new_lake(spark) -> zones.Lake:
    return zones.Lake(new_folder(spark, "lake"))


@query("stream_raw_lines")
def stream_raw_lines(spark, folder):
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    share = _deliver(json_lines(activity_log(spark, folder)), incoming)
    runs.drain(zones.land_raw(files.stream_lines(spark, incoming, share), zone))
    return files.read_lines(spark, zone.data("raw"))


@query("stream_bronze")
def stream_bronze(spark, folder):
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    share = _deliver(json_lines(activity_log(spark, folder)), incoming)
    runs.drain(zones.write_bronze(files.stream_lines(spark, incoming, share), zone))
    return lake.read_zone(spark, zone.data("bronze")).select(*ZONE_COLUMNS)


@query("stream_silver")
def stream_silver(spark, folder):
    """The first days arrive twice over several batches, then the whole log arrives again."""
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    log = activity_log(spark, folder)
    early = log.where(clean.day_of(F.col("ts")) < REDELIVERED_FROM)
    share = _deliver(json_lines(early.union(early)), incoming)
    zones.ingest(spark, incoming, zone, files_per_batch=share)
    share = _deliver(json_lines(log), incoming)
    return zones.ingest(spark, incoming, zone, files_per_batch=share).select(*ZONE_COLUMNS)


@query("stream_silver_nodedup")
def stream_silver_nodedup(spark, folder):
    """The log twice in one batch, then once more: copies inside the batch stay, the later one is known."""
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    lines = json_lines(activity_log(spark, folder))
    keys = ["event_date", *merge.EVENT_KEY]
    _deliver(lines.union(lines), incoming)
    zones.ingest(spark, incoming, zone, keys, dedup=False)
    _deliver(lines, incoming)
    return zones.ingest(spark, incoming, zone, keys, dedup=False).select(*ZONE_COLUMNS)


@query("stream_silver_rejects")
def stream_silver_rejects(spark, folder):
    """The log together with lines that have no time: those are found among the rejects, twice if delivered twice."""
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    timeless = read_table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("userId"), F.lit("Home").alias("page"))
    lines = timeless.select(F.to_json(F.struct("userId", "page")).alias("value"))
    _deliver(json_lines(activity_log(spark, folder)).unionByName(lines), incoming)
    silver = zones.ingest(spark, incoming, zone)
    rejected = zones.read_rejected(spark, zone)
    both = rejected.select("userId", F.lit("rejected").alias("zone")).unionByName(silver.select("userId", F.lit("silver").alias("zone")))
    return both.groupBy("zone").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("userId").alias("users"))


def _streamed_counts(spark, lines: DataFrame, counter) -> DataFrame:
    incoming, out = new_folder(spark, "incoming"), new_folder(spark, "counts")
    share = _deliver(lines, incoming)
    stream = files.stream_lines(spark, incoming, share)
    runs.drain(counts.keep_latest(counter(stream), out, new_folder(spark, "checkpoint")))
    return counts.latest_counts(spark, out)


@query("stream_token_counts")
def stream_token_counts(spark, folder):
    lines = activity_log(spark, folder).select(F.col("page").alias("value"))
    return _streamed_counts(spark, lines, counts.token_counts)


@query("stream_token_changes")
def stream_token_changes(spark, folder):
    """Token counts kept by the changes of each batch."""
    lines = activity_log(spark, folder).select(F.col("page").alias("value"))
    incoming, out = new_folder(spark, "incoming"), new_folder(spark, "changes")
    share = _deliver(lines, incoming, batches=4)
    counted = counts.token_counts(files.stream_lines(spark, incoming, share))
    runs.drain(counts.keep_changes(counted, out, new_folder(spark, "checkpoint"), fold=3))
    return counts.changed_counts(spark, out)


@query("stream_page_counts")
def stream_page_counts(spark, folder):
    return _streamed_counts(spark, json_lines(activity_log(spark, folder)), counts.page_counts)


@query("live_page_totals")
def live_page_totals(spark, folder):
    log = activity_log(spark, folder)
    baseline = profile.live_baseline(batch.churn_user_table(log), PAGES)
    streamed = _streamed_counts(spark, json_lines(log), counts.page_counts)
    return counts.live_totals(baseline, streamed)


@query("stream_progress")
def stream_progress(spark, folder):
    """All batches of a streaming count, as a listener has logged them."""
    incoming = new_folder(spark, "incoming")
    share = _deliver(json_lines(activity_log(spark, folder)), incoming)
    with runs.ProgressLog(spark, new_folder(spark, "progress")) as log:
        counted = counts.page_counts(files.stream_lines(spark, incoming, share))
        log.wait(runs.drain(counts.keep_latest(counted, new_folder(spark, "counts"), new_folder(spark, "checkpoint"))))
    return log.table().groupBy("name").agg(F.sum("input_rows").alias("input_rows"))


@query("stream_silver_recent")
def stream_silver_recent(spark, folder):
    """The deliveries of ``stream_silver`` with recent copies dropped by the state store: the same rows."""
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    log = activity_log(spark, folder)
    early = log.where(clean.day_of(F.col("ts")) < REDELIVERED_FROM)
    _deliver(json_lines(early.union(early)), incoming)
    zones.ingest(spark, incoming, zone, recent="2 hours")
    _deliver(json_lines(log), incoming)
    return zones.ingest(spark, incoming, zone, recent="2 hours").select(*ZONE_COLUMNS)


@query("stream_quarantine")
def stream_quarantine(spark, folder):
    """The log among all documents, which are no JSON: these are kept as they came, and the log arrives whole."""
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    noise = read_table(spark, folder, "documents").where("trim(text) <> ''")
    lines = noise.select(F.concat_ws(" ", F.lit("doc"), F.col("doc_id").cast("string"), F.translate("text", "\r\n", "  ")).alias("value"))
    _deliver(json_lines(activity_log(spark, folder)).unionByName(lines), incoming)
    silver = zones.ingest(spark, incoming, zone)
    broken = zones.read_broken(spark, zone).select(F.lit("broken").alias("zone"), F.md5("raw").alias("line"))
    kept = silver.select(F.lit("silver").alias("zone"), F.concat_ws(" ", "ts", "userId").alias("line"))
    return broken.unionByName(kept)


@query("stream_users")
def stream_users(spark, folder):
    """The user table kept up to date from silver over two deliveries."""
    incoming, zone = new_folder(spark, "incoming"), _new_lake(spark)
    log = activity_log(spark, folder)
    for delivery in (log.where(clean.day_of(F.col("ts")) < REDELIVERED_FROM), log):
        _deliver(json_lines(delivery), incoming)
        zones.ingest(spark, incoming, zone)
        runs.drain(zones.write_users(spark, zone, buckets=8, churn=False))
    users = zones.user_state(spark, zone, churn=False).users()
    return rounded(underscore_columns(features.with_page_columns(users, PAGES)))


# --- vectors, splits, scorecards -----------------------------------------------------------------------------


def _vector_columns(df: DataFrame, column: str) -> DataFrame:
    values = df.select("userId", vector_to_array(column).alias("v"))
    return values.select(
        "userId", *[F.col("v")[i].alias(underscored(c)) for i, c in enumerate(MODEL_FEATURES)]
    )


def model_table(spark, folder) -> DataFrame:
    """The user table for model work: no nulls, stored once because every fit reads it again."""
    users = features.choose_features(user_table(spark, folder), EXPORT_FEATURES)
    return training.with_label(stored(users, "model-users"))


@query("assemble_features", step=1)
@query("normalize_features", step=2)
def feature_vectors(spark, folder, step):
    users = features.choose_features(user_table(spark, folder), MODEL_FEATURES)
    stages = training.feature_stages()[:step]
    vectors = PipelineModel(stages=stages).transform(users)
    return rounded(_vector_columns(vectors, stages[-1].getOutputCol()))


@query("standardize_features")
def standardize_features(spark, folder):
    users = model_table(spark, folder)
    vectors = PipelineModel(stages=training.feature_stages()).transform(users)
    scaled = training.standard_scaler().fit(vectors).transform(vectors)
    return rounded(_vector_columns(scaled, "scaled_features"))


@query("train_test_split")
def train_test_split(spark, folder):
    users = features.choose_features(user_table(spark, folder), [])
    train, test = split.hash_split(users)
    return train.withColumn("side", F.lit("train")).union(test.withColumn("side", F.lit("test")))


def scorecard(spark, folder) -> DataFrame:
    """A fixed formula over the user table as score, so that the metrics have one right answer."""
    users = user_table(spark, folder)
    score = (F.col("num_songs") * 37 + F.col("days_since_registration") * 11 + F.col("num_active_days") * 5) % 97
    return users.select(
        "userId",
        F.col("churn").alias("label"),
        (score / F.lit(100.0)).alias("score"),
        (score >= 60).cast("int").alias("prediction"),
    )


@query("area_under_roc", metric=metrics.area_under_roc)
@query("roc_curve", metric=metrics.roc_curve)
@query("pr_curve", metric=metrics.pr_curve)
@query("f_measure_curve", metric=metrics.f_measure_curve)
@query("accuracy", metric=metrics.accuracy)
def scorecard_metric(spark, folder, metric):
    return rounded(metric(stored(scorecard(spark, folder), "scorecard")))


# --- models --------------------------------------------------------------------------------------------------
# Fitted numbers differ between engines. The queries fit real models and return facts with one right answer.


CLASSIFIERS = {
    "lr": lambda: training.logistic_regression(maxIter=20, regParam=0.3, elasticNetParam=0.0),
    "dt": lambda: training.decision_tree(2),
    "rf": training.random_forest,
    "gbt": lambda: training.boosted_trees(maxIter=10),
}


def facts(scored: DataFrame, again: DataFrame) -> DataFrame:
    """Scored users, those with a probability outside 0 to 1 or a class that contradicts it, and those whose second
    score differs."""
    one = scoring.churn_scores(scored)
    two = scoring.churn_scores(again).select("userId", F.col("churn_probability").alias("other"))
    p = F.col("churn_probability")
    both = one.join(two, "userId")
    return both.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(~p.between(0, 1)).alias("outside"),
        F.count_if(((p > 0.5) & (F.col("prediction") != 1)) | ((p < 0.5) & (F.col("prediction") != 0))).alias("contradicting"),
        F.count_if(F.abs(p - F.col("other")) > 1e-9).alias("differing"),
    )


@query("lr_predictions", kind="lr")
@query("dt_predictions", kind="dt")
@query("rf_predictions", kind="rf")
@query("gbt_predictions", kind="gbt")
def model_predictions(spark, folder, kind):
    """Two fits with one seed over the same training rows, scored on the test rows."""
    train, test = split.hash_split(model_table(spark, folder))
    one, two = (training.fit_one(train, CLASSIFIERS[kind]()) for _ in range(2))
    return facts(scoring.score_users(one, test), scoring.score_users(two, test))


@query("dt_leaf_shares")
def dt_leaf_shares(spark, folder):
    """Leaves hold the shares of their training rows: over these rows the probabilities add up to the churned users."""
    train, _ = split.hash_split(model_table(spark, folder))
    scored = scoring.churn_scores(scoring.score_users(training.fit_one(train, CLASSIFIERS["dt"]()), train), ["label"])
    return scored.agg(
        F.sum("label").cast("long").alias("churned"), F.round(F.sum("churn_probability"), 3).alias("expected")
    )


@query("lr_coefficients")
def lr_coefficients(spark, folder):
    """The features in model order. Without a penalty the fit solves its score equations: over the training rows, churned users and
    probabilities agree in sum, and so do they weighted by each feature. A model that has learnt nothing misses the latter."""
    train, _ = split.hash_split(model_table(spark, folder))
    model = training.fit_one(train, training.logistic_regression(maxIter=500, tol=1e-9))
    fitted = model.stages[-1]
    scored = scoring.score_users(model, train)
    off = F.col("label") - vector_to_array("probability")[1]
    x = vector_to_array("features")
    sums = scored.agg(F.sum(off), *[F.sum(off * x[i]) for i in range(len(MODEL_FEATURES))], F.count(F.lit(1))).first()
    balance, *equations, n = sums
    rows = [
        (underscored(name), math.isfinite(value), abs(balance) < 0.5, abs(equation) / n < 1e-4)
        for name, value, equation in zip(MODEL_FEATURES, fitted.coefficients.toArray().tolist(), equations)
    ]
    return spark.createDataFrame(rows, "feature string, finite boolean, balanced boolean, solved boolean")


@query("prediction_counts")
def prediction_counts(spark, folder):
    return profile.prediction_counts(scorecard(spark, folder))


@query("model_roundtrip")
def model_roundtrip(spark, folder):
    """A model and its loaded copy give every user the same score."""
    train, test = split.hash_split(model_table(spark, folder))
    path = new_folder(spark, "model")
    model = training.fit_one(train, CLASSIFIERS["rf"]())
    training.save_model(model, path)
    return facts(scoring.score_users(model, test), scoring.score_users(training.load_model(path), test))


@query("score_users")
def score_users(spark, folder):
    """The scoring of the command line: saved, loaded, applied; raw scores and probabilities per class."""
    train, test = split.hash_split(model_table(spark, folder))
    path = new_folder(spark, "model")
    training.save_model(training.fit_one(train, CLASSIFIERS["gbt"]()), path)
    scored = scoring.score_users(training.load_model(path), test)
    raw, share = vector_to_array("rawPrediction"), vector_to_array("probability")
    right = (F.size(raw) == 2) & (F.size(share) == 2) & (F.abs(share[0] + share[1] - 1) < 1e-9)
    return scored.select("userId", "label", right.alias("two_classes"))


def _search_rows(spark, searches: list[training.Search], folds: int, rechecked: bool) -> DataFrame:
    rows = [
        (s.family, i, ", ".join(f"{k}={v}" for k, v in params.items()), folds, 0.0 <= area <= 1.0, rechecked)
        for s in searches
        for i, (params, area) in enumerate(zip(s.params, s.areas))
    ]
    return spark.createDataFrame(
        rows, "family string, combination int, params string, folds int, valid boolean, rechecked boolean"
    )


def _rechecked(train, family: training.Family, search: training.Search, folds: int) -> bool:
    """Whether the area of the best combination comes out again when its folds are fitted anew and measured by ``metrics``."""
    best = search.areas.index(search.best_area)
    return abs(training.fold_area(train, family, family.grid[best], folds=folds) - search.best_area) < 1e-9


@query("cv_metrics_lr", family=training.lr_study_family)
@query("cv_metrics_gbt", family=training.gbt_family)
def cv_metrics(spark, folder, family):
    train, _ = split.hash_split(model_table(spark, folder))
    search = training.grid_search(train, family(), folds=5)
    return _search_rows(spark, [search], 5, _rechecked(train, family(), search, 5))


@query("select_best_model")
def select_best_model(spark, folder):
    """The whole search over three families; the chosen one must have the largest mean area."""
    train, _ = split.hash_split(model_table(spark, folder))
    searches = training.search_all(train, save_to=new_folder(spark, "models"))
    best = training.select_best(searches)
    assert best.best_area == max(a for s in searches for a in s.areas)
    family = {f.name: f for f in training.families()}[best.family]
    return _search_rows(spark, searches, 3, _rechecked(train, family, best, 3))


#: Eight directions between the axes, churned in turns of two: trees tell them apart, a straight line orders at most three quarters
#: of the pairs rightly.
PLANTED = [0, 0, 1, 1, 0, 0, 1, 1]


def planted_users(spark, folder) -> DataFrame:
    """The users with a label that two planted features decide, and one that nothing decides."""
    users = user_table(spark, folder).select("userId")
    turn = split.key_share("userId", len(PLANTED), salt="planted:")
    angle = (turn + 0.5) * (math.pi / 2 / len(PLANTED))
    label = F.get(F.array(*[F.lit(float(v)) for v in PLANTED]), turn)
    chance = split.key_share("userId", 2, salt="chance:").cast("double")
    planted = users.select("userId", F.cos(angle).alias("east"), F.sin(angle).alias("north"), label.alias("label"), chance.alias("chance"))
    return stored(planted, "planted-users")


@query("planted_search")
def planted_search(spark, folder):
    """Search and selection on planted data with one right answer: trees win with every pair in order, a straight line can't."""
    train, test = split.hash_split(planted_users(spark, folder))
    columns = ["east", "north"]
    lr = training.logistic_regression(maxIter=20)
    families = [training.Family("LogisticRegression", lr, [{lr.regParam: 0.0}, {lr.regParam: 0.1}]), training.dt_family()]
    searches = training.search_all(train, families, columns)
    best = training.select_best(searches)
    scores = {r["model"]: r for r in scoring.evaluate_models({s.family: s.model for s in searches}, test).collect()}
    rows = []
    for s in searches:
        found = scores[s.family]
        perfect = abs(s.best_area - 1) < 1e-9 and found["area_under_roc"] == 1.0 and found["matched"] == found["total"]
        rows.append((s.family, s.family == best.family, perfect, s.best_area > 0.5, found["total"]))
    return spark.createDataFrame(rows, "family string, won boolean, perfect boolean, above_chance boolean, total long")


@query("chance_labels")
def chance_labels(spark, folder):
    """Labels that no feature decides: on new users no family is more than five standard errors away from an area of one half."""
    users = model_table(spark, folder).drop("label").withColumn("label", split.key_share("userId", 2, salt="chance:").cast("double"))
    train, test = split.hash_split(stored(users, "chance-users"), 50)
    models = {kind: training.fit_one(train, CLASSIFIERS[kind]()) for kind in ("lr", "dt")}
    sides = {r["label"]: r["count"] for r in test.groupBy("label").count().collect()}
    error = math.sqrt((sides[0.0] + sides[1.0] + 1) / (12 * sides[0.0] * sides[1.0]))
    rows = [(r["model"], r["total"], abs(r["area_under_roc"] - 0.5) <= 5 * error) for r in scoring.evaluate_models(models, test).collect()]
    return spark.createDataFrame(rows, "model string, total long, near_half boolean")


def _three_models(spark, folder) -> tuple[dict[str, PipelineModel], DataFrame]:
    train, test = split.hash_split(model_table(spark, folder), 10)
    return {kind: training.fit_one(train, CLASSIFIERS[kind]()) for kind in ("gbt", "lr", "rf")}, test


@query("model_auc_comparison")
def model_auc_comparison(spark, folder):
    """Test area and accuracy of three models: users of the test part, and whether the measures are possible."""
    models, test = _three_models(spark, folder)
    rows = scoring.evaluate_models(models, test)
    possible = F.col("area_under_roc").between(0, 1) & (F.col("accuracy") * F.col("total") - F.col("matched") < 1e-6)
    agree = _areas_agree(models, test, rows)
    return rows.select("model", "total", possible.alias("possible"), F.lit(agree).alias("areas_agree"))


def _areas_agree(models: dict[str, PipelineModel], test: DataFrame, rows: DataFrame) -> bool:
    """Whether the areas of the evaluator are those that ``metrics`` finds from the churn probabilities."""
    own = {n: metrics.area_under_roc(stored(scoring.scorecard_of(m, test), "model-card")).first()[0] for n, m in models.items()}
    return all(_same_area(own[r["model"]], r["area_under_roc"]) for r in rows.collect())


def _same_area(own: float | None, other: float) -> bool:
    """Without both classes among the rows there is no area: ``metrics`` gives null, the evaluator some number."""
    return own is None or abs(own - other) < 1e-9


@query("evaluate_winners")
def evaluate_winners(spark, folder):
    """Tuned winners on the test part, fitted on standardised features learnt from the training part alone."""
    train, test = split.hash_split(model_table(spark, folder))
    searches = [training.grid_search(train, f(), folds=3, scale=True) for f in (training.rf_family, training.dt_family)]
    models = {s.family: s.model for s in searches}
    rows = scoring.evaluate_models(models, test)
    agree = _areas_agree(models, test, rows)
    return rows.select("model", "total", F.col("area_under_roc").between(0, 1).alias("possible"), F.lit(agree).alias("areas_agree"))


@query("model_curve_ends")
def model_curve_ends(spark, folder):
    """The curves of a fitted model: ends of the ROC curve, the largest recall, whether the largest F-measure is possible, and
    whether the exact area is that of the evaluator."""
    train, test = split.hash_split(model_table(spark, folder))
    model = training.fit_one(train, CLASSIFIERS["rf"]())
    card = stored(scoring.scorecard_of(model, test), "model-card")
    roc, pr, f1 = metrics.roc_curve(card), metrics.pr_curve(card), metrics.f_measure_curve(card)
    ends = roc.agg(F.min("FPR").alias("first_fpr"), F.max("TPR").alias("last_tpr"))
    area = training.evaluator().evaluate(scoring.score_users(model, test))
    ends = ends.withColumn("area_agrees", F.lit(_same_area(metrics.area_under_roc(card).first()[0], area)))
    recall = pr.agg(F.max("recall").alias("last_recall"))
    best = f1.agg(F.max("F_Measure").between(0, 1).alias("f_measure_possible"))
    return ends.join(recall).join(best)  # one row each


@query("compare_model_predictions")
def compare_model_predictions(spark, folder):
    """Three prediction tables joined by user; the models are fixed formulas here, so the rows have one right answer."""
    users = user_table(spark, folder)
    number = F.col("num_songs") * 37 + F.col("days_since_registration") * 11 + F.col("num_active_days") * 5
    tables = {
        name: users.select("userId", (number % modulus >= modulus // 2).cast("double").alias("prediction"))
        for name, modulus in (("gbt", 97), ("lr", 89), ("rf", 83))
    }
    return scoring.join_predictions(tables, users)


@query("score_silver")
def score_silver(spark, folder):
    train, _ = split.hash_split(model_table(spark, folder))
    model = training.fit_one(train, CLASSIFIERS["gbt"]())
    counted = scoring.score_silver(model, lake.read_zone(spark, _zone(spark, folder)))
    return counted.agg(F.sum("users").alias("users"), F.count_if(~F.col("prediction").isin(0, 1)).alias("other_classes"))
