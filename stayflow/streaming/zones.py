"""Raw, bronze and silver zones of the streaming lake, the user table kept from silver, and the lines that did not make it.

Each zone is written by one query with its own checkpoint. A batch of raw lines is parsed once and written as one numbered folder per
zone: bronze by day, rejected rows (a user, but no usable time, so no place in a zone of days) and broken lines as they came. A folder
that is complete is not written again, so a replayed batch adds nothing. Silver inserts a micro-batch's new keys only (nulls in a
key are equal), so a batch that is replayed after a failure, even half written, adds nothing twice. Batches are bounded by bytes, since
the size of a file depends on how the zone before was written. One query at a time may write to a silver folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import BROKEN, add_date_parts, parse_json_checked, valid_events
from ..operators.merge import EVENT_KEY, dedup_events, missing_from
from ..plans.incremental import UserState
from ..schema import ALL_DAYS, DAY_PARTITION, EVENT_SCHEMA, ZONE_SCHEMA
from ..sources.files import stream_lines
from ..sources.lake import existing_folders, mark_followed, read_folders, read_zone, write_zone, zone_exists
from ..sources.versions import versions
from .runs import drain, triggered

BYTES_PER_BATCH = 4 << 30
#: Key columns from which the day of a row follows.
DAY_OF_KEY = {"ts", "event_date"}
#: Numbered folders of bronze, rejected and broken rows.
BATCH = "batch"
BRONZE_SCHEMA = T.StructType([*ZONE_SCHEMA, T.StructField(BATCH, T.LongType())])


@dataclass(frozen=True)
class Lake:
    """Folders of the zones under one base path."""

    base: str

    def data(self, zone: str) -> str:
        return f"{self.base}/{zone}/data"

    def checkpoint(self, zone: str) -> str:
        return f"{self.base}/{zone}/checkpoint"


def land_raw(lines: DataFrame, lake: Lake, every: str | None = None) -> StreamingQuery:
    """Append incoming lines to the raw text zone."""
    writer = (
        lines.select("value")
        .writeStream.queryName("raw")
        .outputMode("append")
        .format("text")
        .option("path", lake.data("raw"))
        .option("checkpointLocation", lake.checkpoint("raw"))
    )
    return triggered(writer, every).start()


def bronze_rows(lines: DataFrame) -> DataFrame:
    """Parse lines, drop the rows without a user, add the calendar columns."""
    return lines.transform(parse_json_checked).drop(BROKEN).transform(valid_events).transform(add_date_parts)


def has_day() -> Column:
    return F.col("event_date").isNotNull()


def write_once(rows: DataFrame, path: str, number: int, write: Callable[[DataFrame, str], None]) -> None:
    """Write a batch's folder unless it is complete; what an interrupted attempt has left is replaced."""
    if number not in versions(rows.sparkSession, path, BATCH):
        write(rows, f"{path}/{BATCH}={number}")


def split_batch(lines: DataFrame, number: int, lake: Lake) -> None:
    """Parse a batch of raw lines once, and write its bronze, rejected and broken rows.

    Days are brought together before they are written, and a day that is too big for one task is split, so a batch with a
    single day is written by several tasks.
    """
    parsed = lines.transform(parse_json_checked).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dated = parsed.drop(BROKEN).transform(valid_events).transform(add_date_parts)
        write_once(dated.where(has_day()), lake.data("bronze"), number, lambda df, path: write_zone(df, path, "overwrite"))
        rejected = dated.where(~has_day()).select(*EVENT_SCHEMA.names)
        broken = parsed.where(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("raw"))
        for zone, rows in (("rejected", rejected), ("broken", broken)):
            if not rows.isEmpty():
                write_once(rows, lake.data(zone), number, lambda df, path: df.write.mode("overwrite").parquet(path))
    finally:
        parsed.unpersist()


def write_bronze(lines: DataFrame, lake: Lake, every: str | None = None) -> StreamingQuery:
    """Stream raw lines into bronze, the rejected rows and the broken lines."""
    writer = (
        lines.writeStream.queryName("bronze")
        .foreachBatch(lambda batch, number: split_batch(batch, number, lake))
        .option("checkpointLocation", lake.checkpoint("bronze"))
    )
    return triggered(writer, every).start()


def _read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    if not zone_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).drop(BATCH)


def read_rejected(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows that name a user but no usable time."""
    return _read_batches(spark, lake.data("rejected"), EVENT_SCHEMA)


def read_broken(spark: SparkSession, lake: Lake) -> DataFrame:
    """Raw text of the lines that are no JSON of the log's form (column ``raw``)."""
    return _read_batches(spark, lake.data("broken"), "raw string")


def merge_batch(
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = EVENT_KEY,
    dedup: bool = True,
    partition: Sequence[str] = DAY_PARTITION,
) -> None:
    """Insert the batch rows whose key is not yet in the zone.

    Only the folders of the batch's days are listed and read; without any of them all rows are new, and nothing is joined. A batch is
    bounded by its bytes, and so is its list of days. The batch is read twice, the first time for its days only.
    """
    spark = batch.sparkSession
    days = [tuple(r) for r in batch.select(*partition).distinct().toLocalIterator()]
    if not days:
        return
    folders = existing_folders(spark, path, days, partition)
    rows = batch
    if folders and DAY_OF_KEY & set(keys) and partition == DAY_PARTITION:
        # Copies of a key share its day, so known keys can go before the rest is deduplicated.
        rows, folders = missing_from(rows, read_folders(spark, path, folders), keys), []
    if dedup:
        rows = dedup_events(rows, keys)
    if folders:
        on = [*partition, *[k for k in keys if k not in partition]]
        rows = missing_from(rows, read_folders(spark, path, folders), on)
    write_zone(rows, path, partition=partition)


def without_recent_copies(rows: DataFrame, within: str) -> DataFrame:
    """Drop rows that are equal in every column to one that has arrived less than ``within`` before.

    The rows seen are kept as digests in the state store and forgotten by the time of arrival, so no row is ever late, however old
    its events are. Rows of one key with different content pass; which of them stays is decided by the merge. The time of arrival is
    the batch's own time, which a replayed batch has again.
    """
    arrival = F.current_timestamp()
    digest = F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256)
    marked = rows.withColumns({"_arrival": arrival, "_digest": digest}).withWatermark("_arrival", within)
    return marked.dropDuplicatesWithinWatermark(["_digest"]).drop("_arrival", "_digest")


def write_silver(
    spark: SparkSession,
    lake: Lake,
    every: str | None = None,
    keys: Sequence[str] = EVENT_KEY,
    dedup: bool = True,
    bytes_per_batch: int = BYTES_PER_BATCH,
    recent: str | None = None,
) -> StreamingQuery:
    """Stream bronze into silver; ``dedup=False`` keeps copies that arrive within one micro-batch.

    ``recent``, such as ``2 hours``: copies of rows that have arrived within that time are dropped by the state store, before
    the folders of their days are listed or read. It does not change the result, only what is read for it.
    """
    reader = spark.readStream.schema(BRONZE_SCHEMA).option("maxBytesPerTrigger", bytes_per_batch)
    rows = reader.parquet(lake.data("bronze")).drop(BATCH)
    if recent:
        rows = without_recent_copies(rows, recent)
    path = lake.data("silver")

    def insert(batch: DataFrame, _: int) -> None:
        # The merge reads a batch more than once; what the state store has let pass is kept for that.
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK) if recent else batch
        try:
            merge_batch(kept, path, keys, dedup)
        finally:
            if recent:
                kept.unpersist()

    writer = (
        rows.writeStream.queryName("silver")
        .foreachBatch(insert)
        .option("checkpointLocation", lake.checkpoint("silver"))
    )
    return triggered(writer, every).start()


def user_state(spark: SparkSession, lake: Lake, days: int = ALL_DAYS, **options) -> UserState:
    """The user table that ``write_users`` keeps."""
    return UserState(spark, lake.data("users"), days, **options)


def write_users(
    spark: SparkSession,
    lake: Lake,
    every: str | None = None,
    days: int = ALL_DAYS,
    bytes_per_batch: int = BYTES_PER_BATCH,
    **options,
) -> StreamingQuery:
    """Keep the user table up to date with what has been inserted into silver; only the touched users are rebuilt.

    Every file of silver counts once, so silver is marked as followed and ``pack_days`` leaves it alone.
    """
    mark_followed(spark, lake.data("silver"))
    reader = spark.readStream.schema(ZONE_SCHEMA).option("maxBytesPerTrigger", bytes_per_batch)

    def apply(batch: DataFrame, number: int) -> None:
        state = user_state(spark, lake, days, **options)
        if state.apply(batch, number):
            state.clean()

    writer = (
        reader.parquet(lake.data("silver"))
        .writeStream.queryName("users")
        .foreachBatch(apply)
        .option("checkpointLocation", lake.checkpoint("users"))
    )
    return triggered(writer, every).start()


def ingest(
    spark: SparkSession,
    incoming: str,
    lake: Lake,
    keys: Sequence[str] = EVENT_KEY,
    dedup: bool = True,
    files_per_batch: int | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
    recent: str | None = None,
) -> DataFrame:
    """Carry all text files of ``incoming`` through raw and bronze into silver, each exactly once.

    A micro-batch is bounded by bytes; ``files_per_batch`` bounds those of incoming lines by files instead. The raw zone has a file
    per task that landed it, and a few of these would keep as few cores busy, so its batches are always bounded by bytes.
    """
    drain(land_raw(stream_lines(spark, incoming, files_per_batch, bytes_per_batch), lake))
    drain(write_bronze(stream_lines(spark, lake.data("raw"), None, bytes_per_batch), lake))
    if zone_exists(spark, lake.data("bronze")):
        drain(write_silver(spark, lake, None, keys, dedup, bytes_per_batch, recent))
    return read_zone(spark, lake.data("silver"))


def ingest_forever(
    spark: SparkSession, incoming: str, lake: Lake, every: str = "2 seconds", bytes_per_batch: int = BYTES_PER_BATCH
) -> list[StreamingQuery]:
    """Start the queries at an interval; the later ones wait for files of the zone before them."""
    for zone in ("raw", "bronze"):
        ensure_folder(spark, lake.data(zone))
    return [
        land_raw(stream_lines(spark, incoming, None, bytes_per_batch), lake, every),
        write_bronze(stream_lines(spark, lake.data("raw"), None, bytes_per_batch), lake, every),
        write_silver(spark, lake, every, bytes_per_batch=bytes_per_batch),
    ]


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create a folder through the file system that the path belongs to."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
