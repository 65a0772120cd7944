"""Running counts over a stream of lines, and their sum with a static baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import parse_json_lines
from ..sources.versions import remove_folder, versions
from .runs import triggered

COUNT_SCHEMA = "Page string, count bigint"
#: Batches of changes between two whole tables.
FOLD = 32


def token_counts(lines: DataFrame) -> DataFrame:
    """Lines cut at blanks, occurrences per piece."""
    return lines.select(F.explode(F.split("value", " ")).alias("Page")).groupBy("Page").count()


def page_counts(lines: DataFrame) -> DataFrame:
    """Events per page of JSON lines; page names with blanks stay whole."""
    return parse_json_lines(lines).where(F.col("page").isNotNull()).groupBy(F.col("page").alias("Page")).count()


def keep_latest(counts: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the complete results of a streaming count under ``path``, one folder per batch.

    A reader takes the newest folder whose write has ended, so it never meets a half-written table. The two folders
    before the newest stay for readers that have begun; older ones are emptied.
    """

    def write(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        if batch >= 3:
            result.limit(0).write.mode("overwrite").parquet(f"{path}/batch={batch - 3}")

    writer = (
        counts.writeStream.queryName("PageCount")
        .outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, every).start()


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete result; a folder is complete once its success mark is there."""
    batches = versions(spark, path, "batch")
    if not batches:
        return spark.createDataFrame([], COUNT_SCHEMA)
    return spark.read.schema(COUNT_SCHEMA).parquet(f"{path}/batch={batches[-1]}")


def keep_changes(counts: DataFrame, path: str, checkpoint: str, every: str | None = None, fold: int = FOLD) -> StreamingQuery:
    """Keep a streaming count by its changes: a batch writes the new counts of the keys that it has changed, and no others.

    ``path/changes/batch=<n>`` has the changes of a batch. After ``fold`` of them, the newest count of every key is written to
    ``path/whole/batch=<n>`` and the changes up to there are removed, so a reader never has more than ``fold`` of them to merge and a
    key is rewritten once in ``fold`` batches. Folders are complete or not read, and a replayed batch writes its own folder again.
    """

    def write(result: DataFrame, batch: int) -> None:
        spark = result.sparkSession
        result.write.mode("overwrite").parquet(f"{path}/changes/batch={batch}")
        done = versions(spark, f"{path}/whole", "batch")
        since = [b for b in versions(spark, f"{path}/changes", "batch") if not done or b > done[-1]]
        if len(since) >= fold:
            changed_counts(spark, path).write.mode("overwrite").parquet(f"{path}/whole/batch={batch}")
            for old in since:
                remove_folder(spark, f"{path}/changes/batch={old}")
            for old in done[:-1]:  # the last one stays for readers that have begun
                remove_folder(spark, f"{path}/whole/batch={old}")

    writer = (
        counts.writeStream.queryName("ChangedCount")
        .outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, every).start()


def changed_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of every key of ``keep_changes``."""
    done = versions(spark, f"{path}/whole", "batch")[-1:]
    since = [b for b in versions(spark, f"{path}/changes", "batch") if not done or b > done[0]]
    parts = [f"{path}/whole/batch={b}" for b in done] + [f"{path}/changes/batch={b}" for b in since]
    if not parts:
        return spark.createDataFrame([], COUNT_SCHEMA)
    rows = spark.read.schema(COUNT_SCHEMA).parquet(*parts)
    # Counts only grow, so the newest one is the largest.
    return rows.groupBy("Page").agg(F.max("count").alias("count"))


def live_totals(baseline: DataFrame, counts: DataFrame) -> DataFrame:
    """Baseline ``(Page, Cnt)`` plus streamed ``(Page, count)``; pages that are only in the stream are dropped."""
    streamed = counts.select("Page", F.col("count").alias("streamed"))
    return baseline.join(streamed, "Page", "left").select(
        "Page", (F.col("Cnt") + F.coalesce("streamed", F.lit(0))).alias("count")
    )
