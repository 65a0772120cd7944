"""Event zones kept as Parquet folders."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DAY_PARTITION, ZONE_SCHEMA
from ..session import new_folder
from .versions import exists, remove_folder, sizes_below, write_text

FILE_BYTES = 128 << 20
#: Days that one job packs.
DAYS_PER_JOB = 256
FOLLOWED = "_followed"


def write_zone(events: DataFrame, path: str, mode: str = "append", partition: Sequence[str] = DAY_PARTITION) -> None:
    """Write events partitioned by day.

    The rebalance hint brings a day's rows together, so that few files are written, and splits a day that is too
    big for one task.
    """
    balanced = events.hint("rebalance", *partition)
    balanced.write.mode(mode).partitionBy(*partition).parquet(path)


def read_zone(spark: SparkSession, path: str, schema: T.StructType = ZONE_SCHEMA) -> DataFrame:
    """Read a zone with its own schema: without it month ``01`` would come back as the number 1."""
    return spark.read.schema(schema).parquet(path)


def zone_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("x int").parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def existing_folders(
    spark: SparkSession, path: str, values: Iterable[Sequence[str]], partition: Sequence[str] = DAY_PARTITION
) -> list[str]:
    """The folders of some partitions of a zone, as far as they are there."""
    folders = ["/".join([path, *[f"{p}={v}" for p, v in zip(partition, value)]]) for value in values]
    return [f for f in folders if exists(spark, f)]


def read_folders(spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType = ZONE_SCHEMA) -> DataFrame:
    """The rows of some folders of a zone. They are given to the scan, so no other folder is listed."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_partitions(
    spark: SparkSession,
    path: str,
    values: Iterable[Sequence[str]],
    partition: Sequence[str] = DAY_PARTITION,
    schema: T.StructType = ZONE_SCHEMA,
) -> DataFrame:
    """The rows of some partitions of a zone."""
    return read_folders(spark, path, existing_folders(spark, path, values, partition), schema)


def read_days(spark: SparkSession, path: str, days: Sequence[str], schema: T.StructType = ZONE_SCHEMA) -> DataFrame:
    """The rows of some days (``yyyy-MM-dd``) of a zone that is partitioned by year, month and day."""
    return read_partitions(spark, path, [d.split("-") for d in days], DAY_PARTITION, schema)


def mark_followed(spark: SparkSession, path: str) -> None:
    """Say that a stream takes every new file of a zone for new rows."""
    if not exists(spark, f"{path}/{FOLLOWED}"):
        write_text(spark, f"{path}/{FOLLOWED}", "new files of this folder are read as new rows")


def pack_days(
    spark: SparkSession,
    path: str,
    file_bytes: int = FILE_BYTES,
    partition: Sequence[str] = DAY_PARTITION,
    schema: T.StructType = ZONE_SCHEMA,
) -> list[str]:
    """Pack the small files of each day into one file per ``file_bytes``; returns the folders of the days that were packed.

    Only days with more files than that are read and replaced, a limited number of days per job. Their rows are first copied to the
    shared folder, then take the days' place (``partitionOverwriteMode=dynamic``, which leaves all other days as they are), so a
    job that fails leaves the day as it was or as it is to be. No query may write to the zone meanwhile. A zone that a stream
    follows file by file is refused: the packed files would be new rows to it.
    """
    if exists(spark, f"{path}/{FOLLOWED}"):
        raise ValueError(f"a stream follows the files of {path}; they can't be replaced")
    wanted = {}
    for folder, sizes in sizes_below(spark, path, len(partition)).items():
        files = max(1, -(-sum(sizes) // file_bytes))
        if len(sizes) > files:
            wanted[folder] = files
    folders = sorted(wanted)
    for at in range(0, len(folders), DAYS_PER_JOB):
        _pack(spark, path, {f: wanted[f] for f in folders[at : at + DAYS_PER_JOB]}, partition, schema)
    return folders


def _pack(spark: SparkSession, path: str, wanted: dict[str, int], partition: Sequence[str], schema: T.StructType) -> None:
    values = {folder: [part.split("=", 1)[1] for part in folder.split("/")] for folder in wanted}
    copy = new_folder(spark, "packed")
    read_partitions(spark, path, values.values(), partition, schema).write.parquet(copy)
    rows = spark.read.schema(schema).parquet(copy)
    # One row per day of this job, so at most DAYS_PER_JOB.
    files = spark.createDataFrame([(*values[f], n) for f, n in wanted.items()], [*partition, "_files"])
    dealt = rows.join(F.broadcast(files), list(partition)).select(*rows.columns, "_files")
    share = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in partition]), F.col("_files"))
    # A fixed number of partitions: adaptive execution would split or merge what is to become one file.
    together = dealt.withColumn("_file", share).repartition(sum(wanted.values()), *partition, "_file").drop("_files", "_file")
    writer = together.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition).parquet(path)
    remove_folder(spark, copy)
