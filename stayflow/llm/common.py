"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder

#: A-Z to a-z; every byte outside 0-9, a-z and 0x80-0xFF to a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: A-Z to a-z and nothing else.
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The learning part: remainder of crc32(doc_id as text) is not 0.
HELD_OUT_FOLDS = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Shuffle files of a finished write go at once instead of when the driver happens to collect its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Nobody waits for an empty ``_SUCCESS`` file of an intermediate table. On a local or mounted folder the driver starts processes
#: that set its permissions, and each of them counts as a second driver for a moment.
_MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors, and gives the optimiser
    the real size, so that it broadcasts only what is small."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.option(_MARKER, "false").parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(False))


def words_of(data: bytes | None) -> list[bytes]:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    return data.translate(WORD_BYTES).split() if data else []

