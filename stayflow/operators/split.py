"""Splits that depend on the key alone, so they survive recomputation and any partition layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_share(key: str = "userId", parts: int = 100, salt: str = "") -> Column:
    """A number from 0 to ``parts`` - 1 from the MD5 of the salted key."""
    digest = F.md5(F.concat(F.lit(salt), F.col(key)))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % parts).cast("int")


def hash_split(df: DataFrame, test_percent: int = 20, key: str = "userId") -> tuple[DataFrame, DataFrame]:
    """Training and test rows; a key is always on the same side."""
    side = key_share(key)
    return df.where(side >= test_percent), df.where(side < test_percent)


def with_fold(df: DataFrame, folds: int, key: str = "userId", column: str = "fold") -> DataFrame:
    return df.withColumn(column, key_share(key, folds, salt="fold:"))
