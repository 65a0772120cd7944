"""Tables kept as numbered folders. A reader takes the newest version whose write has ended, so it never meets a missing or
half-written table; the version before stays for readers that have begun."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEPT = 2


def _system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def numbered(spark: SparkSession, path: str, key: str, inside: str = "") -> list[int]:
    """Numbers of the folders ``<key>=<number>`` that hold a file named ``inside``, in order."""
    system, folder = _system(spark, f"{path}/{key}=*{inside}")
    found = [f.getPath().getParent() if inside else f.getPath() for f in system.globStatus(folder) or []]
    return sorted(int(f.getName().removeprefix(f"{key}=")) for f in found)


def versions(spark: SparkSession, path: str, key: str = "version") -> list[int]:
    """Numbers of the complete versions, oldest first; a version is complete once its success mark is there."""
    return numbered(spark, path, key, "/_SUCCESS")


def sizes_below(spark: SparkSession, path: str, depth: int) -> dict[str, list[int]]:
    """Sizes of the data files of each folder ``depth`` levels below ``path``, by the folder's relative name."""
    system, root = _system(spark, path)
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "/".join(["*=*"] * depth + ["[!_.]*"]))
    base = system.makeQualified(root).toString().rstrip("/") + "/"
    found: dict[str, list[int]] = {}
    for status in system.globStatus(pattern) or []:
        if status.isFile():
            found.setdefault(status.getPath().getParent().toString().removeprefix(base), []).append(status.getLen())
    return found


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _system(spark, path)
    return system.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    system, folder = _system(spark, path)
    system.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing one of that name."""
    system, file = _system(spark, path)
    out = system.create(file, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_version(df: DataFrame, path: str, version: int | None = None, kept: int = KEPT) -> int:
    """Write the next version (or a given one, over what an interrupted attempt has left) and remove all but the last ``kept``."""
    spark = df.sparkSession
    known = versions(spark, path)
    number = (known[-1] + 1 if known else 0) if version is None else version
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in [v for v in known if v < number][: -(kept - 1) or None]:
        remove_folder(spark, f"{path}/version={old}")
    return number


def read_newest(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The newest complete version; without one, an empty table of ``schema``."""
    known = versions(spark, path)
    if not known:
        if schema is None:
            raise FileNotFoundError(f"no complete version in {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{path}/version={known[-1]}")
