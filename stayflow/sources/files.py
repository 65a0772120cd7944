"""JSON, CSV and text files at the edges of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import BROKEN, parse_json_checked
from ..schema import EVENT_SCHEMA, user_table_schema


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event rows of JSON-lines files; the schema is given, so no job runs to infer it."""
    return spark.read.schema(EVENT_SCHEMA).json(path)


def read_events_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The events of JSON-lines files, and the raw text of the lines that do not fit (column ``raw``).

    A line of which only some fields do not fit is in both: with these fields null, and as it came.
    """
    checked = parse_json_checked(read_lines(spark, path))
    broken = F.col(BROKEN)
    events = checked.where(broken.isNull() | F.col("userId").isNotNull() | F.col("ts").isNotNull())
    return events.drop(BROKEN), checked.where(broken.isNotNull()).select(broken.alias("raw"))


def read_user_table_checked(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """User rows of CSV files, and the raw text of the rows that do not fit the header or the types (column ``raw``).

    All files have the same header. A quoted value that holds a line break does not fit.
    """
    fitting = user_csv_schema(spark, path, schema)
    # Line by line: a scan of columns does not look at the ones that a query leaves out, nor notice that they do not fit.
    lines = read_lines(spark, path)
    header = lines.first()
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    wide = T.StructType([*fitting, T.StructField(BROKEN, T.StringType())])
    parsed = lines.where(F.col("value") != F.lit(header["value"] if header else "")).where(F.trim("value") != "")
    rows = parsed.select("value", F.from_csv("value", wide.toDDL(), options).alias("row"))
    broken = F.col(f"row.{BROKEN}")
    users = rows.where(broken.isNull()).select("row.*").drop(BROKEN)
    return users, rows.where(broken.isNotNull()).select(F.col("value").alias("raw"))


def read_user_table(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False) -> DataFrame:
    """User rows of CSV files with a header line.

    With ``infer`` the types are guessed from the data, which costs a pass over it. The columns of the given
    schema are found by their names in the header, so a file may hold fewer of them or another order. Unknown columns
    between the paid days and the level are page counts; other unknown columns are texts.
    """
    if infer:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(user_csv_schema(spark, path, schema)).csv(path, header=True)


def user_csv_schema(spark: SparkSession, path: str, schema: T.StructType | None = None) -> T.StructType:
    """The types of the columns that the header names."""
    wanted = {f.name: f for f in (schema or user_table_schema()).fields}
    header = spark.read.csv(path, header=True).columns
    place = {name: i for i, name in enumerate(header)}
    pages = range(place.get("num_active_days_paid", len(header)), place.get("current_level", 0))
    kinds = {name: T.LongType() if i in pages else T.StringType() for name, i in place.items()}
    return T.StructType([wanted.get(name, T.StructField(name, kinds[name])) for name in header])


def write_user_table(users: DataFrame, path: str, files: int | None = None, mode: str = "error") -> None:
    """CSV files with a header line; ``files`` fixes their number, by default the partitions decide.

    The rows are shuffled to the wanted number, so that the work before the write keeps all of its tasks.
    """
    out = users.repartition(files) if files else users
    out.write.mode(mode).csv(path, header=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """Newly arrived text files as a stream of lines in the column ``value``; a batch is bounded by files or by bytes."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    elif bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)
