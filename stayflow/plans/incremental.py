"""A user table that a delivery of new events brings up to date without reading the log again.

The state keeps, per user and day, what ``user_features`` needs of that day, and per user, song or artist the day of its last play.
Both add up over deliveries: counts and play time by sum, levels and registration by minimum and maximum, last plays by maximum. So the
order in which events arrive does not matter, and late events are merged like all others. What is delivered must be new: insert-only
merging sees to that.

Users are dealt to ``buckets`` by a hash. A delivery reads and writes only the buckets of its users and, within them, rebuilds only the
users it touches; the others are carried over. Folders are ``<base>/<table>/version=<delivery>/bucket=<b>``, and a small
table ``commits/version=<delivery>`` says in which version each bucket is current and which tables have rows of it. It is written last, so readers see a delivery whole or
not at all, and a delivery that failed half-way is written again over its own folders. A delivery that is already in the commits
changes nothing, so a replayed batch counts once. One delivery at a time may be applied.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.maps import COUNTS, total_counts
from ..operators.features import users_from_daily
from ..schema import ALL_DAYS, CHURN_PAGE, PAGE_MAP, PAID_LEVEL, SONG_PAGE, user_table_schema
from ..sources.versions import numbered, read_newest, remove_folder, versions

BUCKETS = 64
KEPT_COMMITS = 2
DAYS = (
    f"userId string, event_date date, {PAGE_MAP} {COUNTS}, play_length double, level string, paid int, registered date, "
    "unregistered long, bucket int"
)
ITEMS = "userId string, kind string, item string, last_play date, bucket int"
COMMIT = "bucket int, current long, buckets int, held array<string>"


def bucket_of(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def day_state(dated: DataFrame) -> DataFrame:
    """One row per user and day of dated events. A hot user's day is combined by page before it comes together."""
    is_play = F.col("page") == SONG_PAGE
    by_page = dated.groupBy("userId", "event_date", "page").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.when(is_play, F.col("length"))).alias("play_length"),
        F.min("level").alias("level"),
        F.max((F.col("level") == PAID_LEVEL).cast("int")).alias("paid"),
        F.min("registration_date").alias("registered"),
        F.count_if(F.col("registration_date").isNull()).alias("unregistered"),
    )
    entry = F.struct(F.col("page").alias("key"), F.col("events").alias("value"))
    pages = F.map_from_entries(F.collect_list(F.when(F.col("page").isNotNull(), entry)))
    return _merged_days(by_page, pages)


def _merged_days(parts: DataFrame, pages: Column) -> DataFrame:
    return parts.groupBy("userId", "event_date").agg(
        pages.alias(PAGE_MAP),
        F.sum("play_length").alias("play_length"),
        F.min("level").alias("level"),
        F.coalesce(F.max("paid"), F.lit(0)).alias("paid"),
        F.min("registered").alias("registered"),
        F.sum("unregistered").alias("unregistered"),
    )


def item_state(dated: DataFrame) -> DataFrame:
    """The day of the last play of each user's songs and artists."""
    plays = dated.where(F.col("page") == SONG_PAGE)
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("item")) for kind in ("song", "artist")])
    items = plays.select("userId", "event_date", F.inline(pairs)).where("item is not null")
    return _merged_items(items.withColumnRenamed("event_date", "last_play"))


def _merged_items(items: DataFrame) -> DataFrame:
    return items.groupBy("userId", "kind", "item").agg(F.max("last_play").alias("last_play"))


def daily_from_state(days: DataFrame, items: DataFrame) -> DataFrame:
    """Rows as ``daily_activity`` gives them, with the map of pages."""
    last_plays = items.groupBy("userId", F.col("last_play").alias("event_date")).agg(
        *[F.nullif(F.count_if(F.col("kind") == kind), F.lit(0)).alias(f"{kind}s") for kind in ("song", "artist")]
    )
    same = days["userId"].eqNullSafe(last_plays["userId"]) & days["event_date"].eqNullSafe(last_plays["event_date"])
    joined = days.join(last_plays, same, "left").select(days["*"], "songs", "artists")
    return joined.withColumns(
        {
            SONG_PAGE: F.element_at(PAGE_MAP, F.lit(SONG_PAGE)),
            CHURN_PAGE: F.element_at(PAGE_MAP, F.lit(CHURN_PAGE)),
            "songs": F.coalesce("songs", F.lit(0)),
            "artists": F.coalesce("artists", F.lit(0)),
        }
    )


class UserState:
    """The stored state under ``base``; ``days`` and ``churn`` are those of the user table that it keeps."""

    def __init__(
        self, spark: SparkSession, base: str, days: int = ALL_DAYS, buckets: int = BUCKETS, churn: bool = True, keep_inactive: bool = False
    ):
        self.spark, self.base, self.days, self.churn, self.keep_inactive = spark, base, days, churn, keep_inactive
        known = self.commits().head(1)
        self.buckets = known[0]["buckets"] if known else buckets  # fixed by the first delivery
        users = T.StructType(
            [f if f.name != PAGE_MAP else T.StructField(PAGE_MAP, T.MapType(T.StringType(), T.LongType()))
             for f in user_table_schema([PAGE_MAP], churn)]
        ).add("bucket", T.IntegerType())
        self.schemas = {"days": T.StructType.fromDDL(DAYS), "items": T.StructType.fromDDL(ITEMS), "users": users}

    def commits(self) -> DataFrame:
        """Which version of each bucket is current: one row per bucket that has users."""
        return read_newest(self.spark, f"{self.base}/commits", COMMIT)

    def current(self) -> dict[int, tuple[int, list[str]]]:
        return {r["bucket"]: (r["current"], r["held"]) for r in self.commits().collect()}

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The current rows of a table; only the folders of the wanted buckets are listed and read."""
        schema, current = self.schemas[table], self.current()
        wanted = current if buckets is None else [b for b in buckets if b in current]
        places = [(b, *current[b]) for b in wanted]
        folders = [f"{self.base}/{table}/version={version}/bucket={b}" for b, version, held in places if table in held]
        if not folders:
            return self.spark.createDataFrame([], schema)
        placed = T.StructType([*schema, T.StructField("version", T.LongType())])
        reader = self.spark.read.schema(placed).option("basePath", f"{self.base}/{table}")
        return reader.parquet(*folders).drop("version")

    def users(self) -> DataFrame:
        """The user table, page counts as a map."""
        return self.read("users").drop("bucket")

    def apply(self, dated: DataFrame, delivery: int) -> bool:
        """Merge new dated events; False if this delivery is in already."""
        done = versions(self.spark, f"{self.base}/commits")
        if delivery in done or (done and delivery < done[-1]):
            return False
        place = bucket_of(F.col("userId"), self.buckets)
        fresh_days, fresh_items = (s.withColumn("bucket", place) for s in (day_state(dated), item_state(dated)))
        self._write("incoming", fresh_days, delivery)
        fresh_days = self._written("incoming", DAYS, delivery)
        touched = sorted(r["bucket"] for r in fresh_days.select("bucket").distinct().collect())
        if touched:
            self._merge(fresh_days, fresh_items, touched, delivery)
        self._commit(touched, delivery)
        return True

    def _merge(self, fresh_days: DataFrame, fresh_items: DataFrame, touched: list[int], delivery: int) -> None:
        place = bucket_of(F.col("userId"), self.buckets)
        both = self.read("days", touched).unionByName(fresh_days)
        self._write("days", _merged_days(both, total_counts(F.collect_list(PAGE_MAP))).withColumn("bucket", place), delivery)
        both = self.read("items", touched).unionByName(fresh_items)
        self._write("items", _merged_items(both).withColumn("bucket", place), delivery)

        names = fresh_days.select("userId").distinct()
        days, items = (self._written(t, self.schemas[t], delivery).drop("bucket") for t in ("days", "items"))
        daily = daily_from_state(days.join(names, "userId", "left_semi"), items.join(names, "userId", "left_semi"))
        pages = [SONG_PAGE, CHURN_PAGE]
        rebuilt = users_from_daily(daily, self.days, pages, self.keep_inactive, self.churn, page_map=True)
        others = self.read("users", touched).join(names, "userId", "left_anti")
        self._write("users", rebuilt.withColumn("bucket", place).unionByName(others), delivery)

    def _write(self, table: str, df: DataFrame, delivery: int) -> None:
        columns = [c for c in df.columns if c != "bucket"]
        rows = df.select(*[F.col(f"`{c}`") for c in columns], "bucket").hint("rebalance", "bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.base}/{table}/version={delivery}")

    def _written(self, table: str, schema: T.StructType | str, delivery: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.base}/{table}/version={delivery}")

    def _commit(self, touched: list[int], delivery: int) -> None:
        present = {t: set(numbered(self.spark, f"{self.base}/{t}/version={delivery}", "bucket")) for t in self.schemas}
        fresh = {b: (delivery, [t for t in self.schemas if b in present[t]]) for b in touched}
        rows = [(b, version, self.buckets, held) for b, (version, held) in sorted({**self.current(), **fresh}.items())]
        path = f"{self.base}/commits/version={delivery}"
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("overwrite").parquet(path)
        remove_folder(self.spark, f"{self.base}/incoming/version={delivery}")

    def clean(self, kept: int = KEPT_COMMITS) -> int:
        """Remove the folders that none of the last ``kept`` commits names; returns how many were removed."""
        numbers = versions(self.spark, f"{self.base}/commits")
        last, old = numbers[-kept:], numbers[:-kept]
        used = set()
        for number in last:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.base}/commits/version={number}").collect()
            used |= {(r["bucket"], r["current"]) for r in rows}
        removed = 0
        for number in old:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.base}/commits/version={number}").collect()
            for bucket, version in {(r["bucket"], r["current"]) for r in rows} - used:
                for table in self.schemas:
                    remove_folder(self.spark, f"{self.base}/{table}/version={version}/bucket={bucket}")
                removed += 1
            remove_folder(self.spark, f"{self.base}/commits/version={number}")
        return removed
