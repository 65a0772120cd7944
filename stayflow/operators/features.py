"""One row per user: the metric groups one by one, and all of them in a single pass.

``user_features`` reads the log once. Grouping sets reduce it to (user, day, page, level), (user, song) and
(user, artist) rows before the first shuffle, so a user with a huge log is spread over many tasks. A song counts
for the window when its last play falls into it; therefore distinct songs become sums over the days of last
plays, and everything after the first step works on (user, day) rows. The per-user step then sees at most one
row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import named, quoted, ratio, text
from ..functions.dates import span_days, window_start
from ..functions.maps import total_counts
from ..schema import ALL_DAYS, CHURN_PAGE, OTHER_PAGES, PAGE_MAP, PAGES, PAID_LEVEL, SONG_PAGE, user_table_schema

# --- metric groups over events that already carry date_from and date_to -------------------------------------


def user_day_metrics(windowed: DataFrame) -> DataFrame:
    return windowed.groupBy("userId").agg(
        F.count_distinct("event_date").alias("num_active_days"),
        F.min("date_from").alias("date_from"),
        F.max("date_to").alias("date_to"),
        F.min("registration_date").alias("registration_date"),
    )


def _paid_flag(level: Column) -> Column:
    return F.when(level == PAID_LEVEL, 1).otherwise(0)


def user_current_level(windowed: DataFrame) -> DataFrame:
    """Smallest level text on the last active day, so ``free`` wins when both occur."""
    last_day = windowed.where(F.col("event_date") == F.col("date_to"))
    levels = last_day.groupBy("userId").agg(F.min("level").alias("current_level"))
    return levels.withColumn("current_level_paid", _paid_flag(F.col("current_level")))


def user_page_pivot(windowed: DataFrame, pages: Sequence[str] = PAGES) -> DataFrame:
    """Events per user and page, one column per page, null where there are none."""
    counts = [F.expr(f"nullif(count_if({on_page(p, pages)}), 0) AS {named(p)}") for p in pages]
    return windowed.groupBy("userId").agg(*counts)


def on_page(page: str, pages: Sequence[str]) -> str:
    """SQL condition of a page column; ``other_pages`` stands for every page that the list does not name."""
    if page != OTHER_PAGES:
        return f"page = {text(page)}"
    listed = [text(p) for p in pages if p != OTHER_PAGES]
    return f"page NOT IN ({', '.join(listed)})" if listed else "page IS NOT NULL"


def distinct_pages(events: DataFrame) -> list[str]:
    """The page names that occur (runs a job); each is to become a column, which only the driver can name."""
    return [r.page for r in events.where("page is not null").select("page").distinct().orderBy("page").collect()]


def chosen_pages(pages: Sequence[str] | str) -> list[str] | str:
    """A list: these, and one column for all the others; ``auto`` and ``map`` stay."""
    if isinstance(pages, str):
        return pages
    return [*pages, *([] if OTHER_PAGES in pages else [OTHER_PAGES])]


def user_song_metrics(windowed: DataFrame) -> DataFrame:
    plays = windowed.where(F.col("page") == SONG_PAGE)
    return plays.groupBy("userId").agg(
        F.count("page").alias("num_songs"), F.count_distinct("song").alias("num_songs_unique")
    )


def user_artist_metrics(windowed: DataFrame) -> DataFrame:
    plays = windowed.where(F.col("page") == SONG_PAGE)
    return plays.groupBy("userId").agg(
        F.count_distinct("artist").alias("num_artist"), F.sum("length").alias("total_play_length")
    )


def user_paid_days(windowed: DataFrame) -> DataFrame:
    paid = windowed.where(F.col("level") == PAID_LEVEL)
    return paid.groupBy("userId").agg(F.count_distinct("event_date").alias("num_active_days_paid"))


def with_ratios(users: DataFrame) -> DataFrame:
    """Two inclusive day spans and five ratios; a ratio over zero days is null."""
    spans = users.withColumns(
        {
            "days_since_registration": span_days(F.col("registration_date"), F.col("date_to")),
            "days_in_member": span_days(F.col("date_from"), F.col("date_to")),
        }
    )
    return spans.withColumns(
        {
            "active_pct": ratio(F.col("num_active_days"), F.col("days_in_member")),
            "avg_songs_per_day": ratio(F.col("num_songs"), F.col("days_in_member")),
            "avg_songs_per_active_day": ratio(F.col("num_songs"), F.col("num_active_days")),
            "avg_play_length_per_day": ratio(F.col("total_play_length"), F.col("days_in_member")),
            "avg_play_length_per_active_day": ratio(F.col("total_play_length"), F.col("num_active_days")),
        }
    )


# --- all of them in one pass ---------------------------------------------------------------------------------


def _sums(names: Sequence[str]) -> list[Column]:
    return [F.expr(f"sum({named(n)}) AS {named(n)}") for n in names]


def daily_activity(dated: DataFrame, pages: Sequence[str] = PAGES, page_map: bool = False) -> DataFrame:
    """One row per user and day: page counts, play time, level, and the songs and artists last played that day.

    ``page_map`` adds the counts of all pages, whatever they are, as one map.
    """
    is_play = F.col("page") == SONG_PAGE
    events = dated.select(
        "userId",
        "event_date",
        "page",
        "level",
        "registration_date",
        *[F.when(is_play, F.col(c)).alias(c) for c in ("song", "artist", "length")],
    )
    grouped = events.groupingSets(
        [["userId", "event_date", "page", "level"], ["userId", "song"], ["userId", "artist"]],
        "userId",
        "event_date",
        "page",
        "level",
        "song",
        "artist",
    ).agg(
        F.grouping("page").alias("is_item"),
        F.count(F.lit(1)).alias("events"),
        F.sum("length").alias("play_length"),
        F.min("registration_date").alias("registered"),
        F.count_if(F.col("registration_date").isNull()).alias("unregistered"),
        F.max("event_date").alias("last_play"),
    )
    day_row = F.col("is_item") == 0
    by_level = (
        grouped.where(day_row | F.col("song").isNotNull() | F.col("artist").isNotNull())
        .select(
            "userId",
            F.when(day_row, F.col("event_date")).otherwise(F.col("last_play")).alias("event_date"),
            "level",
            "page",
            "song",
            "artist",
            "events",
            *[F.when(day_row, F.col(c)).alias(c) for c in ("play_length", "registered", "unregistered")],
        )
        .groupBy("userId", "event_date", "level")
        .agg(
            *[F.expr(f"sum(CASE WHEN {on_page(p, pages)} THEN events END) AS {named(p)}") for p in pages],
            F.sum("play_length").alias("play_length"),
            F.min("registered").alias("registered"),
            F.sum("unregistered").alias("unregistered"),
            F.count("song").alias("songs"),
            F.count("artist").alias("artists"),
            *([_page_entries("page", "events").alias(PAGE_MAP)] if page_map else []),
        )
    )
    # Few rows per user and day are left, so one task per user is enough from here on.
    return (
        by_level.repartition("userId")
        .groupBy("userId", "event_date")
        .agg(
            F.min("level").alias("level"),
            F.max(_paid_flag(F.col("level"))).alias("paid"),
            F.min("registered").alias("registered"),
            *_sums([*pages, "play_length", "unregistered", "songs", "artists"]),
            *([total_counts(F.collect_list(PAGE_MAP)).alias(PAGE_MAP)] if page_map else []),
        )
    )


def _page_entries(page: str, events: str) -> Column:
    """Aggregate: a map of the rows' pages, each of which occurs in one row."""
    entry = F.struct(F.col(page).alias("key"), F.col(events).alias("value"))
    return F.map_from_entries(F.collect_list(F.when(F.col(page).isNotNull(), entry)))


def users_from_daily(
    daily: DataFrame,
    days: int = ALL_DAYS,
    pages: Sequence[str] = PAGES,
    keep_inactive: bool = False,
    churn: bool = False,
    page_map: bool = False,
) -> DataFrame:
    """Roll ``daily_activity`` rows up to users over each user's last ``days`` days.

    ``page_map``: the page counts are one map, in the place of the columns of ``pages``.
    """
    per_user = Window.partitionBy("userId")
    marked = daily.withColumn("date_to", F.max("event_date").over(per_user))
    if churn:
        # Cancellations count whenever they happened, also before the window.
        marked = marked.withColumn("churn", F.max((F.col(CHURN_PAGE) > 0).cast("int")).over(per_user))
    recent = marked.where(F.datediff("date_to", "event_date") < days)
    earliest = F.date_add(F.max("date_to"), 1 - days)
    users = recent.groupBy("userId").agg(
        F.coalesce(F.sum(SONG_PAGE), F.lit(0)).alias("num_songs"),
        F.sum("songs").alias("num_songs_unique"),
        F.sum("artists").alias("num_artist"),
        F.sum("play_length").alias("total_play_length"),
        F.count("event_date").alias("num_active_days"),
        F.when(F.sum("unregistered") > 0, earliest)
        .otherwise(window_start(F.max("date_to"), F.min("registered"), days))
        .alias("date_from"),
        F.max("date_to").alias("date_to"),
        F.min("registered").alias("registration_date"),
        F.nullif(F.sum("paid"), F.lit(0)).alias("num_active_days_paid"),
        *([total_counts(F.collect_list(PAGE_MAP)).alias(PAGE_MAP)] if page_map else _sums(pages)),
        F.min(F.when(F.col("event_date") == F.col("date_to"), F.col("level"))).alias("current_level"),
        *([F.coalesce(F.max("churn"), F.lit(0)).alias("churn")] if churn else []),
    )
    users = users.withColumn("current_level_paid", _paid_flag(F.col("current_level")))
    if not keep_inactive:
        users = users.where(F.col("num_songs") > 0)
    return with_ratios(users).selectExpr(*map(named, user_columns([PAGE_MAP] if page_map else pages, churn)))


def user_columns(pages: Sequence[str] = PAGES, churn: bool = False) -> list[str]:
    """Column order of the wide user table."""
    return user_table_schema(pages, churn).names


def user_features(
    dated: DataFrame,
    days: int = ALL_DAYS,
    pages: Sequence[str] | str = PAGES,
    keep_inactive: bool = False,
    churn: bool = False,
) -> DataFrame:
    """The wide user table over each user's last ``days`` days of valid, dated events.

    ``pages``: one column for each page of a list; ``map``, one map of counts in the column ``pages`` for any number of
    pages; ``auto``, one column for each page that occurs, read off that map. Users without a played song in the window
    are left out unless ``keep_inactive``. ``churn`` adds the flag from the same pass.
    """
    if isinstance(pages, str):
        special = [SONG_PAGE, CHURN_PAGE]
        daily = daily_activity(dated, special, page_map=True)
        users = users_from_daily(daily, days, special, keep_inactive, churn, page_map=True)
        return users if pages == "map" else with_page_columns(users, distinct_pages(dated))
    needed = [*pages, *[p for p in (SONG_PAGE, CHURN_PAGE) if p not in pages]]
    if OTHER_PAGES in pages and needed != [*pages]:
        raise ValueError(f"a list with {OTHER_PAGES} must name {SONG_PAGE} and {CHURN_PAGE}")
    return users_from_daily(daily_activity(dated, needed), days, pages, keep_inactive, churn)


def with_page_columns(users: DataFrame, pages: Sequence[str]) -> DataFrame:
    """The map of page counts as one column per page of a list, null where there are none.

    The map is taken apart into rows and pivoted, so the work grows with the counts that are there and not with
    users times pages.
    """
    rows = users.select(F.col("userId").alias("_user"), F.explode(PAGE_MAP).alias("_page", "_events"))
    counts = rows.groupBy("_user").pivot("_page", list(pages)).agg(F.sum("_events"))
    counts = counts.withColumnsRenamed({p: f"_page {p}" for p in pages})
    joined = users.join(counts, F.col("userId") == F.col("_user"), "left")
    place = users.columns.index(PAGE_MAP)
    page_columns = [F.col(named(f"_page {p}")).alias(p) for p in pages]
    return joined.select(*quoted(users.columns[:place]), *page_columns, *quoted(users.columns[place + 1 :]))


# --- column choice -------------------------------------------------------------------------------------------


def choose_features(users: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``userId``, ``churn`` and ``columns``, numeric nulls as 0; an absent column is an error."""
    return users.selectExpr(*map(named, ["userId", "churn", *columns])).na.fill(0)


def choose_features_tolerant(users: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``userId`` and ``columns``, numeric nulls as 0; an absent column becomes a constant 0."""
    present = set(users.columns)
    chosen = [F.col(f"`{c}`") if c in present else F.lit(0).alias(c) for c in columns]
    return users.select("userId", *chosen).na.fill(0)


def preview(users: DataFrame, rows: int = 10, key: str = "userId") -> DataFrame:
    """The first rows in key order."""
    return users.orderBy(key).limit(rows)
