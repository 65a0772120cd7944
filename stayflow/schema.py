"""Schemas and fixed column lists of the activity log and of the user table."""

from __future__ import annotations

from pyspark.sql import types as T

# Event columns, page names, level and feature lists that the results depend on.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("userId", T.StringType()),
        T.StructField("sessionId", T.IntegerType()),
        T.StructField("page", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("level", T.StringType()),
        T.StructField("itemInSession", T.IntegerType()),
        T.StructField("location", T.StringType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("registration", T.LongType()),
        T.StructField("gender", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("song", T.StringType()),
        T.StructField("length", T.DoubleType()),
    ]
)

PAGES = [
    "About",
    "Add Friend",
    "Add to Playlist",
    "Cancel",
    "Cancellation Confirmation",
    "Downgrade",
    "Error",
    "Help",
    "Home",
    "Login",
    "Logout",
    "NextSong",
    "Register",
    "Roll Advert",
    "Save Settings",
    "Settings",
    "Submit Downgrade",
    "Submit Registration",
    "Submit Upgrade",
    "Thumbs Down",
    "Thumbs Up",
    "Upgrade",
]
PAGE_MAP = "pages"  # column with the counts of all pages as one map
OTHER_PAGES = "other_pages"  # events on pages that a given list does not name
SONG_PAGE = "NextSong"
CHURN_PAGE = "Cancellation Confirmation"
PAID_LEVEL = "paid"

ALL_DAYS = 3000  # window length that keeps a whole log

EXPORT_FEATURES = [
    "num_songs",
    "num_artist",
    "num_active_days",
    "Add Friend",
    "Add to Playlist",
    "Downgrade",
    "Thumbs Up",
    "days_since_registration",
    "avg_songs_per_active_day",
    "avg_play_length_per_active_day",
]
MODEL_FEATURES = [
    "num_active_days",
    "Add Friend",
    "Add to Playlist",
    "Downgrade",
    "Thumbs Up",
    "days_since_registration",
    "avg_songs_per_active_day",
]
LIVE_PAGES = ["About", "Cancel", "Downgrade"]
# Event columns that the activity log of the test tables fills.
LOG_COLUMNS = [
    "ts",
    "userId",
    "sessionId",
    "page",
    "level",
    "itemInSession",
    "registration",
    "artist",
    "song",
    "length",
]
RATIO_COLUMNS = [
    "days_since_registration",
    "days_in_member",
    "active_pct",
    "avg_songs_per_day",
    "avg_songs_per_active_day",
    "avg_play_length_per_day",
    "avg_play_length_per_active_day",
]

# Derived columns of the bronze and silver zones.
DATE_FIELDS = [
    T.StructField("event_date", T.DateType()),
    T.StructField("registration_date", T.DateType()),
    T.StructField("days_from_registration", T.IntegerType()),
]
PART_FIELDS = [
    T.StructField(f"{stem}_{part}", T.StringType())
    for stem in ("event", "registration")
    for part in ("year", "month", "day")
]
ZONE_SCHEMA = T.StructType(EVENT_SCHEMA.fields + DATE_FIELDS + PART_FIELDS)
DAY_PARTITION = ["event_year", "event_month", "event_day"]


def user_table_schema(pages=PAGES, churn: bool = True) -> T.StructType:
    """Schema of the wide user table, in column order."""
    fields = [T.StructField("userId", T.StringType())]
    fields += [T.StructField(c, T.LongType()) for c in ("num_songs", "num_songs_unique", "num_artist")]
    fields += [T.StructField("total_play_length", T.DoubleType()), T.StructField("num_active_days", T.LongType())]
    fields += [T.StructField(c, T.DateType()) for c in ("date_from", "date_to", "registration_date")]
    fields += [T.StructField(c, T.LongType()) for c in ["num_active_days_paid", *pages]]
    fields += [T.StructField("current_level", T.StringType())]
    fields += [
        T.StructField(c, T.IntegerType()) for c in ["current_level_paid", *RATIO_COLUMNS[:2]]
    ]
    fields += [
        T.StructField(c, T.DoubleType()) for c in RATIO_COLUMNS[2:]
    ]
    if churn:
        fields += [T.StructField("churn", T.IntegerType())]
    return T.StructType(fields)
