"""SQL twins of the registered queries, written as plain joins and group-bys for a second engine.

Doubles are rounded as in the queries: 1e-8 is added first, so that an exact half falls upwards in both engines.
"""

from __future__ import annotations

from itertools import combinations

from ..functions.columns import underscored
from ..schema import (
    ALL_DAYS,
    EVENT_SCHEMA,
    EXPORT_FEATURES,
    LIVE_PAGES,
    LOG_COLUMNS,
    MODEL_FEATURES,
    PAGES,
    RATIO_COLUMNS,
    SONG_PAGE,
    user_table_schema,
)
from .queries import REDELIVERED_FROM, SHORT_PAGES, WEEK, WINDOWS, ZONE_COLUMNS

LOG = """
log AS (
  SELECT epoch_us(ts) // 1000 AS ts,
         CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS "userId",
         CAST(event_id // 20 AS INTEGER) AS "sessionId",
         CASE event_type
           WHEN 'view' THEN 'NextSong'
           WHEN 'click' THEN CASE WHEN k < 50 THEN 'Thumbs Up' ELSE 'Add to Playlist' END
           WHEN 'purchase' THEN CASE WHEN k < 20 THEN 'Submit Upgrade' ELSE 'Add Friend' END
           WHEN 'signup' THEN CASE WHEN k < 20 THEN 'Downgrade' ELSE 'Home' END
           WHEN 'error' THEN CASE WHEN k >= 98 THEN 'Cancellation Confirmation' WHEN k < 50 THEN 'Error' ELSE 'Thumbs Down' END
         END AS page,
         CASE WHEN value >= 20 THEN 'paid' ELSE 'free' END AS level,
         CAST(event_id % 20 AS INTEGER) AS "itemInSession",
         epoch_ms(CAST(DATE '2024-01-10' - CAST(user_id % 200 AS INTEGER) AS TIMESTAMP)) AS registration,
         CASE WHEN event_type = 'view' THEN 'a' || (k % 25) END AS artist,
         CASE WHEN event_type = 'view' THEN 's' || k END AS song,
         CASE WHEN event_type = 'view' THEN value END AS length
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
),
valid AS (SELECT * FROM log WHERE "userId" IS NOT NULL AND "userId" <> ''),
dated AS (
  SELECT *, CAST(date_diff('day', registration_date, event_date) AS INTEGER) AS days_from_registration
  FROM (SELECT *, CAST(make_timestamp(ts * 1000) AS DATE) AS event_date,
               CAST(make_timestamp(registration * 1000) AS DATE) AS registration_date FROM valid)
),
parts AS (
  SELECT *, strftime(event_date, '%Y') AS event_year, strftime(event_date, '%m') AS event_month,
         strftime(event_date, '%d') AS event_day, strftime(registration_date, '%Y') AS registration_year,
         strftime(registration_date, '%m') AS registration_month, strftime(registration_date, '%d') AS registration_day
  FROM dated
),
churned AS (SELECT DISTINCT "userId", 1 AS churn FROM valid WHERE page = 'Cancellation Confirmation')"""

LINE = """'{' || concat_ws(',', '"ts":' || ts, '"userId":"' || "userId" || '"', '"sessionId":' || "sessionId",
  '"page":"' || page || '"', '"level":"' || level || '"', '"itemInSession":' || "itemInSession",
  '"registration":' || registration, '"artist":"' || artist || '"', '"song":"' || song || '"', '"length":' || length) || '}'"""


def quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


def windowed(days: int) -> str:
    return f"""
windowed AS (
  SELECT d.*, m.date_to,
         CASE WHEN date_diff('day', d.registration_date, m.date_to) < {days} THEN d.registration_date
              ELSE m.date_to - {days - 1} END AS date_from
  FROM dated d JOIN (SELECT "userId", max(event_date) AS date_to FROM dated GROUP BY 1) m ON d."userId" = m."userId"
  WHERE date_diff('day', d.event_date, m.date_to) < {days}
)"""


PIVOT = ", ".join(f"nullif(count(*) FILTER (page = '{p}'), 0) AS \"{underscored(p)}\"" for p in PAGES)
DOUBLES = ["total_play_length", *RATIO_COLUMNS[2:]]
USER_COLUMNS = [underscored(f.name) for f in user_table_schema(churn=False).fields]
TEXTS_AND_DATES = {"userId", "current_level", "date_from", "date_to", "registration_date"}
NUMBERS = [c for c in USER_COLUMNS if c not in TEXTS_AND_DATES]


def users(days: int, inner: str = "JOIN", churn: bool = True) -> str:
    """The wide user table ``users``; an outer ``inner`` keeps the users without songs."""
    return f"""{LOG},{windowed(days)},
songs AS (
  SELECT "userId", count(page) AS num_songs, count(DISTINCT song) AS num_songs_unique,
         count(DISTINCT artist) AS num_artist, sum(length) AS total_play_length
  FROM windowed WHERE page = 'NextSong' GROUP BY 1
),
days AS (
  SELECT "userId", count(DISTINCT event_date) AS num_active_days, min(date_from) AS date_from,
         max(date_to) AS date_to, min(registration_date) AS registration_date FROM windowed GROUP BY 1
),
paid AS (SELECT "userId", count(DISTINCT event_date) AS num_active_days_paid FROM windowed WHERE level = 'paid' GROUP BY 1),
pages_of AS (SELECT "userId", {PIVOT} FROM windowed GROUP BY 1),
levels AS (
  SELECT "userId", min(level) AS current_level, CASE WHEN min(level) = 'paid' THEN 1 ELSE 0 END AS current_level_paid
  FROM windowed WHERE event_date = date_to GROUP BY 1
),
spans AS (
  SELECT * REPLACE (coalesce(num_songs, 0) AS num_songs, coalesce(num_songs_unique, 0) AS num_songs_unique,
                    coalesce(num_artist, 0) AS num_artist),
         CAST(date_diff('day', registration_date, date_to) + 1 AS INTEGER) AS days_since_registration,
         CAST(date_diff('day', date_from, date_to) + 1 AS INTEGER) AS days_in_member
  FROM days {inner} songs USING ("userId") LEFT JOIN paid USING ("userId")
       LEFT JOIN pages_of USING ("userId") LEFT JOIN levels USING ("userId")
),
users AS (
  SELECT s.*, CAST(coalesce(c.churn, 0) AS INTEGER) AS churn,
         num_active_days / nullif(days_in_member, 0)::DOUBLE AS active_pct,
         num_songs / nullif(days_in_member, 0)::DOUBLE AS avg_songs_per_day,
         num_songs / num_active_days::DOUBLE AS avg_songs_per_active_day,
         total_play_length / nullif(days_in_member, 0)::DOUBLE AS avg_play_length_per_day,
         total_play_length / num_active_days::DOUBLE AS avg_play_length_per_active_day
  FROM spans s LEFT JOIN churned c USING ("userId")
)"""


def rounded(names, zero: bool = False) -> str:
    """Select list with doubles rounded and, with ``zero``, numeric nulls as 0."""
    out = []
    for n in names:
        value = f'"{n}"' if n in TEXTS_AND_DATES or not zero else f'coalesce("{n}", 0)'
        out.append(f'round({value} + 1e-8, 6) AS "{n}"' if n in DOUBLES else f'{value} AS "{n}"')
    return ", ".join(out)


EXPORT = ["userId", "churn", *[underscored(c) for c in EXPORT_FEATURES]]
MODEL = [underscored(c) for c in MODEL_FEATURES]


def select_log(body: str) -> str:
    return f"WITH {LOG} {body}"


def select_windowed(body: str, days: int = WEEK) -> str:
    return f"WITH {LOG},{windowed(days)} {body}"


def select_users(body: str, days: int = ALL_DAYS, more: str = "", inner: str = "JOIN") -> str:
    return f"WITH {users(days, inner)}{more} {body}"


def describe(where: str) -> str:
    """One row of statistics per numeric column of the users that ``where`` selects."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS metric, count(v) AS \"count\", avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, "
        f"quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS max "
        f'FROM (SELECT CAST("{c}" AS DOUBLE) AS v FROM users {where})'
        for c in [*NUMBERS, "churn"]
        if c != "churn" or not where
    )


STATS = ["mean", "std", "min", "p25", "p50", "p75", "max"]

SCORES = """,
cards AS (
  SELECT churn AS label,
         ((num_songs * 37 + days_since_registration * 11 + num_active_days * 5) % 97) / 100.0::DOUBLE AS score,
         CASE WHEN (num_songs * 37 + days_since_registration * 11 + num_active_days * 5) % 97 >= 60 THEN 1 ELSE 0 END AS prediction
  FROM users
),
whole AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n FROM cards),
points AS (
  SELECT t.score AS threshold, count(*) FILTER (c.label = 1) AS tp, count(*) FILTER (c.label <> 1) AS fp, p, n
  FROM (SELECT DISTINCT score FROM cards) t JOIN cards c ON c.score >= t.score CROSS JOIN whole GROUP BY t.score, p, n
)"""

VECTOR = f"""(SELECT "userId", {", ".join(f'CAST(coalesce("{c}", 0) AS DOUBLE) AS "{c}"' for c in MODEL)} FROM users)"""
LENGTH = "sqrt(" + " + ".join(f'"{c}" * "{c}"' for c in MODEL) + ")"
UNIT = (
    f"""(SELECT "userId", {", ".join(f'"{c}" / {LENGTH} AS "{c}"' for c in MODEL)} FROM {VECTOR})"""
)
SHARE = "('0x' || substr(md5(\"userId\"), 1, 8))::BIGINT % 100"


def page_sums(pages, page: str, total: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{p}' AS \"{page}\", CAST(coalesce(sum(\"{underscored(p)}\"), 0) AS BIGINT) AS \"{total}\" FROM users"
        for p in pages
    )


ZONE = quoted(ZONE_COLUMNS)
VALID = select_log(f"SELECT {quoted(LOG_COLUMNS)} FROM valid")
WINDOWED_COLUMNS = "ts, \"userId\", page, level, event_date, registration_date, date_to, date_from"
NO_SONGS = [p for p in PAGES if p != SONG_PAGE]
ORACLE: dict[str, str] = {
    "scan_json_events": select_log(f"SELECT {quoted(LOG_COLUMNS)} FROM log"),
    "scan_csv_users": select_users(f"SELECT {rounded([*USER_COLUMNS, 'churn'], zero=True)} FROM users"),
    "sink_csv_users": select_users(f"SELECT {rounded(EXPORT, zero=True)} FROM users"),
    "sink_partitioned": select_log(f"SELECT {ZONE} FROM parts"),
    "scan_partitioned": select_log(
        "SELECT event_date, \"userId\", count(*) AS events FROM dated "
        "WHERE event_date IN (DATE '2024-01-05', DATE '2024-01-06', DATE '2024-01-20') GROUP BY 1, 2"
    ),
    "gold_user_features": select_users(f"SELECT {rounded(USER_COLUMNS)} FROM users"),
    "valid_events": VALID,
    "missing_id_count": select_log(
        "SELECT count(*) AS missing_ids FROM log WHERE \"userId\" IS NULL OR \"userId\" = ''"
    ),
    "event_dates": select_log(
        'SELECT ts, "userId", registration, event_date, registration_date, days_from_registration FROM dated'
    ),
    "event_date_parts": select_log(f"SELECT {ZONE} FROM parts"),
    "choose_features": select_users(f"SELECT {rounded(EXPORT, zero=True)} FROM users", WEEK),
    "choose_features_tolerant": select_users(
        f"SELECT {rounded(['userId', *MODEL, 'num_active_days_paid'], zero=True)}, "
        "CAST(0 AS INTEGER) AS never_recorded FROM users",
        WEEK,
    ),
    "rename_columns": select_windowed(f'SELECT "userId", {PIVOT} FROM windowed GROUP BY 1', ALL_DAYS),
    "parse_json_events": VALID,
    "preview_users": select_users(f'SELECT {rounded(EXPORT, zero=True)} FROM users ORDER BY "userId" LIMIT 10'),
    "past_n_days": select_windowed(f"SELECT {WINDOWED_COLUMNS} FROM windowed"),
    "past_n_days_all": select_windowed(f"SELECT {WINDOWED_COLUMNS} FROM windowed", ALL_DAYS),
    "churn_flag": select_log(
        'SELECT u."userId", date_to, CAST(coalesce(churn, 0) AS INTEGER) AS churn '
        'FROM (SELECT "userId", max(event_date) AS date_to FROM dated GROUP BY 1) u LEFT JOIN churned c '
        'ON u."userId" = c."userId"'
    ),
    "insert_only_upsert": select_log(
        f", target AS (SELECT * FROM parts WHERE event_date < DATE '{REDELIVERED_FROM}') "
        f"SELECT {ZONE}, 1 AS delivery FROM target UNION ALL "
        f"SELECT {ZONE}, 2 AS delivery FROM parts p WHERE NOT EXISTS "
        '(SELECT 1 FROM target t WHERE t.ts = p.ts AND t."userId" = p."userId" AND t.event_date = p.event_date)'
    ),
    "dedup_events": select_log(
        f"SELECT {quoted(LOG_COLUMNS)} FROM (SELECT *, row_number() OVER "
        '(PARTITION BY ts, "userId" ORDER BY page) AS place FROM '
        f"(SELECT {quoted(LOG_COLUMNS)} FROM valid UNION ALL "
        f"SELECT {quoted(LOG_COLUMNS)} FROM (SELECT * REPLACE ('Help' AS page) FROM valid))) WHERE place = 1"
    ),
    "user_last_day": select_log('SELECT "userId", max(event_date) AS date_to FROM dated GROUP BY 1'),
    "user_day_metrics": select_windowed(
        'SELECT "userId", count(DISTINCT event_date) AS num_active_days, min(date_from) AS date_from, '
        "max(date_to) AS date_to, min(registration_date) AS registration_date FROM windowed GROUP BY 1"
    ),
    "user_current_level": select_windowed(
        'SELECT "userId", min(level) AS current_level, '
        "CASE WHEN min(level) = 'paid' THEN 1 ELSE 0 END AS current_level_paid "
        "FROM windowed WHERE event_date = date_to GROUP BY 1"
    ),
    "user_page_pivot": select_windowed(f'SELECT "userId", {PIVOT} FROM windowed GROUP BY 1'),
    "user_song_metrics": select_windowed(
        'SELECT "userId", count(page) AS num_songs, count(DISTINCT song) AS num_songs_unique '
        "FROM windowed WHERE page = 'NextSong' GROUP BY 1"
    ),
    "user_artist_metrics": select_windowed(
        'SELECT "userId", count(DISTINCT artist) AS num_artist, round(sum(length) + 1e-8, 6) AS total_play_length '
        "FROM windowed WHERE page = 'NextSong' GROUP BY 1"
    ),
    "user_paid_days": select_windowed(
        'SELECT "userId", count(DISTINCT event_date) AS num_active_days_paid '
        "FROM windowed WHERE level = 'paid' GROUP BY 1"
    ),
    "user_ratio_metrics": select_users(f"SELECT {rounded(['userId', *RATIO_COLUMNS])} FROM users", WEEK),
    "churn_users": select_log('SELECT "userId", churn FROM churned'),
    "churn_rate": select_log(
        'SELECT count(DISTINCT "userId") AS total_users, (SELECT count(*) FROM churned) AS churn_users, '
        'round((SELECT count(*) FROM churned) / count(DISTINCT "userId")::DOUBLE + 1e-8, 6) AS churn_rate FROM valid'
    ),
    "page_counts": select_log('SELECT page, count("userId") AS events FROM log GROUP BY 1'),
    "page_counts_excl": select_log(
        "SELECT page, count(\"userId\") AS events FROM log WHERE page <> 'NextSong' GROUP BY 1"
    ),
    "column_counts": select_log(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, " + (f'count("{c}")' if c in LOG_COLUMNS else "0::BIGINT") + " AS non_null FROM log"
            + ("" if c in LOG_COLUMNS else " HAVING true")
            for c in EVENT_SCHEMA.names
        )
    ),
    "describe_users": select_users(
        f"SELECT metric, \"count\", {', '.join(f'round({s} + 1e-8, 6) AS {s}' for s in STATS)} FROM ({describe('')})"
    ),
    "describe_diff": select_users(
        "SELECT k.metric, k.\"count\" - g.\"count\" AS \"count\", "
        + ", ".join(f"round(k.{s} - g.{s} + 1e-8, 6) AS {s}" for s in STATS)
        + f" FROM ({describe('WHERE churn = 0')}) k JOIN ({describe('WHERE churn = 1')}) g ON k.metric = g.metric"
    ),
    "churn_counts": select_users('SELECT churn, count("userId") AS users FROM users GROUP BY 1'),
    "churn_group_means": select_users(
        "SELECT churn, round(avg(coalesce(num_active_days_paid, 0)) + 1e-8, 6) AS num_active_days_paid, "
        "round(avg(num_active_days) + 1e-8, 6) AS num_active_days, "
        "round(avg(coalesce(days_since_registration, 0)) + 1e-8, 6) AS days_since_registration FROM users GROUP BY 1"
    ),
    "page_totals": select_users(page_sums(PAGES, "page", "total")),
    "page_totals_excl": select_users(page_sums(NO_SONGS, "page", "total")),
    "page_totals_unpivot": select_users(page_sums(LIVE_PAGES, "Page", "Cnt")),
    "feature_correlation": select_users(
        " UNION ALL ".join(
            f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", "
            f'round(corr(coalesce("{a}", 0), coalesce("{b}", 0)) + 1e-8, 6) AS correlation FROM users'
            for a, b in combinations([underscored(c) for c in EXPORT_FEATURES], 2)
        )
    ),
    "user_features": select_users(f"SELECT {rounded(USER_COLUMNS)} FROM users"),
    "user_features_7d": select_users(f"SELECT {rounded(USER_COLUMNS)} FROM users", WEEK),
    "churn_feature_table": select_users(f"SELECT {rounded(EXPORT, zero=True)} FROM users"),
    "churn_feature_table_7d": select_users(f"SELECT {rounded(EXPORT, zero=True)} FROM users", WEEK),
    "stream_raw_lines": select_log(f"SELECT {LINE} AS value FROM log"),
    "stream_bronze": select_log(f"SELECT {ZONE} FROM parts"),
    "stream_silver": select_log(f"SELECT {ZONE} FROM parts"),
    "stream_silver_recent": select_log(f"SELECT {ZONE} FROM parts"),
    "stream_users": select_users(f"SELECT {rounded(USER_COLUMNS)} FROM users"),
    "stream_quarantine": select_log(
        "SELECT 'broken' AS zone, md5('doc ' || doc_id || ' ' || translate(text, chr(13) || chr(10), '  ')) AS line "
        "FROM documents WHERE trim(text) <> '' "
        "UNION ALL SELECT 'silver', ts || ' ' || \"userId\" FROM parts"
    ),
    "stream_silver_nodedup": select_log(f"SELECT {ZONE} FROM parts UNION ALL SELECT {ZONE} FROM parts"),
    "stream_silver_rejects": select_log(
        "SELECT 'silver' AS zone, count(*) AS events, count(DISTINCT \"userId\") AS users FROM parts "
        "UNION ALL SELECT 'rejected', count(*), count(DISTINCT doc_id) FROM documents"
    ),
    "stream_token_counts": select_log(
        'SELECT "Page", count(*) AS "count" FROM (SELECT unnest(string_split(page, \' \')) AS "Page" FROM log) GROUP BY 1'
    ),
    "stream_page_counts": select_log('SELECT page AS "Page", count(*) AS "count" FROM log GROUP BY 1'),
    "live_page_totals": select_users(
        f'SELECT b."Page", b."Cnt" + coalesce(s.events, 0) AS "count" FROM ({page_sums(PAGES, "Page", "Cnt")}) b '
        'LEFT JOIN (SELECT page, count(*) AS events FROM log GROUP BY 1) s ON s.page = b."Page"'
    ),
    "assemble_features": select_users(
        f"""SELECT "userId", {", ".join(f'round("{c}" + 1e-8, 6) AS "{c}"' for c in MODEL)} FROM {VECTOR}"""
    ),
    "normalize_features": select_users(
        f"""SELECT "userId", {", ".join(f'round("{c}" + 1e-8, 6) AS "{c}"' for c in MODEL)} FROM {UNIT}"""
    ),
    "standardize_features": select_users(
        'SELECT "userId", '
        + ", ".join(
            f'round(CASE WHEN stddev_samp("{c}") OVER () = 0 THEN 0 ELSE "{c}" / stddev_samp("{c}") OVER () END + 1e-8, 6) AS "{c}"'
            for c in MODEL
        )
        + f" FROM {UNIT}"
    ),
    "train_test_split": select_users(
        f"SELECT \"userId\", churn, CASE WHEN {SHARE} >= 20 THEN 'train' ELSE 'test' END AS side FROM users"
    ),
    "area_under_roc": select_users(
        "SELECT round(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)::DOUBLE / count(*) + 1e-8, 6) "
        "AS area_under_roc FROM cards a JOIN cards b ON a.label = 1 AND b.label <> 1",
        more=SCORES,
    ),
    "roc_curve": select_users(
        'SELECT threshold, round(fp / n::DOUBLE + 1e-8, 6) AS "FPR", round(tp / p::DOUBLE + 1e-8, 6) AS "TPR" FROM points '
        "UNION ALL SELECT NULL, 0, 0 UNION ALL SELECT NULL, 1, 1",
        more=SCORES,
    ),
    "pr_curve": select_users(
        "SELECT threshold, round(tp / p::DOUBLE + 1e-8, 6) AS recall, round(tp / (tp + fp)::DOUBLE + 1e-8, 6) AS precision FROM points "
        "UNION ALL SELECT NULL, 0, round(arg_max(tp / (tp + fp)::DOUBLE, threshold) + 1e-8, 6) FROM points",
        more=SCORES,
    ),
    "f_measure_curve": select_users(
        'SELECT threshold, round(2.0::DOUBLE * tp / (2 * tp + (p - tp) + fp) + 1e-8, 6) AS "F_Measure" FROM points',
        more=SCORES,
    ),
    "accuracy": select_users(
        "SELECT count(*) FILTER (prediction = label) AS matched, count(*) AS total, "
        "round(count(*) FILTER (prediction = label) / count(*)::DOUBLE + 1e-8, 6) AS accuracy FROM cards",
        more=SCORES,
    ),
}

ORACLE["user_features_with_inactive"] = select_users(
    f"SELECT {rounded([c for c in USER_COLUMNS])} FROM users", 3, inner="LEFT JOIN"
)

for _name, _days in (("incremental_user_features", ALL_DAYS), ("incremental_user_features_7d", WEEK)):
    ORACLE[_name] = select_users(f"SELECT {rounded(USER_COLUMNS)} FROM users", _days)

ORACLE["user_active_days"] = select_log(
    ", last AS (SELECT \"userId\", max(event_date) AS date_to FROM dated GROUP BY 1) "
    'SELECT d."userId", date_to, w.days, '
    "count(DISTINCT event_date) FILTER (date_diff('day', event_date, date_to) < w.days) AS num_active_days, "
    "nullif(count(DISTINCT event_date) FILTER (level = 'paid' AND date_diff('day', event_date, date_to) < w.days), 0) "
    "AS num_active_days_paid "
    'FROM dated d JOIN last l ON d."userId" = l."userId", '
    f"(SELECT unnest({WINDOWS})::INT AS days) w GROUP BY ALL"
)

ORACLE["stream_token_changes"] = ORACLE["stream_token_counts"]
ORACLE["packed_days"] = select_log(
    'SELECT event_date, count(*) AS events, count(DISTINCT "userId") AS users, 1::BIGINT AS files FROM dated GROUP BY 1'
)
_PAIRS = list(combinations([underscored(c) for c in EXPORT_FEATURES], 2))
_CUTS = ", ".join(
    f'quantile_cont(coalesce("{c}", 0)::DOUBLE, {q}) AS "{c}_{i}"'
    for c in map(underscored, EXPORT_FEATURES)
    for i, q in enumerate((0.25, 0.5, 0.75))
)


def _bin(c: str) -> str:
    """Bins count different limits only."""
    return f'len(list_filter(list_distinct(["{c}_0", "{c}_1", "{c}_2"]), lambda x: coalesce("{c}", 0)::DOUBLE > x))::INT'


ORACLE["joint_histograms"] = select_users(
    f"SELECT \"left\", \"right\", left_bin, right_bin, count(*) AS users FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {_bin(a)} AS left_bin, {_bin(b)} AS right_bin FROM users, (SELECT {_CUTS} FROM users)"
        for a, b in _PAIRS
    )
    + ") GROUP BY ALL"
)

for _name, _days in (("user_features_pages", ALL_DAYS), ("user_features_pages_7d", WEEK)):
    ORACLE[_name] = select_log(
        f""", visits AS (
          SELECT 'u' || (doc_id % 30) AS "userId", (DATE '{REDELIVERED_FROM}' + CAST(doc_id % 20 AS INTEGER))::DATE AS event_date,
                 concat_ws(' ', 'Read', source, lang, (doc_id % 2500)::VARCHAR) AS page FROM documents
        ), every AS (
          SELECT "userId", event_date, page FROM dated UNION ALL SELECT * FROM visits
          UNION ALL SELECT DISTINCT "userId", event_date, 'NextSong' FROM visits
        ), kept AS (
          SELECT e.* FROM every e JOIN (SELECT "userId", max(event_date) AS date_to FROM every GROUP BY 1) m
          ON m."userId" = e."userId" AND date_diff('day', e.event_date, m.date_to) < {_days}
        ), per_user AS (
          SELECT "userId", count(*) FILTER (page = 'NextSong') AS num_songs, count(DISTINCT event_date) AS num_active_days
          FROM kept GROUP BY 1
        )
        SELECT k."userId", num_songs, num_active_days, page, count(*) AS events
        FROM kept k JOIN per_user p ON p."userId" = k."userId" WHERE num_songs > 0 AND page IS NOT NULL GROUP BY ALL"""
    )

TEST = f"(SELECT count(*) FROM users WHERE {SHARE} < 20)"
ONE_FIT = select_users(f"SELECT {TEST} AS users, 0::BIGINT AS outside, 0::BIGINT AS contradicting, 0::BIGINT AS differing")
for _kind in ("lr_predictions", "dt_predictions", "rf_predictions", "gbt_predictions", "model_roundtrip"):
    ORACLE[_kind] = ONE_FIT


def combinations_of(*grids: tuple[str, list[str]], folds: int) -> str:
    """Every combination of the families' grids, in order."""
    rows = [
        f"('{family}', {i}, '{params}', {folds}, true, true)" for family, listed in grids for i, params in enumerate(listed)
    ]
    return (
        "SELECT family, combination::INT AS combination, params, folds::INT AS folds, valid, rechecked FROM (VALUES "
        + ", ".join(rows)
        + ") AS t(family, combination, params, folds, valid, rechecked)"
    )


LR_GRID = [f"regParam={r}, elasticNetParam={e}" for r in (0.01, 0.1, 0.3, 0.5) for e in (0.0, 0.5, 1.0)]
LR_STUDY_GRID = [
    f"regParam={r}, elasticNetParam={e}, maxIter={m}" for r in (0.01, 0.5, 2.0) for e in (0.0, 0.5, 1.0) for m in (1, 5, 10)
]
GBT_GRID = [f"maxDepth={d}, maxBins={b}, maxIter={m}" for d in (2, 4, 6) for b in (20, 60) for m in (10, 20)]
NUMBER = "(num_songs * 37 + days_since_registration * 11 + num_active_days * 5)"
SHORT = ", ".join(f"count(*) FILTER (page = '{p}') AS c{i}" for i, p in enumerate(SHORT_PAGES))
ORACLE |= {
    "cv_metrics_lr": combinations_of(("LogisticRegression", LR_STUDY_GRID), folds=5),
    "cv_metrics_gbt": combinations_of(("GBTClassifier", GBT_GRID), folds=5),
    "select_best_model": combinations_of(
        ("LogisticRegression", LR_GRID), ("GBTClassifier", GBT_GRID), ("RandomForestClassifier", [""]), folds=3
    ),
    "dt_leaf_shares": select_users(
        f"SELECT sum(churn)::BIGINT AS churned, sum(churn)::DOUBLE AS expected FROM users WHERE {SHARE} >= 20"
    ),
    "lr_coefficients": "SELECT feature, true AS finite, true AS balanced, true AS solved FROM (VALUES "
    + ", ".join(f"('{c}')" for c in MODEL)
    + ") AS t(feature)",
    "prediction_counts": select_users("SELECT prediction, count(*) AS users FROM cards GROUP BY 1", more=SCORES),
    "score_users": select_users(
        f'SELECT "userId", churn::DOUBLE AS label, true AS two_classes FROM users WHERE {SHARE} < 20'
    ),
    "model_auc_comparison": select_users(
        f"SELECT model, (SELECT count(*) FROM users WHERE {SHARE} < 10) AS total, true AS possible, true AS areas_agree "
        "FROM (VALUES ('gbt'), ('lr'), ('rf')) AS t(model)"
    ),
    "evaluate_winners": select_users(
        f"SELECT model, {TEST} AS total, true AS possible, true AS areas_agree "
        "FROM (VALUES ('RandomForestClassifier'), ('DecisionTreeClassifier')) AS t(model)"
    ),
    "model_curve_ends": "SELECT 0.0::DOUBLE AS first_fpr, 1.0::DOUBLE AS last_tpr, 1.0::DOUBLE AS last_recall, true AS f_measure_possible, true AS area_agrees",
    "planted_search": select_users(
        f"SELECT family, won, won AS perfect, true AS above_chance, {TEST} AS total "
        "FROM (VALUES ('LogisticRegression', false), ('DecisionTreeClassifier', true)) AS t(family, won)"
    ),
    "chance_labels": select_users(
        f"SELECT model, (SELECT count(*) FROM users WHERE {SHARE} < 50) AS total, true AS near_half FROM (VALUES ('lr'), ('dt')) AS t(model)"
    ),
    "compare_model_predictions": select_users(
        'SELECT "userId", '
        + ", ".join(f"({NUMBER} % {m} >= {m // 2})::INT::DOUBLE AS {n}_pred" for n, m in (("gbt", 97), ("lr", 89), ("rf", 83)))
        + ", churn FROM users"
    ),
    "score_silver": select_users("SELECT count(*)::BIGINT AS users, 0::BIGINT AS other_classes FROM users"),
    "stream_progress": select_log("SELECT 'PageCount' AS name, count(*)::BIGINT AS input_rows FROM log"),
    "user_page_pivot_auto": select_windowed(
        'SELECT "userId", page, count(*) AS events FROM windowed WHERE page IS NOT NULL GROUP BY ALL'
    ),
    "user_features_other_pages": select_windowed(
        'SELECT "userId", '
        + ", ".join(f'nullif(c{i}, 0) AS "{underscored(p)}"' for i, p in enumerate(SHORT_PAGES))
        + f', nullif(n - {" - ".join(f"c{i}" for i in range(len(SHORT_PAGES)))}, 0) AS other_pages FROM '
        + f'(SELECT "userId", {SHORT}, count(page) AS n FROM windowed GROUP BY 1) WHERE c0 > 0'
    ),
}
