"""Resolution of not-modified revisits in web archives.

A revisit record (a 304 answer) has no body. It is resolved by an as-of join on the canonical URL: the latest full
response that was captured strictly earlier. Its validators are compared (entity tag first, weak tags by value, else the
modification date); on a match the response's headers are kept, replaced where the 304 may say so.

Only moments matter to the join: of all responses of a URL at one time the one with the largest id counts, so they are merged to one row
per URL and time before anything is ordered, combined before the shuffle. These moments are dealt to tasks by ranges of (URL, time) of
about ``RANGE_ROWS`` moments, cut by a sample of the rows: a URL with a third of all captures takes many ranges, and one capture
with a far-off time shifts no cut. Each range of a URL hands its last response on, a running maximum over the ranges (one row
each) carries it forward, and a window inside the range does the rest. Revisits then meet the moment they were made at. Bodies are
not moved: records carry ids, validators and headers only.

Defined results: a record without a URL resolves to nothing; one without a time neither resolves nor serves; repeated records are
resolved each by itself; an empty table gives an empty result. Very long URLs are ordinary ones. Other columns pass through, whatever
their names; the new columns replace columns of the same name.
``status`` is ``response``, ``resolved``, ``mismatch``, ``unverified`` (no validator to compare) or ``no_earlier``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

RANGE_ROWS = 50_000
# Headers of a 304 answer that replace those of the stored response (RFC 9110, 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. or m. and default port; path without index page, .html and end slash; the query
    without tracking parameters. Scheme and fragment go."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^(www|m)\.|:(80|443)$", "")
    rest = F.regexp_replace(bare, r"^[^/?]*", "")
    path = F.regexp_extract(rest, r"^[^?]*", 0)
    path = F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.regexp_replace(F.concat(F.lit("&"), query), r"&(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?(?=&|$)", "")
    kept = F.regexp_replace(kept, r"^&+|&+$", "")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def entity_tag(tag: Column) -> Column:
    """Weak comparison: the mark of a weak tag is ignored."""
    return F.regexp_replace(tag, r"^W/", "")


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers with the permitted ones of the 304 in their place; sorted by name."""
    allowed = F.filter(F.coalesce(fresh, F.lit(None).cast(HEADERS)), lambda h: h["name"].isin(PERMITTED))
    allowed = F.coalesce(allowed, F.expr(f"cast(array() as {HEADERS})"))
    names = F.transform(allowed, lambda h: h["name"])
    old = F.filter(F.coalesce(stored, F.expr(f"cast(array() as {HEADERS})")), lambda h: ~F.array_contains(names, h["name"]))
    return F.array_sort(F.concat(old, allowed))


def earlier_responses(moments: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(url_key, at, source) from (url_key, at, response): for each moment the last response of the URL before it."""
    moments = stored(moments, "revisit-moments")
    wanted = max(-(-moments.count() // range_rows), 1)
    ranged = moments.repartitionByRange(wanted, "url_key", "at").withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "revisit-ranges")  # the cuts are kept with the rows
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    last = ranged.groupBy("url_key", "range").agg(F.max("response").alias("last"))
    carried = last.select("url_key", "range", F.max("last").over(earlier).alias("carried"))
    inside = Window.partitionBy("url_key", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("here", F.max("response").over(inside)).join(carried, ["url_key", "range"])
    return found.select("url_key", "at", F.coalesce("here", "carried").alias("source"))


def resolve_revisits(records: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Resolve (record_id, url, at, kind, etag, last_modified, headers); kind is ``response`` or ``revisit``.

    Adds url_key, source_id, source_at, status and the merged headers. Other columns pass through.
    """
    made = ["url_key", "source_id", "source_at", "status", "headers"]
    record, old = F.col("_revisit_record"), F.col("_revisit_source")
    rows = records.select(F.struct("*").alias("_revisit_record")).withColumn("url_key", canonical_url(record["url"]))
    usable = F.col("url_key").isNotNull() & record["at"].isNotNull()
    is_response = F.coalesce(record["kind"] == "response", F.lit(False))
    names = ["at", "record_id", "etag", "last_modified", "headers"]
    response = F.when(is_response, F.struct(*[record[n].alias(n) for n in names]))
    moments = rows.where(usable).groupBy("url_key", record["at"].alias("at")).agg(F.max(response).alias("response"))
    before = earlier_responses(moments, range_rows).withColumnsRenamed({"url_key": "key", "at": "moment"})
    asking = usable & ~is_response
    before = before.withColumnRenamed("source", "_revisit_source")
    met = rows.where(asking).join(before, (F.col("url_key") == F.col("key")) & (record["at"] == F.col("moment")), "left")
    nothing = F.lit(None).cast(before.schema["_revisit_source"].dataType).alias("_revisit_source")
    both = met.select(record, "url_key", old).unionByName(rows.where(~asking).select(record, "url_key", nothing))

    tags = record["etag"].isNotNull() & old["etag"].isNotNull()
    dates = record["last_modified"].isNotNull() & old["last_modified"].isNotNull()
    same = F.when(tags, entity_tag(record["etag"]) == entity_tag(old["etag"])).when(dates, record["last_modified"] == old["last_modified"])
    status = (
        F.when(is_response, "response")
        .when(old.isNull(), "no_earlier")
        .when(same.isNull(), "unverified")
        .when(same, "resolved")
        .otherwise("mismatch")
    )
    headers = F.when(status == "resolved", merged_headers(old["headers"], record["headers"])).otherwise(record["headers"])
    return both.select(
        *[record.getField(c).alias(c) for c in records.columns if c not in made],
        headers.alias("headers"),
        "url_key",
        status.alias("status"),
        old["record_id"].alias("source_id"),
        old["at"].alias("source_at"),
    )


def header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))


def archive_of(pages: DataFrame) -> DataFrame:
    """Archive records of a table of pages: each page is captured twice and revisited five times.

    The first capture is made at second ``page_id`` with an entity tag of its content; at second 100 after it the page has changed
    and has a new tag and a date. It is asked for before the first capture (an older capture of the same URL may answer), with the first
    tag in between, and after the change with the old tag, with the date alone, and with neither.
    """
    tag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    changed = F.concat(F.lit('"'), F.md5(F.concat(F.col("html"), F.lit("2")).cast("binary")), F.lit('"'))
    none, day = F.lit(None).cast("string"), F.col("page_id").cast("long")
    weak = F.concat(F.lit("W/"), tag)
    visits = [
        ("response", 0, tag, F.lit(None).cast("long")),
        ("revisit", 50, weak, F.lit(None).cast("long")),
        ("revisit", -7, tag, F.lit(None).cast("long")),
        ("response", 100, changed, day),
        ("revisit", 150, tag, day),
        ("revisit", 160, none, day),
        ("revisit", 170, none, F.lit(None).cast("long")),
    ]
    listed = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("n"), F.lit(later).alias("later"), t.alias("tag"), d.alias("day"))
            for n, (kind, later, t, d) in enumerate(visits)
        ]
    )
    each = pages.select("page_id", "url", F.inline(listed)).withColumn("at", F.col("page_id") + F.col("later"))
    full = F.array(header("cache-control", F.lit("max-age=60")), header("content-type", F.lit("text/html")),
                   header("date", F.col("at")), header("etag", F.coalesce("tag", F.lit("-"))))
    short = F.array(header("content-type", F.lit("text/plain")), header("date", F.col("at")),
                    header("etag", F.coalesce("tag", F.lit("-"))), header("set-cookie", F.col("page_id")))
    return each.select(
        (F.col("page_id") * len(visits) + F.col("n")).alias("record_id"),
        "url",
        "at",
        "kind",
        F.col("tag").alias("etag"),
        F.col("day").alias("last_modified"),
        F.when(F.col("kind") == "response", full).otherwise(short).alias("headers"),
    )
