"""Ranges of captures, clashing columns and every status of the revisit query."""

import random

from pyspark.sql import functions as F

from stayflow.llm import revisit
from stayflow.llm.queries import op10_revisit_resolution
from test_shards_licenses_revisits import SCHEMA, brute_revisits


def test_one_far_time_shifts_no_range(spark, monkeypatch):
    kept = {}
    inner = revisit.stored
    monkeypatch.setattr(revisit, "stored", lambda df, purpose: kept.setdefault(purpose, inner(df, purpose)))
    rows = spark.range(20_000).select(
        F.col("id").alias("record_id"),
        F.lit("a.com").alias("url"),
        F.when(F.col("id") == 7, F.lit(10**15)).otherwise(F.col("id")).alias("at"),
        F.when(F.col("id") % 2 == 0, "response").otherwise("revisit").alias("kind"),
        F.lit("x").alias("etag"),
        F.lit(None).cast("long").alias("last_modified"),
        F.lit(None).cast(revisit.HEADERS).alias("headers"),
    )
    got = revisit.resolve_revisits(rows, range_rows=1000)
    wrong = got.where((F.col("kind") == "revisit") & (F.col("record_id") != 7) & (F.col("source_id") != F.col("record_id") - 1))
    assert wrong.count() == 0
    assert got.where("record_id = 7").first().source_id == 19_998
    sizes = [r["count"] for r in kept["revisit-ranges"].groupBy("url_key", "range").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 2 * 1000


def test_many_records_at_one_moment(spark):
    rng = random.Random(4)
    rows = [(i, "a.com", rng.choice([5, 5, 5, 9]), rng.choice(["response", "revisit"]), "x", None, None, i) for i in range(400)]
    for range_rows in (1, 100):
        got = revisit.resolve_revisits(spark.createDataFrame(rows, SCHEMA), range_rows).collect()
        assert {r["record_id"]: (r["status"], r["source_id"]) for r in got} == brute_revisits(rows)


def test_columns_of_any_name_pass(spark):
    names = "_n record range key moment source here carried last response url_key status source_id _source".split()
    rows = [(1, "a.com", 1, "response", "x", None, None, 0), (2, "a.com", 2, "revisit", "x", None, None, 0)]
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("own").alias(n) for n in names])
    got = {r["record_id"]: r for r in revisit.resolve_revisits(wide).collect()}
    assert (got[2]["status"], got[2]["source_id"], got[2]["url_key"]) == ("resolved", 1, "a.com")
    assert all(got[2][n] == "own" for n in names if n not in ("url_key", "status", "source_id"))
    assert revisit.resolve_revisits(wide.limit(0)).count() == 0


def test_nulls_everywhere(spark):
    rows = [(None, None, None, None, None, None, None, None)] * 3 + [(1, "a.com", 1, None, "x", None, None, 0)]
    got = revisit.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["status"] for r in got] == ["no_earlier"] * 4


def test_the_query_meets_every_status(spark):
    found = {r["status"]: r["count"] for r in op10_revisit_resolution(spark, "/root/testdata/sf0.01").groupBy("status").count().collect()}
    assert set(found) == {"response", "resolved", "mismatch", "unverified", "no_earlier"}
    assert min(found.values()) > 100
