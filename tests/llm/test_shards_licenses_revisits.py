import itertools
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F
from tools import clashing
from stayflow.llm import hilbert, license_join, revisit


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (4, 1), (3, 4)])
def test_curve_visits_every_cell_in_steps_of_one(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    names = [f"x{i}" for i in range(n)]
    df = spark.createDataFrame(cells, ", ".join(f"{x} int" for x in names))
    rows = df.select("*", hilbert.hilbert_index([F.col(x) for x in names], bits).alias("h")).collect()
    at = {r["h"]: tuple(r)[:n] for r in rows}
    assert sorted(at) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(len(cells) - 1))


@pytest.mark.parametrize("part_rows", [1, 3, 1000])
def test_shards_have_equal_counts_and_gapless_slots(spark, odd, odd_rows, part_rows):
    copies = spark.createDataFrame([(i, "same text", "en", "hot", 1) for i in range(100, 160)], odd.schema)
    rows = hilbert.shard_rows(clashing(odd).select(*odd.columns).unionByName(copies), part_rows=part_rows).collect()
    assert len(rows) == len(odd_rows) + 60
    shards = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r)
    assert set(shards) == set(range(8))
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    for s in shards.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve_index"] for r in order] == sorted(r["curve_index"] for r in rows)
    texts = {d: t for d, t, *_ in odd_rows}
    for r in rows:
        text = (texts.get(r["doc_id"], "same text") if r["doc_id"] is not None else None) or ""
        if r["doc_id"] is not None:
            assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 1, crc32(text.encode()))


def test_empty_shards(nothing):
    assert hilbert.shard_rows(nothing).count() == 0


def brute_licenses(text):
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    w = words_of(text)
    starts, base = [], set()
    for phrase, label in license_join.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                base.add(label)
    labels, best = set(base), 0.0
    for line in (text or "").split("\n"):
        block = set(words_of(line))
        for t, label in license_join.TEMPLATES:
            own = set(words_of(t))
            share = len(own & block) / len(own)
            if share >= license_join.THRESHOLD - 1e-9:
                labels.add(label)
                best = max(best, share)
    score = 1.0 if starts else best
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(w), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), pytest.approx(score)


LICENSED = [
    "x y\nReleased under the MIT License. under the mit LICENSE",
    "This work is licensed, under the GNU: General Public License, version 3.",
    "Redistribution and use in source and binary forms, with or without changes, are permitted",
    "Redistribution and use in source and binary forms with or without, are now permitted here",
    "Licensed under CC BY-NC 4.0.\nLicensed under the Apache\nLicense, Version 2.0",
    "under the\nmit\tlicense", "under the mit licenses", "cc by nc cc by nc", "Permission is hereby granted", "",
    "General\nPublic\nLicense\nthis work is licensed\nunder the gnu",
]


def test_licenses_against_brute_force(spark, odd, odd_rows):
    rows = odd_rows + [(50 + i, t, "en", "a", 1) for i, t in enumerate(LICENSED)]
    docs = clashing(spark.createDataFrame(rows, odd.schema))
    got = license_join.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, []).append(t)
    for r in got:
        assert any(tuple(r)[1:] == brute_licenses(t) for t in texts[r["doc_id"]]), r


def test_no_documents_no_licenses(nothing):
    assert license_join.scan_licenses(nothing).count() == 0


def test_urls(spark):
    same = [
        "http://WWW.Example.com/a/b.html#top", "https://example.com/a/b/", "https://m.example.com:443/a/b?utm_source=x&ref=2",
        "example.com/a/b/index.html",
    ]
    df = spark.createDataFrame([(u,) for u in [*same, "http://example.com/a/b?page=2&ref=x", None, ""]], "u string")
    got = [r[0] for r in df.select(revisit.canonical_url(F.col("u"))).collect()]
    assert got == ["example.com/a/b"] * 4 + ["example.com/a/b?page=2", None, ""]


SCHEMA = f"record_id long, url string, at long, kind string, etag string, last_modified long, headers {revisit.HEADERS}, extra int"


def brute_revisits(rows):
    out = {}
    for i, url, at, kind, etag, modified, headers, _ in rows:
        if kind == "response":
            out[i] = ("response", None)
            continue
        old = [r for r in rows if r[3] == "response" and r[1] == url is not None and at is not None and r[2] is not None and r[2] < at]
        if not old:
            out[i] = ("no_earlier", None)
            continue
        s = max(old, key=lambda r: (r[2], r[0]))
        if etag is not None and s[4] is not None:
            status = "resolved" if etag.removeprefix("W/") == s[4].removeprefix("W/") else "mismatch"
        elif modified is not None and s[5] is not None:
            status = "resolved" if modified == s[5] else "mismatch"
        else:
            status = "unverified"
        out[i] = (status, s[0])
    return out


@pytest.mark.parametrize("range_rows", [1, 7, 5000])
def test_revisits_against_brute_force(spark, range_rows):
    rng = __import__("random").Random(9)
    rows = []
    for i in range(300):
        url = rng.choice(["a.com/1"] * 6 + ["b.com/x", "c.com", None])
        etag, modified = rng.choice(["x", "W/x", "y", None]), rng.choice([1, 2, None])
        at = rng.choice([None, *range(40)]) if rng.random() < 0.2 else rng.randrange(1000)
        rows.append((i, url, at, rng.choice(["response", "revisit"]), etag, modified, [("date", str(i))] if i % 7 else None, i))
    got = revisit.resolve_revisits(spark.createDataFrame(rows, SCHEMA), range_rows).collect()
    assert {r["record_id"]: (r["status"], r["source_id"]) for r in got} == brute_revisits(rows)
    assert all(r["extra"] == r["record_id"] for r in got)


def test_permitted_headers_replace_stored_ones(spark):
    rows = [
        (1, "a.com", 1, "response", "x", None, [("content-type", "text/html"), ("date", "1"), ("etag", "x")], 0),
        (2, "a.com", 2, "revisit", "x", None, [("content-type", "text/plain"), ("date", "2"), ("set-cookie", "c")], 0),
    ]
    got = {r["record_id"]: r["headers"] for r in revisit.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(h) for h in got[2]] == [("content-type", "text/html"), ("date", "2"), ("etag", "x")]
    assert revisit.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
