"""The order of the shards beside plain Python, groups of equal texts, and what a range filter skips."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stayflow.llm import hilbert
from stayflow.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def bins_of(values, bins=1 << hilbert.BITS):
    """Bins of about equal counts over the values in order, null first."""
    counts, before, out = Counter(values), 0, {}
    for v in sorted(counts, key=lambda v: (v is not None, v if v is not None else 0)):
        out[v] = before * bins // len(values)
        before += counts[v]
    return out


def expected_curve(spark, rows):
    """(text) -> curve index, by the metadata of the row with the smallest id."""
    group = {}
    for r in rows:
        text = r["text"] or ""
        key = (r["doc_id"] is None, r["doc_id"] or 0, r["source"] is not None, r["source"] or "", r["lang"] is not None, r["lang"] or "")
        if text not in group or key < group[text][0]:
            group[text] = (key, (r["source"], r["lang"], len(text.encode()) + 1))
    dims = [[group[r["text"] or ""][1][i] for r in rows] for i in range(3)]
    bins = [bins_of(d) for d in dims]
    cells = {t: tuple(b[v] for b, v in zip(bins, d)) for t, (_, d) in group.items()}
    df = spark.createDataFrame([(t, *c) for t, c in cells.items()], "t string, x int, y int, z int")
    index = hilbert.hilbert_index([F.col(c) for c in "xyz"]).alias("i")
    return {r["t"]: r["i"] for r in df.select("t", index).collect()}


@pytest.mark.parametrize("part_rows", [2, 1000])
def test_order_of_all_rows(spark, odd, odd_rows, part_rows):
    copies = [(i % 50 + 200, "same text", "en" if i % 2 else "de", "hot" if i % 3 else None, 1) for i in range(120)]
    copies += [(None, "same text", "en", "hot", 1)] * 40
    docs = spark.createDataFrame(odd_rows + copies, odd.schema).repartition(6)
    rows = hilbert.shard_rows(docs, carry=docs.columns, part_rows=part_rows).collect()
    assert Counter(tuple(r.carried) for r in rows) == Counter(odd_rows + copies)
    curve = expected_curve(spark, docs.collect())
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve_index for r in rows] == [curve[r.carried.text or ""] for r in rows]
    assert [r.curve_index for r in order] == sorted(curve[t or ""] for t in (r.carried.text for r in rows))
    texts = [r.carried.text or "" for r in order]
    assert sum(a != b for a, b in zip(texts, texts[1:])) == len(set(texts)) - 1  # equal texts stand side by side
    again = hilbert.shard_rows(docs.repartition(3), carry=docs.columns, part_rows=part_rows).collect()
    place = lambda rows: Counter((tuple(r.carried), r.shard, r.slot) for r in rows)
    assert place(again) == place(rows)


def test_a_cut_divides_one_group_at_most(spark):
    docs = table(spark, FOLDER, "documents")
    rows = hilbert.shard_rows(docs, carry=["text"]).collect()
    shards = defaultdict(set)
    for r in rows:
        shards[r.carried.text].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 7
    assert sum(len(s) - 1 for s in shards.values()) <= 7


def test_a_range_filter_skips_shards(spark):
    """Minimum and maximum leave out a good part of the shards, in each dimension; copies under other metadata are left out here,
    as they stand with the first of their text and widen the ranges of its shard."""
    docs = table(spark, FOLDER, "documents")
    rows = hilbert.shard_rows(docs, carry=["source", "lang", "text"]).collect()
    copies = Counter(r.carried.text for r in rows)
    rows = [r for r in rows if copies[r.carried.text] == 1]
    for dimension in (lambda r: r.carried.source or "", lambda r: r.carried.lang or "", lambda r: r.size):
        inside = defaultdict(list)
        for r in rows:
            inside[r.shard].append(dimension(r))
        ranges = [(min(v), max(v)) for v in inside.values()]
        values = sorted(map(dimension, rows))
        probes = [values[len(values) * k // 20] for k in range(20)]
        skipped = sum(not a <= p <= b for p in probes for a, b in ranges) / (20 * len(ranges))
        assert skipped >= 0.2, skipped


def test_bins_are_cut_by_value(spark):
    values = [None] * 30 + list("abcdefghij") * 7 + ["c"] * 200
    df = spark.createDataFrame([(v, 1) for v in values], "value string, n long").repartition(5)
    got = {r["value"]: r["bin"] for r in hilbert.depth_bins(df, 16, "test").collect()}
    counts, before, want = Counter(values), 0, {}
    for v in [None, *"abcdefghij"]:
        want[v] = before * 16 // len(values)
        before += counts[v]
    assert got == want
