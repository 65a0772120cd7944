import re

import pytest
from tools import clashing
from stayflow.llm.mixing import mix, mixed_documents, source_targets


def brute_targets(sizes, weights=(5, 2, 1), repeats=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > repeats * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: repeats * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 50, None: 7}, {"a": 1, "b": 1000}, {"z": 5}, {"a": 0, "b": 10, "ä": 3}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_sizes_targets_and_near_budgets(spark, odd, odd_rows):
    rows = mix(odd).collect()
    assert len(rows) == len(odd_rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r["size"] for r in rows) == sorted(count(r[1]) for r in odd_rows)
    sizes = {}
    for r in odd_rows:
        sizes[r[3]] = sizes.get(r[3], 0) + count(r[1])
    assert {r["source"]: r["target"] for r in rows} == pytest.approx(brute_targets(sizes))
    assert all(r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] for r in rows)


def test_many_documents_come_near_their_targets(spark):
    rows = [(i, "w " * (1 + i % 40), "en", "abcd"[i * i % 4] if i % 3 else "big", 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mix(docs).groupBy("source", "target").sum("taken").collect()
    assert all(abs(r["target"] - r["sum(taken)"]) <= 40 for r in got)
    assert sorted(mix(docs).collect()) == sorted(mix(docs.repartition(7)).collect())


def test_mixed_documents_repeat_rows(odd):
    wide = clashing(odd)
    plan = {(r["doc_id"], r["size"], r["source"]): r["copies"] for r in mix(odd).collect()}
    out = mixed_documents(wide)
    assert out.columns == wide.columns
    assert out.count() == sum(r["copies"] for r in mix(odd).collect())
    assert plan


def test_empty(nothing):
    assert mix(nothing).count() == 0
    assert mixed_documents(nothing).count() == 0


def test_null_and_repeated_ids_come_near_their_targets(spark, nothing):
    for ids in (lambda i: None, lambda i: i % 3):
        rows = [(ids(i), "w " * (1 + i % 40), "en", "a" if i % 3 else "b", 1) for i in range(1000)]
        docs = spark.createDataFrame(rows, nothing.schema).repartition(6)
        got = mix(docs).groupBy("source", "target").sum("taken").collect()
        assert all(abs(r["target"] - r["sum(taken)"]) <= 40 for r in got)
        assert sorted(map(repr, mix(docs).collect())) == sorted(map(repr, mix(docs.repartition(2)).collect()))


def test_a_hot_group_of_equal_rows_is_split(spark, nothing):
    rows = [(None, "one two three", None, "a", None)] * 3000 + [(i, "four " * 9, "en", "b", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, nothing.schema).repartition(8)
    got = {r["source"]: (r["target"], r["sum(taken)"]) for r in mix(docs).groupBy("source", "target").sum("taken").collect()}
    assert all(abs(target - taken) <= 9 for target, taken in got.values())
    assert mixed_documents(docs).where("source = 'a'").count() * 3 == got["a"][1]


def test_empty_rows_of_a_source_at_its_limit_come_three_times_at_most(spark, nothing):
    rows = [(i, "" if i % 4 else None, "en", "small", 0) for i in range(400)] + [(i, "a b", "en", "small", 1) for i in range(3)]
    rows += [(i, "word " * 50, "en", "large", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, nothing.schema)
    assert mix(docs).agg({"copies": "max"}).first()[0] <= 3
    assert mixed_documents(docs).where("source = 'small'").count() == 3 * 403
