"""What the pipeline's stages leave to the driver."""

import os
from pathlib import Path

import numpy as np
import pytest

from stayflow.llm import components, minhash, quality_knn
from stayflow.llm.common import held_out, stored


def for_tasks_only(function, driver=os.getpid()):
    def guarded(*args, **options):
        assert os.getpid() != driver, "the driver must not do this"
        return function(*args, **options)

    return guarded


@pytest.fixture
def written(monkeypatch):
    """The purposes of the tables that are written."""
    purposes, store = [], minhash.stored

    def noted(df, purpose):
        purposes.append(purpose)
        return store(df, purpose)

    monkeypatch.setattr(minhash, "stored", noted)
    monkeypatch.setattr(components, "stored", noted)
    return purposes


def words(seed, n=60):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**9, n))


def test_the_quality_model_is_fitted_by_a_task(spark, monkeypatch):
    """Neither texts nor counts of the learning rows are worked on by the driver's Python."""
    good = [(i, f"A calm sentence number {i}, written with care.") for i in range(40)]
    bad = [(100 + i, f"!!! {i} $$$ {i} ### {i} $$$") for i in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    marks = docs.selectExpr("doc_id", "cast(doc_id < 100 as int) as quality")
    for name in ("term_counts", "weighted", "top_directions"):
        monkeypatch.setattr(quality_knn, name, for_tasks_only(getattr(quality_knn, name)))
    model = quality_knn.learn(docs, marks)
    learned = docs.where(~held_out(docs["doc_id"])).count()
    assert len(model.vectors) == len(model.labels) == learned
    assert set(model.labels) == {0.0, 1.0}
    monkeypatch.undo()
    scores = model.scores([t.encode() for _, t in good + bad])
    assert scores[:40].min() > 0.5 > scores[40:].max()


def test_learning_rows_keep_their_order_and_counts(spark):
    texts = ["b b b", "a x", "é 1", "", "B b"]
    rows = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, label int")
    got = quality_knn.counted_terms(rows.repartition(4)).collect()
    expected = sorted(texts)
    assert [r["label"] for r in got] == [float(texts.index(t) % 2) for t in expected]
    for r, t in zip(got, expected):
        dense = np.zeros(quality_knn.TERMS, np.float32)
        dense[r["terms"]] = r["counts"]
        assert (dense == quality_knn.term_counts(t.encode())).all()


def test_the_search_ends_where_no_bucket_is_open(spark, written):
    docs = spark.createDataFrame([(i, words(i)) for i in range(8)] + [(8, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert all(r["component_id"] == i and r["kept"] for i, r in rows.items())
    assert written.count("minhash-open") == 1
    assert not {"minhash-pairs", "minhash-texts", "component-edges"} & set(written)


def test_one_round_is_enough_for_one_cluster(spark, written):
    text = words(1, 400)
    near = [(i, text + f" end{i}") for i in range(6)]
    docs = spark.createDataFrame([*near, (10, words(2)), (11, words(2))], "doc_id long, text string")
    rows = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert rows == {**{i: 0 for i in range(6)}, 10: 10, 11: 10}
    assert written.count("minhash-pairs") == 1
    assert written.count("minhash-open") == 2


def test_observed_rounds_end(spark, written):
    """A chain, and no edge at all: the number and hashes of the edges come from the write."""
    chain = spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long")
    assert {tuple(r) for r in components.components(chain).collect()} == {(i, 0) for i in range(13)}
    assert components.components(chain.where("a < 0")).count() == 0


def test_intermediate_tables_have_no_marker(spark):
    """The driver starts a process for the permissions of each such file."""
    kept = stored(spark.range(3), "no-marker")
    folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    assert sorted(r["id"] for r in kept.collect()) == [0, 1, 2]
    assert not (folder / "_SUCCESS").exists()
