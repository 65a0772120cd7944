import random
from zlib import crc32

import pytest
from tools import clashing
from stayflow.llm import quality_knn, toxicity
from stayflow.llm.common import held_out
from stayflow.llm.labelled import training_rows
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts with insults are toxic; texts of shouted words are bad. Group names occur in toxic texts more often."""
    rng = random.Random(4)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    docs, labels = [], []
    for i in range(700):
        toxic, good = rng.random() < 0.3, rng.random() < 0.7
        w = [rng.choice(words) for _ in range(rng.randint(15, 60))]
        if toxic:
            w.insert(3, rng.choice(["idiot", "scumbag"]))
        if rng.random() < (0.8 if toxic else 0.1):
            w.insert(5, "muslim")
        if rng.random() < 0.1:
            w.insert(7, "christian")
        text = " ".join(w if good else [x.upper() + "!!" for x in w])
        docs.append((i, text, "en", "a", 1))
        labels.append((i, int(good), int(toxic)))
    docs += [(9001, "w muslim wak", None, None, None), (9002, "", None, None, None), (9003, None, None, None, None), (9001, "w muslim wak", "x", "y", 1)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(docs, names), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_is_the_crc_of_the_text_of_the_id(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def accuracy(scored, labels, label, cut):
    rows = scored.join(labels.select("doc_id", F.col(label).alias("_y")), "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert len(rows) > 50
    return sum((r["result"] >= cut) == bool(r["_y"]) for r in rows) / len(rows)


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    assert accuracy(toxicity.classify_toxicity(docs, labels, into="result"), labels, "toxic", 0.5) > 0.97


def test_counterfactual_penalty_lowers_neutral_mentions(labelled):
    docs, labels = labelled
    plain = toxicity.train(docs, labels, counterfactual=0.0)
    fair = toxicity.train(docs, labels)
    gap = lambda m: abs(m.score(b"w muslim wak") - m.score(b"w christian wak"))
    assert gap(fair) < 0.3 * gap(plain)
    assert fair.score(b"wak muslim wbl") < 0.5 < fair.score(b"wak idiot wbl")


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    scored = quality_knn.classify_quality(docs, labels, into="result")
    assert accuracy(scored, labels, "quality", 0.5) > 0.97


@pytest.mark.parametrize("classify", [toxicity.classify_toxicity, quality_knn.classify_quality])
def test_odd_rows_score_between_0_and_1(labelled, odd, nothing, no_labels, classify):
    docs, labels = labelled
    rows = classify(clashing(odd), labels, into="result").collect()
    assert len(rows) == 15 and all(0 <= r["result"] <= 1 for r in rows)
    again = {(r["doc_id"], r["text"]): r["result"] for r in classify(odd.repartition(3), labels, into="result").collect()}
    assert all(again[r["doc_id"], r["text"]] == pytest.approx(r["result"], abs=1e-6) for r in rows)
    assert classify(nothing, labels, into="result").count() == 0
    assert all(0 <= r["result"] <= 1 for r in classify(odd, no_labels, into="result").collect())


def test_neighbours_are_exact():
    import numpy as np

    rng = np.random.default_rng(0)
    v = rng.standard_normal((40, 6)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    y = (rng.random(40) < 0.5).astype(float)
    space = rng.standard_normal((quality_knn.TERMS, 6)).astype(np.float32)
    model = quality_knn.Neighbours(np.ones(quality_knn.TERMS), space, v, y, np.array([0.5, 0.5]), 0.5)
    texts = [b"a bb Ccc d!", b"zz 12 ,,", b"", None]
    got = model.scores(texts)
    for t, s in zip(texts[:2], got):
        x = quality_knn.weighted(quality_knn.term_counts(t)[None], model.idf)[0] @ space
        near = v @ (x / np.linalg.norm(x))
        best = np.argsort(-near)[: quality_knn.NEIGHBOURS]
        weight = np.clip(near[best], 0, None) ** 4
        assert s == pytest.approx((weight * y[best]).sum() / weight.sum(), abs=1e-4)
    assert got[2] == got[3] == 0.5


def test_an_id_with_many_texts_gives_one_learning_row(spark):
    many = [(7, f"text {i}") for i in range(500)]
    docs = spark.createDataFrame(many + [(9, "same"), (11, "same"), (12, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(7, 1), (9, 1), (11, 0), (12, 1)], "doc_id long, toxic int")
    rows = [tuple(r) for r in training_rows(docs, marks, "toxic", 10).collect()]
    assert sum(t.startswith("text") for t, _ in rows) == 1
    assert [v for t, v in rows if t == "same"] == [0]
    again = training_rows(docs.repartition(9), marks, "toxic", 10).collect()
    assert sorted(map(tuple, again)) == sorted(rows)
