import hashlib
import random

from tools import clashing
from stayflow.llm import run_index
from stayflow.llm.run_index import repeated_spans


def brute(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49) if d is not None else ():
            w = b[i : i + 50]
            first[w] = min(d, first.get(w, d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49) if d is not None else ():
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = [True] * 50
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    rows = repeated_spans(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted(map(tuple, rows), key=str)


def passages(n=120):
    rng = random.Random(11)
    letters = "abcdeé \n"
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(30, 200))) for _ in range(12)]
    rows = []
    for d in rng.sample(range(1000), n):
        parts = [rng.choice(pool) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(40)) for _ in range(6)]
        rows.append((d, "".join(parts)))
    rows += [(2000 + i, "ab" * (20 + 5 * i)) for i in range(6)] + [(3000 + i, "\0" * 60) for i in range(3)]
    return rows


def test_against_brute_force(spark):
    rows = passages()
    expected = brute(rows)
    assert sum(r[2] > 0 for r in expected) > 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(docs) == expected
    assert answer(docs.repartition(5)) == expected


def test_frequent_substrings_change_nothing(spark, monkeypatch):
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert len(run_index.hot_anchors(docs.selectExpr("doc_id", "cast(text as binary) text", "1L doc_key"))) > 0
    assert answer(docs) == brute(rows)


def test_odd_rows(odd, odd_rows, nothing):
    rows = [(r[0], r[1]) for r in odd_rows if r[0] != 8]
    assert answer(odd.where("doc_id is null or doc_id <> 8")) == brute(rows)
    long = [r for r in answer(odd) if r[0] == 8][0]
    assert long[1] == len(odd_rows[7][1].encode())
    assert repeated_spans(clashing(odd)).count() == len(odd_rows)
    assert repeated_spans(nothing).count() == 0


def test_one_id_with_two_texts_keeps_their_spans_apart(spark):
    shared = "".join(chr(97 + i * i % 26) for i in range(70))
    rows = [(1, shared), (5, "x" * 9 + shared), (5, shared[:60] + "y" * 30), (7, shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(docs) == brute(rows)
