import random
import re

from tools import clashing
from stayflow.llm.components import components
from stayflow.llm.minhash import estimated_similarity, near_duplicates, sketch, without_near_duplicates
from pyspark.sql import functions as F


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    name = {d: d for d in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                name[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(n=160):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    rows = []
    for d in range(n):
        if rows and rng.random() < 0.75:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) for _ in range(rng.randint(1, 300))]
        rows.append((d, " ".join(w)))
    return rows


def test_against_brute_force(spark):
    rows = near_copies()
    expected = brute(rows)
    assert sum(c != d for d, (_, c) in expected.items()) > 20
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_odd_rows(odd, odd_rows):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    expected = brute([(d, t) for d, t, *_ in odd_rows if d is not None])
    for r in rows:
        if r["doc_id"] is None:
            assert r["kept"] and r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]


def test_kept_documents_keep_their_columns(odd, nothing):
    wide = clashing(odd)
    out = without_near_duplicates(wide)
    assert out.columns == wide.columns
    assert 2 not in {r["doc_id"] for r in out.collect()}
    assert without_near_duplicates(nothing).count() == near_duplicates(nothing).count() == 0


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_estimate_follows_the_similarity(spark):
    words = [f"x{i}" for i in range(400)]
    other = words[:40] + ["new"] + words[41:]
    a, b = sketch(" ".join(words).encode()), sketch(" ".join(other).encode())
    df = spark.createDataFrame([([int(x) for x in a[3]], [int(x) for x in b[3]])], "a array<long>, b array<long>")
    true = len(shingles(" ".join(words)) & shingles(" ".join(other))) / len(shingles(" ".join(words)) | shingles(" ".join(other)))
    assert abs(df.select(estimated_similarity(F.col("a"), F.col("b"))).first()[0] - true) < 0.08


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(50)) for _ in range(60)) for _ in range(4))
    near = lambda t: t + " more"
    rows = [(1, a), (1, a), (2, near(a)), (2, near(a)), (None, a), (None, b), (None, b), (None, b.upper()), (3, c), (3, near(c)), (4, d)]
    rows += [(5, d), (5, c), (6, None), (6, None), (2, " "), (None, ""), (None, None), (7, ""), (7, b + " x y z"), (8, a), (8, "q " + b)]
    docs = spark.createDataFrame([(i, t, n % 3) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n_chars int")
    # 3, 4 and 5 are linked by the texts of 5; 1, 2, 7 and 8 by those of 8.
    found = {(r["doc_id"], r["component_id"]) for r in near_duplicates(docs).where("n_shingles > 0").collect()}
    assert found == {(1, 1), (2, 1), (7, 1), (8, 1), (3, 3), (4, 3), (5, 3), (None, None)}
    out = without_near_duplicates(docs).collect()
    assert sorted(str(r["doc_id"]) for r in out if (r["text"] or "").strip()) == ["1", "3", "None"]
    assert sum(not (r["text"] or "").strip() for r in out) == sum(not (t or "").strip() for _, t in rows)
    again = without_near_duplicates(docs.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
