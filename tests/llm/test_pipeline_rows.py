"""The rows of the pipeline's stages."""

from collections import Counter
from hashlib import md5

import corpus_pipeline as pipeline
import numpy as np
import pytest
from test_decontaminate import words
from test_minhash import brute
from test_mixing import brute_targets
from stayflow.llm import mixing, quality_knn
from stayflow.llm.common import stored
from stayflow.llm.queries import QUALITY_CUT

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind", ["empty", "only bad", "few good"])
def test_quality_keeps_what_no_neighbour_voted_on(spark, odd, odd_rows, no_labels, tmp_path, kind):
    given = {"empty": [], "only bad": [(d, 0, 0) for d in range(1, 11)], "few good": [(d, int(d == 4), 0) for d in range(1, 11)]}
    spark.createDataFrame(given[kind], no_labels.schema).write.parquet(f"{tmp_path}/labels.parquet")
    kept = pipeline.quality(spark, odd, str(tmp_path)).collect()
    if kind == "few good":
        blank = [r for r in odd_rows if not (r[1] or "").strip()]
        assert sum(not (r["text"] or "").strip() for r in kept) == len(blank)
    else:
        assert len(kept) == len(odd_rows)


def voted_low(model, text):
    """Plain votes of the nearest labelled texts of the fitted space."""
    x = quality_knn.weighted(quality_knn.term_counts((text or "").encode())[None], model.idf)[0] @ model.space
    size = np.linalg.norm(x)
    near = model.vectors @ (x / size) if size > 0 else np.zeros(0)
    best = np.argsort(-near, kind="stable")[: quality_knn.NEIGHBOURS]
    weight = np.clip(near[best], 0, None) ** 4
    yes, no = ((weight * (model.labels[best] == y)).sum() * model.lift[y] for y in (1, 0))
    return yes + no > 0 and yes / (yes + no) < QUALITY_CUT


def contaminated(rows, items):
    shingles = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            n = min(13, len(w))
            shingles.setdefault(n, set()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    gone = set()
    for r in rows:
        w, hit = words(r["text"]), set()
        for n, known in shingles.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
        if hit and 20 * len(hit) >= len(w):
            gone.add(r["doc_id"])
    return gone


def copies_of(rows):
    """How often each document goes on: whole rounds of its source, and one more below the cut of its hash; of equal documents
    at the cut, as many as come nearest to the target."""
    sources, out = {}, Counter()
    for r in rows:
        text = r["text"] or ""
        named = f"{'' if r['doc_id'] is None else r['doc_id']}:{text}"
        h = int(md5(named.encode()).hexdigest()[: mixing.LEVELS * mixing.LEVEL_BITS // 4], 16)
        sources.setdefault(r["source"], []).append((h, len(text.encode().split()), tuple(r)))
    targets = brute_targets({s: sum(n for _, n, _ in x) for s, x in sources.items()})
    for s, members in sources.items():
        size = sum(n for _, n, _ in members)
        whole = int(targets[s] // size) if size else 0
        rest, done = targets[s] - whole * size, size == 0
        for h in sorted({h for h, _, _ in members}):
            same = [(n, row) for k, n, row in members if k == h]
            words = sum(n for n, _ in same)
            extra = len(same)
            if done and size:
                extra = 0
            elif not done and words > rest:
                each = words / len(same)
                extra, done = int(rest // each), True
                extra += 2 * (rest - extra * each) >= each
            rest -= words
            for i, (_, row) in enumerate(same):
                out[row] += min(whole + (i < extra), mixing.MAX_REPEATS)
    return out


def test_mix_of_rows_without_ids_and_words(spark, odd):
    """Null ids come near their target, and empty rows of a source at its limit come three times at most."""
    rows = [(None, "w " * (1 + i % 40), "en", "big", 1) for i in range(1000)] + [(i, "", "en", "small", 0) for i in range(400)]
    rows += [(i, "one two", "en", "small", 1) for i in range(5)]
    docs = spark.createDataFrame(rows, odd.schema).repartition(5)
    expected = copies_of(docs.collect())
    got = Counter(map(tuple, pipeline.mixed(spark, docs, FOLDER).collect()))
    assert got == Counter({r: n for r, n in expected.items() if n})
    targets = brute_targets({"big": sum(1 + i % 40 for i in range(1000)), "small": 10})
    assert abs(sum(n * len(r[1].split()) for r, n in got.items() if r[3] == "big") - targets["big"]) <= 40
    per_row = Counter(map(tuple, rows))
    assert all(n <= 3 * per_row[r] for r, n in got.items())
    assert sum(n for r, n in got.items() if not r[1]) == 1200


def test_rows_of_each_stage_against_plain_python(spark):
    docs = pipeline.table(spark, FOLDER, "documents")
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = docs.collect()
        if name == "quality":
            model = quality_knn.learn(docs, pipeline.table(spark, FOLDER, "labels"))
            times = {r["doc_id"]: not voted_low(model, r["text"]) for r in before}
        elif name == "near_dedup":
            times = {d: d == c for d, (_, c) in brute([(r["doc_id"], r["text"]) for r in before]).items()}
        elif name == "decontaminate":
            items = pipeline.table(spark, FOLDER, "benchmark").select("item_id", "text").collect()
            gone = contaminated(before, items)
            times = {r["doc_id"]: r["doc_id"] not in gone for r in before}
        elif name == "mix":
            times = copies_of(before)
        else:
            times = {r["doc_id"]: 1 for r in before}
        docs = stored(stage(spark, docs, FOLDER), f"rows-{name}")
        if name == "mix":
            expected = Counter({row: n for row, n in times.items() if n})
        else:
            expected = Counter(tuple(r) for r in before for _ in range(int(times[r["doc_id"]])))
        assert Counter(map(tuple, docs.select(*columns).collect())) == expected, name
    shards = {}
    for r in docs.collect():
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(shards) == list(range(8))
    assert all(sorted(x) == list(range(len(x))) for x in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
