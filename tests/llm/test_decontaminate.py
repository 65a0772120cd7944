import re

from tools import clashing
from stayflow.llm import decontaminate as module
from stayflow.llm.decontaminate import decontaminate, is_contaminated, windows
from pyspark.sql import functions as F

BENCHMARK = "item_id long, text string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items):
    out = []
    for doc_id, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            if item is None or not iw:
                continue
            n = min(13, len(iw))
            for i in range(len(iw) - n + 1):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == iw[i : i + n]:
                        hit |= set(range(j, j + n))
                        found.add(str(item))
        out.append((doc_id, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def answer(df):
    c = F.col("contamination")
    rows = df.select("doc_id", c["n_words"], c["n_hit"], c["item_ids"], is_contaminated(c)).collect()
    return sorted(((a, b, n, tuple(i), k) for a, b, n, i, k in rows), key=str)


def items_of(rows):
    base = rows[0][1].split()
    long = rows[7][1].split()
    return [
        (1, " ".join(base[3:20])), (2, "ONE, two!"), (3, None), (None, " ".join(base[:14])), (4, ""),
        (5, "absent words only here"), (6, "  ".join(long[500:540]).upper()), (7, "ONE, two!"),
    ]


def test_against_brute_force_in_one_block_and_in_many(spark, odd, odd_rows):
    rows = [r for r in odd_rows if r[0] != 8] + [(8, " ".join(odd_rows[7][1].split()[:900]), "de", "a", 9)]
    docs = spark.createDataFrame(rows, odd.schema)
    items = items_of(odd_rows)
    bench = spark.createDataFrame(items, BENCHMARK)
    expected = brute(rows, items)
    assert any(r[4] for r in expected)
    assert answer(decontaminate(docs, bench)) == expected
    assert answer(decontaminate(docs, bench, max_pattern_bytes=400)) == expected
    assert answer(decontaminate(clashing(docs), bench)) == expected


def test_spans_are_characters_of_the_original(spark):
    docs = spark.createDataFrame([(1, "Été -- ONE,\ttwo?! and more")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two")], BENCHMARK)
    r = decontaminate(docs, bench).first()
    span = r["contamination"]["char_spans"][0]
    assert r["text"][span["start"] : span["end"]] == "ONE,\ttwo"


def test_empty_tables(spark, odd, nothing):
    bench = spark.createDataFrame([], BENCHMARK)
    assert decontaminate(nothing, bench).count() == 0
    assert {r[2] for r in answer(decontaminate(odd, bench))} == {0}


def test_short_items_are_one_window():
    assert windows(b"a b") == [b" a b "]
    assert windows(b"...") == []


def test_many_blocks_give_the_spans_of_one(spark):
    docs = spark.createDataFrame([(1, "Été -- ONE,\ttwo?! three / four; five"), (1, "Été -- ONE,\ttwo?! three / four; five"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(["one two", "three four", "five", "été one"])], BENCHMARK)
    pick = lambda df: sorted(df.select("doc_id", "contamination.*").collect(), key=str)
    one, many = pick(decontaminate(docs, bench)), pick(decontaminate(docs, bench, max_pattern_bytes=60))
    assert len(one[0]["char_spans"]) == len(one[0]["word_runs"]) == 1
    assert many == one


def test_many_blocks_read_the_documents_once_and_let_all_columns_pass(spark, odd, odd_rows, tmp_path):
    rows = [r for r in odd_rows if r[0] != 8]
    docs = clashing(spark.createDataFrame(rows, odd.schema)).withColumn("item_ids", F.lit("x"))
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    items = [i for i in items_of(odd_rows) if i[0] != 6]
    found = decontaminate(docs, spark.createDataFrame(items, BENCHMARK), into="contamination", max_pattern_bytes=300)
    assert found.columns == docs.columns
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text
    assert answer(found) == brute(rows, items)
    assert {r.copies for r in found.collect()} == {1}


def test_texts_are_gathered_by_bytes_and_come_back_in_order(monkeypatch):
    import pyarrow as pa

    batches = [pa.array([b"ab"] * 10, pa.binary()) for _ in range(7)]
    groups = list(module.gathered(iter(batches), 150))
    assert [len(g) for g in groups][:-1] == [len(groups[0])] * (len(groups) - 1) and 1 < len(groups) < 7
    assert [b for g in groups for b in g] == batches
    assert [len(g) for g in module.gathered(iter(batches), 0)] == [1] * 7
