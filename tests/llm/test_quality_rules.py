import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tools import clashing
from stayflow.llm import quality_rules as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_base_measures(spark, odd, odd_rows):
    more = [(20, "a b c d e f a b c d e\n x#\n x#\n\n\n", "en", "a", 1), (21, "the #<| \x1c  of x\r\ny", "en", "a", 1)]
    rows = [r for r in odd_rows if r[0] != 8] + more
    out = q.judge(spark.createDataFrame(rows, odd.schema)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((str(r["doc_id"]), *(r["quality"][f] for f in fields)) for r in out)
    assert got == sorted((str(r[0]), *brute(r[1])) for r in rows)
    for r in out:
        m = r["quality"]
        assert m["base_failed"] == (m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"])
        assert not (m["base_failed"] and m["kept"])


def test_distance():
    refs = np.array([[10.0, 0.0], [5.0, 5.0]])
    assert q.distance(np.array([2.0, 2.0]), refs) == pytest.approx(0.0)
    assert q.distance(np.array([0.0, 3.0]), refs[:1]) == pytest.approx(1.0)
    assert q.distance(np.zeros(2), refs) is None


def test_symbols_instead_of_text_are_far_from_the_references(spark, odd):
    words = [f"{a}{b}" for a in ("th", "an", "er", "on", "of") for b in ("e", "in", "ing", "at", "or")]
    text = lambda i: " ".join(words[(i * j + j * j) % 25] for j in range(1, 120))
    rows = [(i, text(i), "en", "a", 1) for i in range(120)]
    junk = (999, " ".join(f"{chr(97 + j % 26)}###{j}$$$%%%" for j in range(120)), "en", "a", 1)
    out = {r["doc_id"]: r["quality"] for r in q.judge(spark.createDataFrame(rows + [junk], odd.schema)).collect()}
    assert not out[999]["base_failed"] and not out[999]["kept"]
    assert all(m["kept"] or m["base_failed"] for d, m in out.items() if d != 999)


def test_empty_and_clashing(odd, nothing):
    assert q.judge(nothing).count() == 0
    assert q.judge(clashing(odd), into="verdict").count() == 15


def prose(stems, i, n=120):
    words = [f"{a}{b}" for a in stems for b in ("e", "in", "ing", "at", "or")]
    rng = random.Random(i)
    return " ".join(rng.choice(words) for _ in range(n))


def test_languages_without_a_reference_get_no_verdict_and_missing_ones_their_own(spark, odd):
    common = [(i, prose(("th", "an", "er", "on", "of"), i), "en", "a", 1) for i in range(60)]
    rare = [(500 + i, prose(("дж", "кв", "щу", "эт", "юл"), i), "uk", "a", 1) for i in range(2)]
    unnamed = [(600 + i, prose(("かな", "もじ", "ひら", "にほ", "ごぶ"), i), (None, "")[i % 2], "a", 1) for i in range(60)]
    junk = [(999, " ".join(f"{chr(97 + j % 26)}###{j}$$$%%%" for j in range(120)), None, "a", 1)]
    rows = q.judge(spark.createDataFrame(common + rare + unnamed + junk, odd.schema)).collect()
    out = {r["doc_id"]: r["quality"] for r in rows}
    assert all(out[d]["char_distance"] is out[d]["word_distance"] is None for d in (500, 501))
    assert all(out[d]["word_distance"] is not None for d in range(600, 660))
    assert all(m["kept"] for d, m in out.items() if d != 999)
    assert not out[999]["base_failed"] and not out[999]["kept"]


def brute_distances(rows, min_words, min_share):
    """{id: (char distance, word distance)} by dense histograms and the textbook formula."""
    marks = ".,;:!?'\"()-"
    kind = lambda c: [c.islower(), c.isupper(), c.isdigit(), c in " \t", c in "\n\r\v\f", c in marks, True].index(True)
    chars_of = lambda t: Counter(7 if ord(c) > 127 else kind(c) for c in t)
    words_of = lambda t: [w.lower() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t)]

    def js(p, q):
        p, q = ({k: n / sum(x.values()) for k, n in x.items()} for x in (p, q))
        total = 0.0
        for k in p.keys() | q.keys():
            a, b = p.get(k, 0.0), q.get(k, 0.0)
            total += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x) / 2
        return math.sqrt(max(total, 0.0))

    chars, words = {}, {}
    for _, text, lang in rows:
        chars.setdefault(lang or "", Counter()).update(chars_of(text))
        words.setdefault(lang or "", Counter()).update(words_of(text))
    everything = sum(map(Counter.total, words.values()))
    langs = [x for x, c in words.items() if c.total() >= max(min_words, min_share * everything)]
    common = {x: set(sorted(words[x], key=lambda w: (-words[x][w], len(w.encode()) > 64, w.encode()))[: q.COMMON_WORDS]) for x in langs}
    binned = lambda c, x: sum((Counter({w if w in common[x] else None: n}) for w, n in c.items()), Counter())
    out = {}
    for d, text, lang in rows:
        own, plain = chars_of(text), words_of(text)
        judged = (lang or "") in langs
        out[d] = (
            min(js(own, chars[x]) for x in langs) if judged and own.total() >= q.MIN_CHARS else None,
            min(js(binned(Counter(plain), x), binned(words[x], x)) for x in langs) if judged and len(plain) >= q.MIN_WORDS else None,
        )
    return out


def test_distances_against_brute_force(spark, odd, monkeypatch):
    monkeypatch.setattr(q, "MIN_REFERENCE_SHARE", 0.05)
    stems = {"en": ("th", "an", "er", "on"), "de": ("sch", "un", "er", "ge"), None: ("かな", "もじ"), "fr": ("ou", "éa", "on")}
    rows = []
    for lang, own in stems.items():
        filler = lambda i, j: f"{own[0]}{i}x{j}"
        rows += [(len(rows) + i, prose(own, i, 20 + 9 * i) + " " + " ".join(filler(i, j) for j in range(i)), lang) for i in range(25)]
    rows += [(len(rows) + i, prose(("ab", "cd"), i), f"dirty {i}") for i in range(40)]
    rows += [(len(rows), "Long" * 40 + " " + prose(("th", "on"), 3, 60), "en"), (len(rows) + 1, "#$%& 12 " * 60, "de")]
    docs = spark.createDataFrame([(d, t, x, "a", 1) for d, t, x in rows], odd.schema)
    expected = brute_distances(rows, q.MIN_REFERENCE_WORDS, 0.05)
    assert sum(a is not None for a, _ in expected.values()) > 60
    assert set(q.references(docs).langs) == {"", "de", "en", "fr"}
    for r in q.judge(docs.repartition(7)).collect():
        m, (a, b) = r["quality"], expected[r["doc_id"]]
        assert (m["char_distance"], m["word_distance"]) == (pytest.approx(a, abs=1e-7), pytest.approx(b, abs=1e-7))
        far = (a or 0) > q.MAX_CHAR_DISTANCE or (b or 0) > q.MAX_WORD_DISTANCE
        assert m["kept"] == (not m["base_failed"] and not far)


def test_dictionaries_are_bounded_over_all_languages(monkeypatch):
    monkeypatch.setattr(q, "FLUSH", 50)
    batch = pa.RecordBatch.from_pydict({"lang": [f"l{i % 40}" for i in range(200)], "text": [b"a b " + b"%d" % i for i in range(200)]})
    parts = list(q.count_words(iter([batch])))
    assert len(parts) > 10 and max(map(len, parts)) < 200
    totals, words = Counter(), Counter()
    for r in (r for p in parts for r in p.to_pylist()):
        totals[r["lang"]] += r["n"] * (r["kind"] == "total")
        words[r["key"]] += r["n"] * (r["kind"] == "word")
    assert set(totals.values()) == {15} and words[b"a"] == 200 and words[b"7"] == 1


def test_more_languages_than_references(spark, odd, monkeypatch):
    monkeypatch.setattr(q, "MIN_REFERENCE_WORDS", 100)
    rows = [(i, prose(("th", "an"), i), f"l{i}", "a", 1) for i in range(600)]
    rows += [(900 + i, prose(("er",), i), "x" * 300, "a", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, odd.schema)
    assert len(q.references(docs).langs) == 1  # the others have less than a 500th each
    out = {r["doc_id"]: r["quality"]["word_distance"] for r in q.judge(docs).collect()}
    assert out[0] is None and out[900] is not None
