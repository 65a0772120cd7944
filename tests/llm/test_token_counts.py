"""Token counts beside the library itself."""

import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stayflow.llm import token_counts as tc
from stayflow.llm.queries import op11_token_counts
from tools import clashing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "a <|endoftext|> b  \n\n c<|endoftext|><|endoftext|>",
    " \n\t  lead and trail \r\n ",
    "don't we'll I'M they'RE '  's",
    "日本語 テスト ꟎x \U0001f600 𐞻z ½ ٣ \x1c \x85  x​",
    "word " * 40_000,
    "x" * 90_000,
    " " * 70_000 + "a",
    "1234567890 " * 9_000 + "\n" * 12,
]


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def counter(**options):
    return tc.TokenCounter(open(PATH, encoding="utf-8").read(), **options)


def test_classes_of_stable_characters_are_those_of_the_library():
    ranges = re.findall("(.)-(.)", tc.STABLE, re.DOTALL)
    chars = [chr(c) for a, b in ranges for c in range(ord(a), ord(b) + 1)]
    for k in range(0, len(chars), 500):
        text = "".join(f"a{c}\n1{c}\n!{c} {c} x" for c in chars[k : k + 500])
        assert [o for _, o in LIBRARY.pre_tokenizer.pre_tokenize_str(text)] == [m.span() for m in tc._PATTERN.finditer(text)]


def test_counter_with_small_and_large_memory():
    rng = random.Random(11)
    parts = ["the", " of", "  ", "\n", "'s", "é", "Ünï", "42", "…", "-", "<|endoftext|>", "漢", " ", "qzx"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)]
    for mine in (counter(), counter(cached=3), counter(frequent={" of": 1, "the": library("the")})):
        assert [mine.count(t) for t in texts] == [library(t) for t in texts]
    assert len(mine.known) > 2


def test_pieces_join_to_the_text_and_end_between_pre_tokens():
    for text in TEXTS:
        parts = list(tc.pieces(text, 1000))
        assert "".join(parts) == text
        assert sum(library(p) for p in parts) == library(text)
    assert len(list(tc.pieces(TEXTS[4], 1000))) > 100
    assert list(tc.pieces("")) == [""]


def test_packed_table():
    table = {" of": 1, "é": 2, "\0": 1, "": 0}
    assert tc.unpack(tc.pack(table)) == table


def test_other_files_are_refused():
    spec = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    with pytest.raises(ValueError):
        tc.TokenCounter(spec)


def test_odd_documents(spark, odd, odd_rows, nothing):
    want = sorted((repr(r[0]), library(r[1])) for r in odd_rows)
    got = tc.with_token_counts(odd, PATH)
    assert sorted((repr(r.doc_id), r.n_tokens) for r in got.collect()) == want
    named = tc.with_token_counts(clashing(odd), PATH, into="n_words")
    assert named.columns == clashing(odd).columns
    assert sorted((repr(r.doc_id), r.n_words) for r in named.collect()) == want
    assert tc.with_token_counts(nothing, PATH).count() == 0


def test_table_covers_all_documents_and_is_bounded(spark, odd):
    found = tc.frequent_pre_tokens(odd)
    assert " the" in found and " été" in found and len(found) <= tc.FREQUENT
    assert all(len(w.encode()) <= tc.MAX_BYTES for w in found)
    assert len(tc.frequent_pre_tokens(odd, most=32)) <= 32


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op11_token_counts(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 512)
