import pytest
from test_shards_licenses_revisits import LICENSED, brute_licenses
from stayflow.llm import license_join

MIT = (
    "Copyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
    'of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction'
)
BSD = (
    "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the\n"
    "# following conditions are met:"
)
WRAPPED = [MIT, BSD, "x " * 500 + MIT + " y" * 500, "one\n" * 31 + BSD, *LICENSED, None]


def brute_runs(text):
    """Lines, and runs of as many words as a template has."""
    labels, best = set(brute_licenses(text)[5].split(",")) - {""}, 0.0
    words = license_words(text)
    blocks = lambda n: [words[i : i + n] for i in range(max(1, len(words) - n + 1))]
    for t, label in license_join.TEMPLATES:
        own = license_words(t)
        lines = [license_words(x) for x in (text or "").split("\n")]
        share = max(len(set(own) & set(b)) / len(set(own)) for b in blocks(len(own)) + lines)
        if share >= license_join.THRESHOLD - 1e-9:
            labels.add(label)
            best = max(best, share)
    return ",".join(sorted(labels)), best


def license_words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text or "").split()


def test_wrapped_notices_are_found(spark):
    docs = spark.createDataFrame(list(enumerate(WRAPPED)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_join.scan_licenses(docs, wrapped=True).collect()}
    assert [got[i]["labels"] for i in range(4)] == ["mit", "bsd", "mit", "bsd"]
    for i, t in enumerate(WRAPPED):
        labels, best = brute_runs(t)
        assert (got[i]["labels"], got[i]["score"]) == (labels, pytest.approx(1.0 if got[i]["n_base"] else best)), t


def test_rows_without_an_id_and_repeated_ids_are_scanned_each_by_itself(spark):
    whole = "x\nThis work is licensed under the GNU General Public License"
    halves = ["This work is licensed under", "the GNU General Public License\nthis work is licensed under the gnu general"]
    rows = [(None, whole), (None, whole), (None, "x"), (None, None), (7, whole), (7, "x"), (8, halves[0]), (8, halves[1]), (8, "y\n" + whole)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for wrapped in (False, True):
        got = license_join.scan_licenses(docs, wrapped=wrapped).select("doc_id", "n_words", "labels", "score").collect()
        find = lambda t: brute_runs(t) if wrapped else brute_licenses(t)[5:]
        expected = [(d, len(license_words(t)), *find(t)) for d, t in rows]
        assert sorted(map(tuple, got), key=str) == sorted(((d, n, l, pytest.approx(s)) for d, n, l, s in expected), key=str)
