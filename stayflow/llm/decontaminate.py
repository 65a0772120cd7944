"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Questions and answers are normalised (A-Z lower-cased, words joined by one space) and cut into windows of ``window``
words; an item with fewer words is one window. A document is normalised the same way and run through the automaton
once. Matches are mapped to words and to character offsets of the original text.

Items are broadcast in blocks whose windows take at most ``max_pattern_bytes``, split by a hash of the item. Up to that size there is
one block, and a Python worker builds its automaton once. A larger benchmark has several: the documents are still read once, a worker
gathers about ``GATHER_BYTES`` of texts, runs them through the automaton of one block after the other and unites what they find. So a
worker holds the benchmark's texts and one block's automaton, and results do not depend on the number of blocks.

Defined results: null and empty texts have no words and no hits. Items without words or without an id match nothing.
Repeated items all count. Repeated document rows are judged each by itself. A very long text is scanned whole, and needs memory for
itself. An empty benchmark hits nothing, no documents give an empty table. Other columns, whatever their names, pass through; a
column named as the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_BYTES, words_of

WINDOW = 13
MAX_PATTERN_BYTES = 16 << 20
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FINDINGS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("word_runs", T.ArrayType(SPAN)),
        T.StructField("char_spans", T.ArrayType(SPAN)),
    ]
)
#: Bytes of text that a worker runs through one block after the other.
GATHER_BYTES = 64 << 20
#: The worker's automaton beside the items that it was built from.
_built: list = [None, None]


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """Normalised windows of an item, each with a space before and after."""
    words = words_of(text)
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))] if words else []


def patterns(items: list[tuple[str, bytes]], size: int = WINDOW) -> list[tuple[str, int, list[str]]]:
    """Each distinct window with its number of words and the items that hold it; bytes are kept as code points."""
    found: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows(text, size):
            found.setdefault(w, set()).add(item)
    return [(w.decode("latin-1"), w.count(b" ") - 1, sorted(ids)) for w, ids in found.items()]


def automaton(items: list[tuple[str, bytes]], size: int) -> ahocorasick.Automaton:
    if _built[0] is not items:
        _built[:] = [None, None]  # never two automata at once
        a = ahocorasick.Automaton()
        for n, (window, words, ids) in enumerate(patterns(items, size)):
            a.add_word(window, (n, words, ids))
        a.make_automaton()
        _built[:] = [items, a]
    return _built[1]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open runs, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Document:
    """A text on its way through the blocks."""

    def __init__(self, data: bytes):
        self.data = data
        words = data.translate(WORD_BYTES).split()
        self.n_words, self.joined = len(words), b" " + b" ".join(words) + b" "
        self.runs: list[tuple[int, int]] = []
        self.items: set[str] = set()

    def scan(self, a: ahocorasick.Automaton) -> None:
        hits = list(a.iter(self.joined.decode("latin-1"))) if self.n_words and len(a) else []
        if not hits:
            return
        spaces = np.flatnonzero(np.frombuffer(self.joined, np.uint8) == 32)
        after = np.searchsorted(spaces, [end for end, _ in hits])  # number of words up to the end of the match
        self.runs = merged(self.runs + [(int(n) - words, int(n)) for n, (_, (_, words, _)) in zip(after, hits)])
        self.items.update(*({w: ids for _, (w, _, ids) in hits}.values()))

    def findings(self) -> dict:
        """See ``FINDINGS``."""
        as_spans = lambda pairs: [{"start": s, "end": e} for s, e in pairs]
        return {
            "n_words": self.n_words,
            "n_hit": sum(j - i for i, j in self.runs),
            "item_ids": sorted(self.items),
            "word_runs": as_spans(self.runs),
            "char_spans": as_spans(char_spans(self.data, self.runs)) if self.runs else [],
        }


def gathered(batches: Iterator[pa.Array], size: int) -> Iterator[list[pa.Array]]:
    """Batches in groups of at least ``size`` bytes, but for the last."""
    group: list[pa.Array] = []
    for batch in batches:
        group.append(batch)
        if sum(b.nbytes for b in group) >= size:
            yield group
            group = []
    if group:
        yield group


def findings(text: Column, blocks: list[Broadcast], window: int = WINDOW, gather: int = GATHER_BYTES) -> Column:
    """Column with the findings of a text under all blocks of items."""

    @F.arrow_udf(FINDINGS)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(FINDINGS)
        for group in gathered(batches, gather if len(blocks) > 1 else 0):
            documents = [[Document(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch] for batch in group]
            for block in blocks:
                a = automaton(block.value, window)
                for batch in documents:
                    for document in batch:
                        document.scan(a)
            for batch in documents:
                yield pa.array([document.findings() for document in batch], kind)

    return scanned(text.cast("binary"))


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    into: str = "contamination",
    window: int = WINDOW,
    max_pattern_bytes: int = MAX_PATTERN_BYTES,
) -> DataFrame:
    """The documents with a struct column ``into``: words, hit words, items found, word runs and character spans."""
    spark = documents.sparkSession
    usable = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text"))
    usable = usable.where("item is not null and text is not null")
    # Windows repeat their words: the patterns of an item take at most `window` times its bytes.
    total = usable.agg(F.coalesce(F.sum(F.length("text") + 2), F.lit(0))).first()[0] * window
    blocks = max(1, -(-total // max_pattern_bytes))
    shared = []
    for block in range(blocks):
        mine = usable if blocks == 1 else usable.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        rows = [(r["item"], bytes(r["text"])) for r in mine.toLocalIterator()]
        shared.append(spark.sparkContext.broadcast(rows))
    return documents.withColumn(into, findings(F.col(text), shared, window))


def char_spans(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of runs of words."""
    inside = np.concatenate(([False], np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)  # first and one past the last byte of each word
    lead = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))  # characters before a byte
    return [(int(lead[edges[i, 0]]), int(lead[edges[j - 1, 1]])) for i, j in runs]


def is_contaminated(found: Column, one_in: int = 20) -> Column:
    """At least a twentieth of the words, and at least one, are hit."""
    return (found["n_hit"] > 0) & (one_in * found["n_hit"] >= found["n_words"])
