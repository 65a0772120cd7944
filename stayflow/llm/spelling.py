"""Spelling variants: words one error apart, found with bit-sliced position indexes, and the frequent form each one stands for.

Two words are near if one inserted, deleted or replaced code point turns one into the other. A group of words is indexed by one
bitset per (position, letter), with one bit per word. A word is looked up against the whole group at once: going along its letters,
``exact`` holds the words that agree so far, and three more sets those with one error so far, in the same step: ``replaced`` reads the
same position, ``longer`` (the group's word has one more letter) the position after, ``shorter`` the position before. Every step is a
handful of ANDs and ORs over all words of the group.

Groups come from pigeonholes: with one error in the shorter length ``c``, two words of lengths ``c`` and ``c`` or ``c + 1`` agree in their
first or their last ``c // 2`` letters. So a word is dealt to at most four groups (two lengths, beginning and end), its shared part is cut
off, and a pair that agrees at both ends counts in the group of its beginning only. A group of more than ``BLOCK`` words, however
large, is dealt over several indexes of about ``BLOCK`` words, and its words look themselves up in each; nothing is dropped. What
leaves a task is one row per word and group: how many near words, and the best of them.

The form of a word is its most frequent near word (ties: the smaller text), if that occurs at least ``ratio`` times as often. Forms are
followed to the last one, the root, by joins that double the steps; as counts grow by ``ratio`` at each step, there are few.

Null texts and texts without a run of letters give no words; repeated rows count as often as they come; an empty table gives an empty
table. Very long words are ordinary words. A null id is written as an empty text in the checksum of ``with_slips``. Other columns of
the documents play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
BLOCK = 1 << 15
#: Every so many-th run (by checksum) loses a letter in ``with_slips``.
SLIP = 97

GROUP = ["length", "at_end", "part"]
FOUND = "word string, n_near long, near_n long, near string"


def runs_of_letters(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): every run of letters, with A-Z in lower case."""
    found = F.regexp_extract_all(F.col(text), F.lit(LETTERS), F.lit(0))
    return documents.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("run")).withColumn("run", lower_ascii(F.col("run")))


def with_slips(doc_id: Column, run: Column, one_in: int = SLIP) -> Column:
    """The run, or the run without one letter where ``one_in`` divides the checksum of id and run: repeatable slips."""
    named = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run)
    check = F.crc32(named.cast("binary"))
    at = (check % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(check % one_in == 0, cut).otherwise(run)


def vocabulary(words: DataFrame, word: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; counted before the shuffle."""
    long = words.select(F.col(word).alias("word")).where(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


class PositionIndex:
    """One bitset per (position, letter) and one per length over a list of words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.at: list[dict[str, int]] = []
        self.by_length: dict[int, int] = {}
        for j, word in enumerate(words):
            bit = 1 << j
            self.by_length[len(word)] = self.by_length.get(len(word), 0) | bit
            while len(self.at) < len(word):
                self.at.append({})
            for letters, letter in zip(self.at, word):
                letters[letter] = letters.get(letter, 0) | bit
        self.every = (1 << len(words)) - 1

    def near(self, word: str) -> tuple[int, int, int]:
        """Bitsets of the words that differ from ``word`` by one replaced letter, are one longer, and one shorter."""
        at, end = self.at, len(self.at)
        exact, replaced, longer, shorter = self.every, 0, 0, 0
        same = at[0].get(word[0], 0) if word and at else 0
        before = 0
        for i, letter in enumerate(word):
            after = at[i + 1].get(letter, 0) if i + 1 < end else 0
            agree = exact & same
            replaced = replaced & same | exact ^ agree
            longer = (longer | exact) & after
            shorter = shorter & before | exact
            exact = agree
            if not (exact or replaced or longer or shorter):
                return 0, 0, 0
            if i + 1 < len(word):
                before = at[i].get(word[i + 1], 0) if i < end else 0
                same = at[i + 1].get(word[i + 1], 0) if i + 1 < end else 0
        sizes, n = self.by_length.get, len(word)
        return replaced & sizes(n, 0), (longer | exact) & sizes(n + 1, 0), shorter & sizes(n - 1, 0)


def members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


class Group:
    """The words of one group and block. Those to index come first; they wait to be looked up until the index is whole."""

    def __init__(self, length: int, at_end: bool):
        self.length, self.at_end, self.half = length, at_end, length // 2
        self.words: list[str] = []
        self.counts: list[int] = []
        self.waiting: list[str] = []
        self.index: PositionIndex | None = None

    def rest(self, word: str) -> str:
        return word[: -self.half] if self.at_end else word[self.half :]

    def take(self, word: str, n: int, indexed: bool) -> list[tuple]:
        if not indexed:
            return self.finish() + self.look_up(word)
        self.words.append(word)
        self.counts.append(n)
        self.waiting.append(word)
        return []

    def finish(self) -> list[tuple]:
        """What the indexed words find; a word that is alone finds nothing."""
        own, self.waiting = self.waiting, []
        return [row for word in own for row in self.look_up(word)] if len(self.words) > 1 else []

    def look_up(self, word: str) -> list[tuple[str, int, int, str]]:
        """Near words of the group's two lengths: each pair of words counts in one group only."""
        if self.index is None:
            self.index = PositionIndex([self.rest(w) for w in self.words])
        replaced, longer, shorter = self.index.near(self.rest(word))
        hits = (replaced | longer) if len(word) == self.length else shorter
        n, best = 0, None
        start = word[: self.half]
        for j in members(hits):
            other = self.words[j]
            if self.at_end and other[: self.half] == start:
                continue
            n += 1
            rank = (-self.counts[j], other)
            best = rank if best is None else min(best, rank)
        return [(word, n, -best[0], best[1])] if best else []


def look_up_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, those to index first in each; yields what each word finds."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])

    def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    key, group = None, None
    for batch in batches:
        found: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in (*GROUP, "block", "word", "n", "indexed"))
        for *place, word, n, indexed in zip(*columns):
            if place != key:
                found += group.finish() if group else []
                key, group = place, Group(place[0], place[1])
            found += group.take(word, n, indexed)
        yield from rows(found)
    yield from rows(group.finish() if group else [])


def dealt(words: DataFrame, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """One row per word, group and block of the group: the word is indexed in one block and looked up in all."""
    size = F.length("word")
    kinds = F.array(
        *[F.struct(c.alias("length"), F.lit(at_end).alias("at_end")) for c in (size, size - 1) for at_end in (False, True)]
    )
    kept = F.filter(kinds, lambda k: k["length"] >= min_length)
    half = (F.col("length") / 2).cast("int")
    part = F.when(F.col("at_end"), F.right("word", half)).otherwise(F.left("word", half))
    grouped = words.select("word", "n", F.inline(kept)).withColumn("part", part)
    large = grouped.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > block)
    large = stored(large.withColumn("blocks", F.ceil(F.col("words") / block).cast("int")).drop("words"), "spelling-large")
    split = grouped.join(large, GROUP, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    spread = split.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.withColumn("indexed", F.col("block") == mine).drop("blocks")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """(word, n_near, near_n, near) of each word of (word, n) with a near word: their number, the most frequent one and its count."""
    rows = dealt(words, min_length, block).repartition(*GROUP, "block")
    rows = rows.sortWithinPartitions(*GROUP, "block", F.desc("indexed"))
    found = rows.mapInArrow(look_up_groups, FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms. Each round doubles the steps."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = links.select("word", "root").join(on, "root", "left")
        step = step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        links = stored(step, "spelling-roots")
        if not links.where("moved").head(1):
            return links.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n)."""
    words = stored(words.select("word", "n"), "spelling-words")
    joined = words.join(near_words(words, min_length, block), "word", "left")
    wins = F.col("near_n") >= ratio * F.col("n")
    known = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(wins, F.col("near")).alias("form"),
        F.when(wins, F.col("near_n")).alias("form_n"),
    )
    known = stored(known, "spelling-forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
