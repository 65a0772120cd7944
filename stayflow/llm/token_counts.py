"""Token counts without a shuffle of pre-tokens: a broadcast table of frequent ones, and a cache in every worker for the rest.

A byte-level BPE file first cuts text into pre-tokens (a word with the blank before it, a run of digits, ...) and merges bytes
inside each one only. So a text has as many tokens as its pre-tokens together, and equal pre-tokens always have the same number.

1. Every task sketches the frequent pre-tokens of its documents (frequent-items sketches with ``TRACKED`` counters together, one for
   each of ``SKETCHES`` hash classes). These sketches are shuffled and merged, no pre-token; all documents take part.
2. The ``FREQUENT`` most frequent ones of at most ``MAX_BYTES`` bytes are encoded once and broadcast as packed bytes with their
   lengths: at most ``FREQUENT * (MAX_BYTES + 2)`` bytes, whatever the corpus.
3. A worker sums the lengths it finds in that table. Misses are looked up in the worker's cache of at most ``CACHED`` entries, which
   starts anew when it is full; what is in neither is encoded by the library, all misses of a piece of text in one call.

The table and the cache only save work: every length comes from the library, so results do not depend on them. Texts are counted
piece by piece. A piece ends before a blank or line feed between two ASCII letters or digits, where no pre-token can cross, so a very
long text needs memory for one piece (a text without such a place is one piece). Special strings of the file inside a text count
as one token each and part it, as the library does by default.

Pre-tokens are cut by the file's pattern; a piece with characters outside of ``STABLE``, whose classes differ between Unicode
versions, is cut by the library's own rule instead.

Null and empty texts have 0 tokens. Repeated rows and null ids are counted row by row; an empty table gives an empty table.
Other columns pass through; a column named as the result is replaced. Files that are not byte-level BPE, or that change the text
before cutting it, are an error.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FREQUENT = 30_000
TRACKED = 65_536
MAX_BYTES = 32
CACHED = 1 << 19
#: Pre-tokens are dealt to so many sketches by their hash, so that no task merges all of them.
SKETCHES = 16
#: The sketches of one hash are merged in up to this many groups before the last merge.
SKETCH_GROUPS = 256
#: Characters of a piece, about.
PIECE = 1 << 16

# Fixed value: the pattern by which byte-level files cut text, without its last look ahead, for the sketches.
JVM_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
# Ranges whose letters, numbers and blanks are the same in all Unicode versions of the last ten years.
STABLE = "\u0000-՗א-תء-ي٠-٩अ-हก-ะḀ-ỿ‐-‧‰-⁞₠-₺←-⏳①-⛿\u3000-〩ぁ-ゖァ-ヾ一-龥가-힣！-～"
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def class_of(major: str) -> str:
    """The stable characters of a major category as ranges of a character class."""
    stable = [chr(c) for a, b in re.findall("(.)-(.)", STABLE, re.DOTALL) for c in range(ord(a), ord(b) + 1)]
    runs: list[list[str]] = []
    for c in stable:
        if unicodedata.category(c)[0] == major:
            if runs and ord(c) == ord(runs[-1][1]) + 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return "".join(f"{a}-{b}" for a, b in runs)


_L, _N = class_of("L"), class_of("N")
#: The file's pattern over stable characters.
_PATTERN = re.compile(
    rf" ?[{_L}]+| ?[{_N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{BLANKS}{_L}{_N}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
_UNSTABLE = re.compile(f"[^{STABLE}]")
_SEAM = re.compile(r"[A-Za-z0-9](?=[ \n][A-Za-z0-9])")


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in parts of about ``size`` characters that end where a pre-token ends in any case."""
    start = 0
    while len(text) - start > size:
        seam = _SEAM.search(text, start + size - 1)
        if not seam:
            break
        yield text[start : seam.end()]
        start = seam.end()
    yield text[start:] if start else text


def pack(lengths: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """All keys in one string of bytes, their sizes, their numbers of tokens."""
    keys = [k.encode() for k in lengths]
    return b"".join(keys), bytes(map(len, keys)), bytes(lengths.values())


def unpack(packed: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    joined, sizes, counts = packed
    out, at = {}, 0
    for size, n in zip(sizes, counts):
        out[joined[at : at + size].decode()] = n
        at += size
    return out


class TokenCounter:
    """Counts tokens as the library does, with a table of known lengths and a bounded cache."""

    def __init__(self, spec: str, frequent: dict[str, int] | None = None, cached: int = CACHED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        parts = json.loads(spec)
        before = parts.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        tokens = parts.get("added_tokens") or []
        if not plain or parts.get("normalizer") or parts["model"]["type"] != "BPE" or parts["model"].get("dropout"):
            raise ValueError("only byte-level BPE files without a normaliser can be counted by pre-tokens")
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in tokens):
            raise ValueError("special tokens that take neighbouring characters are not supported")
        special = sorted((t["content"] for t in tokens), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.cut = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        # The same merges over a whole string: a pre-token that is known to be one needs no cutting.
        whole = {**parts, "added_tokens": [], "pre_tokenizer": {**before, "use_regex": False}, "post_processor": None}
        self.encode = Tokenizer.from_str(json.dumps(whole)).encode_batch_fast
        self.frequent, self.cached = frequent or {}, cached
        self.known = dict(self.frequent)  # and, up to ``cached`` entries more, what this worker has met

    def lengths(self, words: list[str]) -> list[int]:
        return [len(e.ids) for e in self.encode(words, add_special_tokens=False)]

    def pre_tokens(self, piece: str) -> list[str]:
        if _UNSTABLE.search(piece):
            return [piece[a:b] for _, (a, b) in self.cut(piece)]
        return _PATTERN.findall(piece)

    def count_piece(self, piece: str) -> int:
        words = self.pre_tokens(piece)
        found = list(map(self.known.get, words))
        total = sum(filter(None, found))
        if None not in found:
            return total
        missed = [w for w, n in zip(words, found) if n is None]
        new = list(dict.fromkeys(missed))
        fresh = dict(zip(new, self.lengths(new)))
        total += sum(map(fresh.__getitem__, missed))
        if len(self.known) + len(fresh) > len(self.frequent) + self.cached:
            self.known = dict(self.frequent)
        self.known.update((w, n) for w, n in fresh.items() if len(w) <= MAX_BYTES)
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(self.count_piece(p) for part in parts if part for p in pieces(part))


def frequent_pre_tokens(documents: DataFrame, text: str = "text", most: int = FREQUENT, tracked: int = TRACKED) -> list[str]:
    """The most frequent pre-tokens of all documents, by merged sketches; a result of at most ``most`` short texts."""
    cut = F.regexp_extract_all(F.col(text), F.lit(JVM_PATTERN), F.lit(0))
    words = documents.select(F.explode(cut).alias("w"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g"))
    short = words.where(F.octet_length("w") <= MAX_BYTES).withColumn("k", F.pmod(F.xxhash64("w"), F.lit(SKETCHES)))
    counters, wanted = max(1, tracked // SKETCHES), max(1, most // SKETCHES)
    sketches = short.groupBy("k", "g").agg(F.expr(f"approx_top_k_accumulate(w, {counters})").alias("s"))
    merged = sketches.groupBy("k").agg(F.expr(f"approx_top_k_combine(s, {counters})").alias("s"))
    found = merged.select(F.expr(f"approx_top_k_estimate(s, {wanted})").alias("e")).collect()
    return sorted(r["item"] for row in found for r in row["e"])


_COUNTERS: dict[str, TokenCounter] = {}


def counter_of(shared: tuple[str, str, tuple[bytes, bytes, bytes]]) -> TokenCounter:
    """The worker's counter for a file and a table; it outlives a task, and so does its cache."""
    key, spec, packed = shared
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TokenCounter(spec, unpack(packed))
    return _COUNTERS[key]


def with_token_counts(
    documents: DataFrame, path: str, text: str = "text", into: str = "n_tokens", most: int = FREQUENT, tracked: int = TRACKED
) -> DataFrame:
    """The documents with their number of tokens in ``into``; ``path`` is read by the driver only and sent to the executors."""
    spec = Path(path).read_text(encoding="utf-8")
    counter = TokenCounter(spec)
    words = frequent_pre_tokens(documents, text, most, tracked)
    packed = pack(dict(zip(words, counter.lengths(words))))
    digest = reduce(lambda h, part: h.update(part) or h, [spec.encode(), *packed], hashlib.sha256()).hexdigest()
    shared = documents.sparkSession.sparkContext.broadcast((digest, spec, packed))

    @F.arrow_udf(T.LongType())
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = counter_of(shared.value)
        for batch in batches:
            yield pa.array([mine.count(t.as_py()) for t in batch], pa.int64())

    return documents.withColumn(into, counted(F.col(text)))


def over_limit(n_tokens: Column, limit: int) -> Column:
    return n_tokens > limit
