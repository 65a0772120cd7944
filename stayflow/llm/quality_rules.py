"""Quality rules: simple counts, and the divergence of a document from language references.

Two histograms of a document are compared with references by the Jensen-Shannon distance (square root of the divergence
to base 2, so 0 to 1): its characters by class, and its words over the most common words of all references plus one bin for
all others. A reference is the sum over all documents of one value of ``lang``; documents without one, null or empty, have a
reference of their own. The nearest reference counts, so a wrong ``lang`` does not hurt a document. A distance is judged only if
the text is long enough for it to mean something (``MIN_CHARS``, ``MIN_WORDS``), and only for documents whose own language has a
reference: foreign ones say nothing about it. All others pass.

References: words are counted in bounded dictionaries inside the tasks and summed by word; only the ``COMMON_WORDS`` most
frequent words of a language and its character classes are collected. A language has a reference if it has at least
``MIN_REFERENCE_WORDS`` words and ``MIN_REFERENCE_SHARE`` of the words of all documents. So there are at most 1 /
``MIN_REFERENCE_SHARE`` references of a fixed size, however dirty ``lang`` is, and at any size of the corpus; words and language
names above ``KEY_BYTES`` bytes enter as digests. A document visits only the references that know one of its words.

Defined results: null and empty texts have no words and fail the base rule; very long texts are measured whole, as one value of
a batch. Repeated rows are judged each by itself; of equally frequent words the smaller bytes are the common ones (digests come
last). Where the document's language has no reference, distances are null and only the base rule decides. An empty table gives an
empty result. Other columns pass through; one named like ``into`` is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, words_of

COMMON_WORDS = 100
MIN_REFERENCE_WORDS = 2000
MIN_REFERENCE_SHARE = 1 / 500
KEY_BYTES = 64
MIN_CHARS, MIN_WORDS = 200, 50
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.31, 0.50
WINDOW = 5
FLUSH = 200_000
SYMBOLS = b"#*$%&|<>"
CLASSES = ["lower", "upper", "digit", "space", "line", "mark", "symbol", "other"]


def _class_of(byte: int) -> int:
    c = chr(byte)
    if byte >= 0x80:
        return 8 if byte < 0xC0 else 7  # continuation bytes are not counted
    if c.isalpha():
        return 0 if c.islower() else 1
    if c.isdigit():
        return 2
    if c in " \t":
        return 3
    if c in "\n\r\v\f":
        return 4
    return 5 if c in ".,;:!?'\"()-" else 6


_CLASS = np.array([_class_of(b) for b in range(256)], np.uint8)

MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("char_distance", T.DoubleType()),
        T.StructField("word_distance", T.DoubleType()),
    ]
)


@dataclass
class References:
    """Counts of the character classes, one row per language, and shares of the common words of each language.

    ``langs`` names the rows; '' stands for documents without a language. The languages that have ``words[i]`` among their common
    words are ``owner[heads[i] : heads[i + 1]]``, with its ``share`` there. ``rest`` is the share of all other words of a language.
    """

    langs: list[str]
    chars: np.ndarray
    words: list[bytes]
    heads: np.ndarray
    owner: np.ndarray
    share: np.ndarray
    rest: np.ndarray


def lang_key(lang: Column) -> Column:
    """Name of a language: '' for null, and a digest of long values."""
    name = F.coalesce(lang.cast("string"), F.lit(""))
    return F.when(F.octet_length(name) <= KEY_BYTES, name).otherwise(F.sha2(name, 256))


def word_keys(words: list[bytes]) -> list[bytes]:
    """The words, long ones as digests. No word in UTF-8 begins with byte 255."""
    if not words or max(map(len, words)) <= KEY_BYTES:
        return words
    return [w if len(w) <= KEY_BYTES else b"\xff" + xxhash.xxh3_128_digest(w) for w in words]


def class_counts(data: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=9)[: len(CLASSES)]


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur at least twice."""
    grams = list(zip(*(words[i:] for i in range(size))))
    if len(set(grams)) == len(grams):
        return 0
    times = Counter(grams)
    covered = upto = 0
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered += i + size - max(i, upto)
            upto = i + size
    return covered


def distance(counts: np.ndarray, references: np.ndarray) -> float | None:
    """Smallest Jensen-Shannon distance of a histogram (or one per row) to the rows of ``references``."""
    if not len(references) or not counts.sum():
        return None
    p = counts / counts.sum(axis=-1, keepdims=True)
    q = references / references.sum(axis=1, keepdims=True)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=1)
    return float(np.sqrt(np.clip((left + right) / 2, 0.0, 1.0)).min())


def information(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What a bin with shares p and q adds to twice the Jensen-Shannon divergence."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)


def word_distance(words: list[bytes], refs: References, index: dict[bytes, int]) -> float | None:
    """Smallest Jensen-Shannon distance of the words to a reference.

    A common word that the document lacks adds its whole share, so only the common words in the document are looked at.
    """
    if not refs.langs or not words:
        return None
    times = Counter(filter(index.__contains__, words))
    at = np.fromiter((index[w] for w in times), np.int64, len(times))
    low, n = refs.heads[at], refs.heads[at + 1] - refs.heads[at]
    entry = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    p = np.repeat(np.fromiter(times.values(), float, len(times)) / len(words), n)
    q, row, rows = refs.share[entry], refs.owner[entry], len(refs.langs)
    others = np.clip(1 - np.bincount(row, p, rows), 0.0, 1.0)
    twice = 1 - refs.rest + np.bincount(row, information(p, q) - q, rows) + information(others, refs.rest)
    return float(np.sqrt(np.clip(twice / 2, 0.0, 1.0)).min())


def measure(data: bytes, lang: str, refs: References, index: dict[bytes, int]) -> dict:
    words = data.split()
    n_chars = sum(map(len, words))
    marks = np.frombuffer(data, np.uint8)
    chars = class_counts(data)
    lines = [x for x in data.split(b"\n") if x.strip()]
    plain = word_keys(words_of(data))
    judged = lang in refs.langs
    return {
        "n_words": len(words),
        "word_chars": n_chars - int(((marks & 0xC0) == 0x80).sum()),
        "n_symbols": sum(data.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS))),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
        "char_distance": distance(chars, refs.chars) if judged and chars.sum() >= MIN_CHARS else None,
        "word_distance": word_distance(plain, refs, index) if judged and len(plain) >= MIN_WORDS else None,
    }


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, key, n): words and character classes by language; the dictionaries of all languages together are bounded."""
    by_lang: dict[str, Counter] = {}
    chars: dict[str, np.ndarray] = {}
    held = 0

    def out() -> pa.RecordBatch:
        rows = [(lang, "word", k, n) for lang, words in by_lang.items() for k, n in words.items()]
        rows += [(lang, "total", b"", words.total()) for lang, words in by_lang.items()]
        rows += [(lang, "class", bytes([i]), int(n)) for lang, c in chars.items() for i, n in enumerate(c)]
        lang, kind, key, n = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(kind, pa.string()), pa.array(key, pa.binary()), pa.array(n, pa.int64())],
            names=["lang", "kind", "key", "n"],
        )

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            if not text.is_valid:
                continue
            data = text.as_buffer().to_pybytes()
            words = by_lang.setdefault(lang, Counter())
            before = len(words)
            words.update(word_keys(words_of(data)))
            held += len(words) - before + (lang not in chars) * len(CLASSES)
            chars[lang] = chars.get(lang, 0) + class_counts(data)
            if held > FLUSH:
                yield out()
                by_lang, chars, held = {}, {}, 0
    yield out()


def references(documents: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """Language references from all documents."""
    plain = documents.select(lang_key(F.col(lang)).alias("lang"), F.col(text).cast("binary").alias("text"))
    counted = plain.mapInArrow(count_words, "lang string, kind string, key binary, n long")
    sums = counted.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    top = sums.withColumn("place", F.row_number().over(first)).where(F.col("place") <= COMMON_WORDS)
    top = stored(top.select("lang", "kind", "key", "n"), "quality-references")
    totals = top.where("kind = 'total'")
    least = max(MIN_REFERENCE_WORDS, MIN_REFERENCE_SHARE * (totals.agg(F.sum("n")).first()[0] or 0))
    # No more languages than 1 / MIN_REFERENCE_SHARE can have that share.
    large = totals.where(F.col("n") >= least).select("lang")
    rows = top.join(F.broadcast(large), "lang").orderBy("lang", "kind", "key").collect()
    langs = [r["lang"] for r in rows if r["kind"] == "total"]
    row = {x: i for i, x in enumerate(langs)}
    total = np.array([r["n"] for r in rows if r["kind"] == "total"], float)
    chars = np.zeros((len(langs), len(CLASSES)))
    for r in rows:
        if r["kind"] == "class":
            chars[row[r["lang"]], r["key"][0]] = r["n"]
    common = sorted((bytes(r["key"]), row[r["lang"]], r["n"]) for r in rows if r["kind"] == "word")
    words = sorted({w for w, _, _ in common})
    times = Counter(w for w, _, _ in common)
    heads = np.cumsum([0, *(times[w] for w in words)])
    owner = np.array([i for _, i, _ in common], np.int64)
    share = np.array([n for _, _, n in common], float) / total[owner]
    rest = np.clip(1 - np.bincount(owner, share, len(langs)), 0.0, 1.0)
    return References(langs, chars, words, heads, owner, share, rest)


def judge(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    into: str = "quality",
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """The documents with a struct ``into``: the measures, ``base_failed`` and ``kept``."""
    shared = documents.sparkSession.sparkContext.broadcast(references(documents, text, lang))

    @F.arrow_udf(MEASURES)
    def measured(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_type

        refs, kind = shared.value, to_arrow_type(MEASURES)
        index = {w: i for i, w in enumerate(refs.words)}
        for texts, names in batches:
            rows = zip(texts, names.to_pylist())
            yield pa.array([measure(t.as_buffer().to_pybytes() if t.is_valid else b"", x, refs, index) for t, x in rows], kind)

    found = documents.withColumn(into, measured(F.col(text).cast("binary"), lang_key(F.col(lang))))
    m = F.col(into)
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    far = F.coalesce(m["char_distance"] > max_char_distance, F.lit(False)) | F.coalesce(
        m["word_distance"] > max_word_distance, F.lit(False)
    )
    return found.withColumn(into, F.struct(f"{into}.*", failed.alias("base_failed"), (~failed & ~far).alias("kept")))
