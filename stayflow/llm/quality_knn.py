"""Quality classifier: votes of the nearest labelled texts in a latent-semantic space.

Terms of a text are its tokens as shapes (runs of letters shortened, other characters kept), tokens that repeat the one
before, and its lower-cased words, hashed to ``TERMS`` positions. Shapes count by their share of the tokens; word counts are
damped and weighted by inverse document frequencies, which are summed over all documents. A truncated singular value decomposition of a bounded sample of labelled texts (``MAX_TRAINING_ROWS`` at most,
half of them for each label) gives the latent space. Tasks count the terms of that sample, one task decomposes the counts, and the
driver sees the model only, no text. The labelled vectors, at most that many rows of ``DIMENSIONS`` numbers, are broadcast; every
document is compared with all of them by exact cosine products, block by block, and its ``NEIGHBOURS`` nearest vote with their
labels, weighted by similarity. Votes are corrected for the labels' shares in the sample.

Defined results: texts without a term (null, empty) and texts that resemble nothing score the share of label 1 among the
learning rows; without rows of both labels everything does. ``vote`` gives such texts null instead. Ties in similarity are broken by the order of the labelled rows. Repeated
rows score alike. Labels, language, source and id are not inputs of the score. Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, words_of
from .labelled import training_rows

TERMS, SHAPES = 4096, 1024
WORD_WEIGHT = 0.5
DIMENSIONS = 48
MAX_TRAINING_ROWS = 4000
NEIGHBOURS = 15
BLOCK = 512
COUNTS = T.StructType(
    [T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.FloatType()))]
)
#: Letters to x or X, digits to 0; other ASCII characters stay.
_KINDS = bytes(
    ord("0") if chr(b).isdigit() and b < 128 else ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else b
    for b in range(256)
)
_RUNS = re.compile(rb"([xX0])\1+")


class ShapeTerms(dict):
    """Positions of shapes: ``Xxxxxxx,`` counts as ``Xx,`` and ``XX!!`` as ``X!!``; what kind of token it is, not which.

    Only the first 12 bytes of a shape count: longer ones are rare and say nothing more about prose."""

    def __missing__(self, token: bytes) -> int:
        term = crc32(_RUNS.sub(rb"\1", token)[:12]) % (SHAPES - 1)
        if len(self) < 100_000:
            self[token] = term
        return term


_shape_terms = ShapeTerms()


def term_counts(data: bytes | None) -> np.ndarray:
    """Counts of the hashed terms: shapes of the tokens, tokens equal to the one before, words."""
    if not data:
        return np.zeros(TERMS, np.float32)
    tokens = data.split()
    shapes = np.array(list(map(_shape_terms.__getitem__, data.translate(_KINDS).split())), np.int64)
    words = np.array(list(map(crc32, words_of(data))), np.int64) % (TERMS - SHAPES) + SHAPES
    counts = np.bincount(np.concatenate([shapes, words]), minlength=TERMS).astype(np.float32)
    counts[SHAPES - 1] = sum(map(eq, tokens, tokens[1:]))
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of two parts: roots of the shares of shapes, and damped word counts times inverse document frequencies."""
    shapes, words = counts[:, :SHAPES], np.log1p(counts[:, SHAPES:]) * idf[SHAPES:]
    total = shapes[:, :-1].sum(axis=1, keepdims=True)
    size = np.linalg.norm(words, axis=1, keepdims=True)
    return np.hstack([np.sqrt(shapes / np.maximum(total, 1)), WORD_WEIGHT * words / np.where(size > 0, size, 1)])


@dataclass
class Neighbours:
    """The latent space with its labelled vectors; ``lift`` is the weight of a vote for each label."""

    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    lift: np.ndarray
    rate: float

    def votes(self, texts: list[bytes | None]) -> np.ndarray:
        """The weighted share of good neighbours; not a number where none voted."""
        out = np.full(len(texts), np.nan)
        k = min(NEIGHBOURS, len(self.vectors))
        for at in range(0, len(texts) if k else 0, BLOCK):
            x = weighted(np.array([term_counts(t) for t in texts[at : at + BLOCK]]), self.idf) @ self.space
            size = np.linalg.norm(x, axis=1, keepdims=True)
            near = (x / np.where(size > 0, size, 1)) @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(near, best, axis=1), 0, None) ** 4
            mine = self.labels[best]
            yes = (weight * mine).sum(axis=1) * self.lift[1]
            no = (weight * (1 - mine)).sum(axis=1) * self.lift[0]
            known = (size[:, 0] > 0) & (yes + no > 0)
            out[at : at + BLOCK] = np.where(known, yes / np.where(known, yes + no, 1), np.nan)
        return out

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        votes = self.votes(texts)
        return np.where(np.isnan(votes), self.rate, votes)


def document_frequencies(documents: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each hashed term occurs, and the number of documents with text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for t in batch.column("text"):
                if t.is_valid:
                    total += term_counts(t.as_buffer().to_pybytes()) > 0
                    n += 1
        total = np.append(total, n)
        yield pa.RecordBatch.from_arrays([pa.array(range(TERMS + 1), pa.int32()), pa.array(total)], names=["term", "n"])

    counted = documents.select(F.col(text).cast("binary").alias("text")).mapInArrow(count, "term int, n long")
    df = np.zeros(TERMS + 1)
    for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    return df[:TERMS], int(df[TERMS])


def top_directions(x: np.ndarray, k: int, extra: int = 16, rounds: int = 6) -> np.ndarray:
    """The leading right singular vectors of ``x`` (columns), by subspace iteration from a fixed start."""
    start = np.random.default_rng(0).standard_normal((x.shape[1], k + extra)).astype(np.float32)
    q = np.linalg.qr(start)[0]
    for _ in range(rounds):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, turn = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ turn.T)[:, :k]


@F.arrow_udf(COUNTS)
def sparse_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The terms of a text with their counts."""
    for batch in batches:
        counts = [term_counts(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch]
        terms = [np.flatnonzero(c) for c in counts]
        ends = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
        terms_of = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *terms]), pa.int32()))
        found = [c[t] for c, t in zip(counts, terms)]
        counts_of = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.float32), *found]), pa.float32()))
        yield pa.StructArray.from_arrays([terms_of, counts_of], names=COUNTS.names)


def counted_terms(rows: DataFrame) -> DataFrame:
    """(label, terms, counts) of the learning rows (text, label), in one partition in the order of the texts."""
    counted = rows.select("text", "label", sparse_counts(F.col("text").cast("binary")).alias("c"))
    ordered = counted.repartition(1).sortWithinPartitions("text", "label")
    return ordered.select(F.col("label").cast("double").alias("label"), "c.terms", "c.counts")


def fit(counted: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The latent space, the rows in it at length 1, and their labels; None without rows of both labels.

    One task does it: the rows are bounded by the size of the sample, whatever the table.
    """

    def decomposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [b for b in batches if b.num_rows]
        y = np.concatenate([np.zeros(0), *(b.column("label").to_numpy() for b in kept)])
        if not len(y) or y.min() == y.max():
            return
        rows = ((t.values.to_numpy(), c.values.to_numpy()) for b in kept for t, c in zip(b.column("terms"), b.column("counts")))
        x = np.empty((len(y), TERMS), np.float32)
        for at in range(0, len(y), BLOCK):
            dense = np.zeros((min(BLOCK, len(y) - at), TERMS), np.float32)
            for row, (terms, counts) in zip(dense, rows):
                row[terms] = counts
            x[at : at + BLOCK] = weighted(dense, idf)
        space = top_directions(x, DIMENSIONS).astype(np.float32)
        z = x @ space
        size = np.linalg.norm(z, axis=1, keepdims=True)
        z = (z / np.where(size > 0, size, 1)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in (space, z, y)], names=["space", "z", "y"])

    found = counted.mapInArrow(decomposed, "space binary, z binary, y binary").first()
    if found is None:
        return None
    space, z, y = (np.frombuffer(found[c], k) for c, k in (("space", np.float32), ("z", np.float32), ("y", float)))
    return space.reshape(TERMS, -1), z.reshape(len(y), -1), y


def learn(documents: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> Neighbours:
    df, n_docs = document_frequencies(documents)
    idf = np.log((1 + n_docs) / (1 + df)).astype(np.float32) + 0.1
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = {r[label]: r["n"] for r in known.collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    rate = n1 / (n0 + n1) if n0 + n1 else 0.0
    none = np.zeros((0, DIMENSIONS), np.float32)
    if not n0 or not n1:
        return Neighbours(idf, np.zeros((TERMS, DIMENSIONS), np.float32), none, np.zeros(0), np.ones(2), rate)
    fitted = fit(counted_terms(training_rows(documents, labels, label, max_rows, max_rows // 2)), idf)
    if fitted is None:
        return Neighbours(idf, np.zeros((TERMS, DIMENSIONS), np.float32), none, np.zeros(0), np.ones(2), rate)
    space, z, y = fitted
    lift = np.array([n0 / (y == 0).sum(), n1 / (y == 1).sum()])
    return Neighbours(idf, space, z, y, lift / lift.sum(), rate)


def score_with(text: Column, model: Neighbours, documents: DataFrame, vote: bool = False) -> Column:
    """The score of a text, or with ``vote`` only what its neighbours voted: null if none did."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else None for t in batch]
            yield pa.array(m.votes(texts) if vote else m.scores(texts), pa.float64(), from_pandas=True)

    return scored(text.cast("binary"))


def classify_quality(
    documents: DataFrame, labels: DataFrame, into: str = "quality_score", vote: bool = False, **options
) -> DataFrame:
    """The documents with their score in ``into``; with ``vote`` it is null where no neighbour voted."""
    return documents.withColumn(into, score_with(F.col("text"), learn(documents, labels, **options), documents, vote))
