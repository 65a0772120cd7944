"""Removal of long repeated substrings by anchored buckets of sorted 50-byte strings.

This takes the place of a run-compressed Burrows-Wheeler index with matching statistics; the README says why. ``RunIndex`` and the
query keep their names. The result is exact.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller id. All such strings of
all documents are compared, exactly and without pairs of documents:

* A string of 50 bytes has 35 substrings of 16 bytes; the one with the smallest hash is its anchor. Equal strings have equal
  anchors, so strings are dealt out by anchor. Neighbouring strings mostly share an anchor and travel as one piece of text (66
  bytes for 17 strings on average), packed and compressed.
* Substrings that are very frequent (``HOT_SHARE`` of all pieces; there can be no more than 2 / ``HOT_SHARE``) are counted first
  and come last in the hash order. They anchor only strings that hold nothing else, so a common phrase does not gather
  the different texts around it in one task.
* A task that reads the texts sends each distinct piece once, for the smallest of its documents; for its other documents it
  is settled there. A passage that a third of all documents share thus costs one piece per task.
* In each bucket of anchors, pieces that are equal as a whole are settled by their smallest document. The rest are different
  pieces with a common anchor: the starts of all their strings are sorted by their 50 bytes, and a string is matched if an equal one
  starts in a smaller document. Equal strings are further ordered by the preceding byte and the document, and each stretch of one
  preceding byte keeps its smallest document; this order is not used beyond that. There is no backward step and no match length.

The runs of matched strings come back to their documents, are joined to spans and cut out.

Defined results: null texts are empty; texts shorter than 50 bytes lose nothing; rows without a doc_id neither lose bytes nor
cause losses; rows that repeat a doc_id do not count as smaller than each other. Ids must be whole numbers or texts of such; others
are an error. Very long texts are cut into slices that overlap by a string. An empty table gives an empty result. Other columns are
not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

LENGTH, ANCHOR = 50, 16
WINDOW = LENGTH - ANCHOR + 1
HOT_SHARE = 1e-4
CHUNK_BYTES = 512 << 10
SLICE_BYTES = 6 << 20
BUCKET_BYTES = 4 << 20
LEVEL = 3
FLUSH = 500_000
_HOT_BITS = 20
_P, _Q, _R = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))

PIECES = "bucket int, spans binary, pieces binary"
MARKS = "part int, spans binary"
SPANS = "doc_id long, doc_key long, starts array<int>, ends array<int>"
RESULT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
    ]
)


def eight_bytes(data: bytes) -> np.ndarray:
    """The 8 bytes from each position on, as a number (view; no copy)."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, strides=(1,))


def anchor_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """63-bit hash of 16 bytes given as two numbers."""
    h = (first * _P) ^ (second * _Q)
    h ^= h >> np.uint64(29)
    h *= _R
    h ^= h >> np.uint64(32)
    return h >> np.uint64(1)


class Hot:
    """Frequent substrings by hash, with a bitmap that answers most questions."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.bitmap = np.zeros(1 << _HOT_BITS, bool)
        self.bitmap[self.hashes & np.uint64((1 << _HOT_BITS) - 1)] = True

    def push_back(self, h: np.ndarray) -> np.ndarray:
        """The hashes with the frequent ones behind all others."""
        if len(self.hashes):
            maybe = np.flatnonzero(self.bitmap[h & np.uint64((1 << _HOT_BITS) - 1)])
            h[maybe[np.isin(h[maybe], self.hashes)]] |= np.uint64(1 << 63)
        return h


def cut(texts: list[bytes], hot: Hot) -> tuple[np.ndarray, ...]:
    """Pieces of some texts: document, start in it, number of strings, anchor hash, and place of the anchor in the piece."""
    data = b"".join(texts)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint8)
    words = np.ascontiguousarray(eight_bytes(data))
    h = hot.push_back(anchor_hash(words[:-8], words[8:]))
    low, span = h, 1
    while span * 2 <= WINDOW:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < WINDOW:
        low = np.minimum(low[: len(low) - (WINDOW - span)], low[WINDOW - span :])
    n = len(low)
    # Strings that begin in the last 49 bytes of a text would run into the next one.
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.add.at(inside, np.maximum(ends - LENGTH + 1, starts), -1)
    valid = np.cumsum(inside)[:n] > 0
    new = np.ones(n, bool)
    new[1:] = low[1:] != low[:-1]
    new[starts[starts < n]] = True
    stops = np.flatnonzero(new | ~valid)
    at = np.flatnonzero(new & valid)
    until = np.append(stops, n)[np.searchsorted(stops, at, side="right")]
    doc = np.searchsorted(ends, at, side="right")
    anchor = low[at]
    place = np.zeros(len(at), np.uint8)
    for o in range(WINDOW - 1, -1, -1):
        place[h[at + o] == anchor] = o
    return doc, at - starts[doc], until - at, anchor, place


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of at most ``most`` bytes (a longer text is alone), with the number of the first."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, texts[first:]


def cut_all(texts: list[bytes], hot: Hot) -> tuple[np.ndarray, ...]:
    parts = []
    for first, some in chunks(texts):
        doc, start, run, anchor, place = cut(some, hot)
        parts.append((doc + first, start, run, anchor, place))
    return tuple(np.concatenate(x) for x in zip(*parts))


def groups(sorted_values: np.ndarray) -> np.ndarray:
    """First positions of the groups of equal neighbours."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, keys and texts of some documents at a time, in the order of the ids."""
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    keys = batch.column("doc_key").to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text").take(pa.array(order))]
    for first, some in chunks(texts, SLICE_BYTES):
        part = order[first : first + len(some)]
        yield ids[part], keys[part], some


def count_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, n): anchors with at least half the hot share within the batch, and under null the number of pieces."""
    none = Hot(np.zeros(0, np.uint64))
    for _, _, texts in chain.from_iterable(map(slices, batches)):
        anchor = np.sort(cut_all(texts, none)[3])
        heads = groups(anchor)
        n = np.diff(np.append(heads, len(anchor)))
        often = n >= max(2, HOT_SHARE / 2 * len(anchor))
        values = pa.array(anchor[heads][often].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([values, pa.nulls(1, pa.int64())]), pa.array(np.append(n[often], len(anchor)))],
            names=["anchor", "n"],
        )


def hot_anchors(rows: DataFrame) -> np.ndarray:
    counted = rows.mapInArrow(count_hot, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    counted = stored(counted, "run-index-hot")
    total = counted.where("anchor is null").select(F.sum("n")).first()[0] or 0
    # Their number is at most 2 / HOT_SHARE, whatever the corpus.
    often = counted.where("anchor is not null").where(F.col("n") >= max(2.0, HOT_SHARE / 2 * total))
    return np.array([r["anchor"] for r in often.select("anchor").collect()], np.int64).view(np.uint64)


def spans_by_doc(ids, keys, starts, ends) -> pa.RecordBatch:
    """Spans to rows of ``SPANS``, one per document."""
    order = np.lexsort((starts, keys, ids))
    ids, keys, starts, ends = ids[order], keys[order], starts[order], ends[order]
    fresh = np.ones(len(ids), bool)
    if len(ids):
        fresh[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    heads = np.flatnonzero(fresh)
    offsets = pa.array(np.append(heads, len(ids)).astype(np.int32))
    lists = lambda v: pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[heads]), pa.array(keys[heads]), lists(starts), lists(ends)], names=["doc_id", "doc_key", "starts", "ends"]
    )


def pack(ids, keys, starts, runs, places, texts: list[bytes]) -> bytes:
    head = np.array([len(ids)], np.int64).tobytes()
    columns = [ids.astype(np.int64), keys.astype(np.int64), starts.astype(np.uint32), runs.astype(np.uint32), places]
    return zstandard.ZstdCompressor(level=LEVEL).compress(head + b"".join(c.tobytes() for c in columns) + b"".join(texts))


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    n, at, columns = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in (np.int64, np.int64, np.uint32, np.uint32, np.uint8):
        columns.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return (*columns, data[at:])


def pack_spans(ids, keys, starts, ends, parts: int) -> list[tuple[int, bytes]]:
    """Spans packed by part of the documents, so that their number of rows doesn't depend on the documents."""
    part = (ids % parts).astype(np.int32)
    order = np.lexsort((starts, keys, ids, part))
    heads = groups(part[order])
    out = []
    for a, b in zip(heads, np.append(heads[1:], len(order))):
        some = order[a:b]
        columns = [ids[some].astype(np.int64), keys[some].astype(np.int64), starts[some].astype(np.int32), ends[some].astype(np.int32)]
        head = np.array([len(some)], np.int64).tobytes()
        out.append((int(part[some[0]]), zstandard.ZstdCompressor(level=LEVEL).compress(head + b"".join(c.tobytes() for c in columns))))
    return out


def unpack_spans(packed: bytes) -> tuple[np.ndarray, ...]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    n, at, columns = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in (np.int64, np.int64, np.int32, np.int32):
        columns.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return tuple(columns)


def cutter(hot: Broadcast, buckets: int):
    """Texts to pieces by bucket, and the spans that are settled within a slice."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Hot(hot.value)
        for ids, keys, texts in chain.from_iterable(map(slices, batches)):
            doc, start, run, anchor, place = cut_all(texts, frequent)
            whole = [texts[d][s : s + r + LENGTH - 1] for d, s, r in zip(doc.tolist(), start.tolist(), run.tolist())]
            digest = np.array([xxhash.xxh64_intdigest(w) for w in whole], np.uint64)
            order = np.argsort(digest, kind="stable")  # documents ascend within equal pieces
            heads = groups(digest[order])
            own = ids[doc[order]]
            least = np.repeat(own[heads], np.diff(np.append(heads, len(order))))
            settled = order[own > least]
            d = doc[settled]
            done = pack_spans(ids[d], keys[d], start[settled], start[settled] + run[settled] + LENGTH - 1, buckets)
            sent = np.sort(order[own == least])
            # Smallest hashes are unevenly distributed; mixed again they are not.
            mixed = (anchor[sent] * _Q) >> np.uint64(33)
            bucket = (mixed % np.uint64(buckets)).astype(np.int32)
            by_bucket = np.argsort(bucket, kind="stable")
            edges = groups(bucket[by_bucket])
            packed = []
            for a, b in zip(edges, np.append(edges[1:], len(by_bucket))):
                some = sent[by_bucket[a:b]]
                d = doc[some]
                pieces = pack(ids[d], keys[d], start[some], run[some], place[some], [whole[i] for i in some.tolist()])
                packed.append((int(bucket[by_bucket[a]]), pieces))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _ in done + packed], pa.int32()),
                    pa.array([x for _, x in done] + [None] * len(packed), pa.binary()),
                    pa.array([None] * len(done) + [x for _, x in packed], pa.binary()),
                ],
                names=["bucket", "spans", "pieces"],
            )

    return pieces


class RunIndex:
    """Sorted strings of some pieces (text, offsets, numbers of strings, documents)."""

    def __init__(self, text: bytes, offsets: np.ndarray, runs: np.ndarray, docs: np.ndarray):
        self.piece = np.repeat(np.arange(len(offsets)), runs)
        first = np.cumsum(runs) - runs
        self.inside = np.arange(len(self.piece)) - first[self.piece]
        at = offsets[self.piece] + self.inside
        self.doc = docs[self.piece]
        words = eight_bytes(text + bytes(8))
        keys = [words[at + o].byteswap() for o in range(0, LENGTH - 7, 8)]
        keys.append(words[at + LENGTH - 8].byteswap())
        letters = np.frombuffer(text, np.uint8)
        before = np.where(self.inside > 0, letters[np.maximum(at - 1, 0)], 0)  # Burrows-Wheeler characters
        self.order = np.lexsort((self.doc, before, *keys[::-1]))
        new = np.zeros(len(at), bool)
        if len(at):
            new[0] = True
        for k in keys:
            k = k[self.order]
            new[1:] |= k[1:] != k[:-1]
        letter = before[self.order]
        head = new.copy()
        head[1:] |= letter[1:] != letter[:-1]
        self.run_heads = np.flatnonzero(head)
        self.run_docs = self.doc[self.order][self.run_heads]  # the sampled ends
        self.string_heads = np.flatnonzero(new)

    def matched(self) -> np.ndarray:
        """For each string in the order of the pieces: whether a smaller document holds it."""
        out = np.zeros(len(self.order), bool)
        if len(self.order):
            first_run = np.searchsorted(self.run_heads, self.string_heads)
            least = np.minimum.reduceat(self.run_docs, first_run)
            sizes = np.diff(np.append(self.string_heads, len(self.order)))
            out[self.order] = np.repeat(least, sizes) < self.doc[self.order]
        return out


def settle_bucket(packs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Ids, keys, starts and ends of the byte spans that one bucket settles."""
    parts = [unpack(p) for p in packs]
    ids, keys, starts, runs, places = (np.concatenate([p[i] for p in parts]) for i in range(5))
    starts, runs = starts.astype(np.int64), runs.astype(np.int64)
    text = b"".join(p[5] for p in parts)
    sizes = runs + LENGTH - 1
    offsets = np.cumsum(sizes) - sizes
    words = eight_bytes(text)
    at = offsets + places
    anchor = anchor_hash(words[at], words[at + 8])
    order = np.argsort(anchor, kind="stable")
    heads = groups(anchor[order])
    counts = np.diff(np.append(heads, len(order)))
    several = np.minimum.reduceat(ids[order], heads) < np.maximum.reduceat(ids[order], heads)
    chosen = order[np.repeat(several, counts)]
    if not len(chosen):
        return (np.zeros(0, np.int64),) * 4
    digest = np.array([xxhash.xxh64_intdigest(text[o : o + s]) for o, s in zip(offsets[chosen].tolist(), sizes[chosen].tolist())], np.uint64)
    by_piece = np.lexsort((ids[chosen], digest))
    chosen, digest = chosen[by_piece], digest[by_piece]
    heads = groups(digest)
    counts = np.diff(np.append(heads, len(chosen)))
    least = np.repeat(ids[chosen[heads]], counts)
    later = ids[chosen] > least
    gone = chosen[later]
    # Different pieces with one anchor: their first documents are compared string by string.
    piece = np.repeat(np.arange(len(heads)), counts)
    first = chosen[heads]
    lone_order = np.argsort(anchor[first], kind="stable")
    lone_heads = groups(anchor[first][lone_order])
    lone_counts = np.diff(np.append(lone_heads, len(first)))
    varied = np.zeros(len(first), bool)
    varied[lone_order] = np.repeat(lone_counts > 1, lone_counts)
    which = np.flatnonzero(varied)
    index = RunIndex(text, offsets[first[which]], runs[first[which]], ids[first[which]])
    hit = index.matched()
    # Runs of matched strings within a piece.
    edge = np.ones(len(hit) + 1, bool)
    if len(hit):
        edge[1:-1] = (hit[1:] != hit[:-1]) | (index.piece[1:] != index.piece[:-1])
    bounds = np.flatnonzero(edge)
    begin, end = bounds[:-1], bounds[1:]
    begin, end = begin[hit[begin]], end[hit[begin]]
    owner = which[index.piece[begin]]  # number of the distinct piece
    a, b = index.inside[begin], index.inside[end - 1] + LENGTH
    # All places of the piece in its first document share the verdict.
    stay = np.flatnonzero(~later)
    low, high = np.searchsorted(piece[stay], owner, "left"), np.searchsorted(piece[stay], owner, "right")
    times = high - low
    place = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
    held = chosen[stay[place]]
    return (
        np.concatenate([ids[gone], ids[held]]),
        np.concatenate([keys[gone], keys[held]]),
        np.concatenate([starts[gone], starts[held] + np.repeat(a, times)]),
        np.concatenate([starts[gone] + sizes[gone], starts[held] + np.repeat(b, times)]),
    )


def settler(parts: int):
    """Rows of ``PIECES``, sorted by bucket, to rows of ``MARKS``; one bucket is held at a time."""

    def out(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        packed = pack_spans(*(np.concatenate(x) for x in zip(*found)), parts)
        return pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in packed], pa.int32()), pa.array([x for _, x in packed], pa.binary())], names=["part", "spans"]
        )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: list[bytes] = []
        bucket, n = None, 0
        found: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            ready = batch.filter(batch.column("pieces").is_null())
            if len(ready):
                yield pa.RecordBatch.from_arrays([ready.column("bucket"), ready.column("spans")], names=["part", "spans"])
            for number, packed in zip(batch.column("bucket").to_pylist(), batch.column("pieces")):
                if not packed.is_valid:
                    continue
                if number != bucket and packs:
                    found.append(settle_bucket(packs))
                    n += len(found[-1][0])
                    packs = []
                    if n > FLUSH:
                        yield out(found)
                        found, n = [], 0
                bucket = number
                packs.append(packed.as_buffer().to_pybytes())
        if packs:
            found.append(settle_bucket(packs))
        if found:
            yield out(found)

    return settle


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``MARKS``, sorted by part, to rows of ``SPANS``; one part is held at a time."""
    part, held = None, []
    for batch in batches:
        for number, packed in zip(batch.column("part").to_pylist(), batch.column("spans")):
            if number != part and held:
                yield spans_by_doc(*(np.concatenate(x) for x in zip(*held)))
                held = []
            part = number
            held.append(unpack_spans(packed.as_buffer().to_pybytes()))
    if held:
        yield spans_by_doc(*(np.concatenate(x) for x in zip(*held)))


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by half-open spans."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return starts[heads], reach[np.append(heads[1:], len(starts)) - 1]


@F.arrow_udf(RESULT)
def without_spans(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    from pyspark.sql.pandas.types import to_arrow_type

    for texts, starts, ends in batches:
        rows = []
        for t, s, e in zip(texts, starts, ends):
            data = t.as_buffer().to_pybytes() if t.is_valid else b""
            a = b = np.zeros(0, np.int64)
            if s.is_valid and len(s):
                a, b = union(s.values.to_numpy(), e.values.to_numpy())
            kept = hashlib.sha256()
            at = 0
            for x, y in zip(a.tolist(), b.tolist()):
                kept.update(data[at:x])
                at = y
            kept.update(data[at:])
            rows.append((len(data), int((b - a).sum()), len(a), kept.hexdigest(), a.tolist(), b.tolist()))
        yield pa.array([dict(zip(RESULT.names, r)) for r in rows], to_arrow_type(RESULT))


def with_text_key(rows: DataFrame) -> DataFrame:
    """Add ``doc_key``: 0, or a hash of the text where an id has different texts, to tell their spans apart.

    Such ids are rare, so their table is small; the optimiser broadcasts it by the size of its file.
    """
    texts = rows.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h"))
    several = texts.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low < high")
    several = stored(several.select(F.col("doc_id").alias("_several")), "run-index-several")
    marked = rows.join(several, F.col("doc_id") == F.col("_several"), "left")
    key = F.when(F.col("_several").isNotNull(), F.xxhash64("text")).otherwise(0).cast("long")
    return marked.withColumn("doc_key", key).drop("_several")


def repeated_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends), one row per document row; spans are in bytes."""
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    keyed = with_text_key(rows)
    long_enough = keyed.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    total = long_enough.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, -(-total // BUCKET_BYTES))
    hot = spark.sparkContext.broadcast(hot_anchors(long_enough))
    pieces = long_enough.mapInArrow(cutter(hot, buckets), PIECES)
    marks = pieces.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(settler(buckets), MARKS)
    marks = stored(marks, "run-index-marks")
    by_doc = marks.repartition(partitions, "part").sortWithinPartitions("part").mapInArrow(gather, SPANS)
    by_doc = by_doc.withColumnsRenamed({"doc_id": "_id", "doc_key": "_key"})
    joined = keyed.join(by_doc, (F.col("doc_id") == F.col("_id")) & (F.col("doc_key") == F.col("_key")), "left")
    return joined.select("doc_id", without_spans("text", "starts", "ends").alias("r")).select("doc_id", "r.*")
