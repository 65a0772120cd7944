"""MinHash near-duplicate detection with b-bit signatures.

A document is the set of its 5-word shingles (A-Z lower-cased, words between white space). Documents are linked if
100 * intersection >= 85 * union, and linked documents form components.

1. One pass over the texts: 384 minima per set, cut into 48 bands of 8, and the two low bits of every minimum packed into a
   signature of 96 bytes. At similarity 0.85 a pair shares no band with probability 2e-7. Equal sets collapse to one
   representative by a digest of the whole set.
   A second signature holds the parity of the number of shingles that hash to each of 2048 bits: where two of them differ, the
   sets differ, so its bit count bounds the difference of the sets from below, without any error.
2. Stars: in each band bucket every member is paired with one hub only, the smallest member. Pairs are estimated by bit counts
   of the signatures, corrected for lanes that agree by chance, and discarded 5 deviations below the threshold, or if the
   parities prove that the sets differ too much. What remains is confirmed on the full shingle sets. The links give first
   components. In ``STAR_ROUNDS`` - 1 further rounds buckets that still hold several components get other hubs; where there are
   none, the search ends.
3. Rest: buckets that still hold several components are searched in full for pairs across components; pairs inside a
   component cannot change anything. Estimate, confirmation and components follow as before. So a bucket of very many near
   copies costs a few pairs per member, and no link between different components is lost.

All groupings are combined before their shuffle and all joins can be split by adaptive execution; no bucket meets in one task
or on the driver. Intermediate tables are written to the shared folder.

Defined results: null and empty texts have no shingles, are linked with nothing and are kept; a text with fewer than five words
is one shingle. Rows without a doc_id are linked with nothing and are kept. Rows with words that repeat a doc_id share its
component; if their texts differ, the id stands for all of them. Other columns are not used.

``without_near_duplicates`` leaves one row of each component: of rows that repeat the kept doc_id the one with the smallest hash
stays. A row without a doc_id goes if a row with one, or another row without one that stays, has the same shingles. Rows
without shingles all stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER_BYTES, stored
from .components import components

SHINGLE = 5
BANDS, ROWS = 48, 8
HASHES = BANDS * ROWS
LOW_BITS = 2
PARITY_BITS = 2048
STAR_ROUNDS = 3
LINK_PERCENT = 85
# Agreeing lanes expected at similarity s: HASHES * (1/4 + 3/4 s). Pairs below the count for s = 0.74 are discarded.
LEAST_LANES = int(HASHES * (0.25 + 0.75 * 0.74))
_FACTORS = np.random.default_rng(1).integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = np.random.default_rng(2).integers(0, 1 << 32, HASHES, dtype=np.uint32)
_BAND_FACTORS = np.random.default_rng(3).integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_NUMBERS = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20

SKETCH = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("signature", T.ArrayType(T.LongType())),
        T.StructField("parity", T.ArrayType(T.LongType())),
    ]
)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def words_in(data: bytes | None) -> list[bytes]:
    return data.translate(LOWER_BYTES).split() if data else []


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted; a short text is one shingle."""
    size = min(SHINGLE, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - size + 1 + i]
    return np.unique(mixed(total))


def minima(hashes: np.ndarray) -> np.ndarray:
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty(HASHES, np.uint32)
    step = max(1, _BLOCK // len(x))
    for at in range(0, HASHES, step):
        out[at : at + step] = (_FACTORS[at : at + step, None] * x + _SHIFTS[at : at + step, None]).min(axis=1)
    return out


def sketch(data: bytes | None) -> tuple[int, bytes | None, np.ndarray, np.ndarray, np.ndarray]:
    hashes = shingle_hashes(words_in(data))
    if not len(hashes):
        none = np.zeros(0, np.int64)
        return 0, None, none, none, none
    least = minima(hashes)
    bands = mixed((least.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_NUMBERS)
    low = least & np.uint32((1 << LOW_BITS) - 1)
    bits = np.stack([low & 1, low >> 1], axis=1).astype(np.uint8).ravel()
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    odd = np.bincount((hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    parity = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return len(hashes), digest, bands.view(np.int64), np.packbits(bits).view(np.int64), parity


@F.arrow_udf(SKETCH)
def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = [sketch(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch]
        n, key, bands, signature, parity = zip(*rows) if rows else ((), (), (), (), ())
        lists = lambda parts: pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32()),
            pa.array(np.concatenate([np.zeros(0, np.int64), *parts])),
        )
        yield pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(key, pa.binary()), lists(bands), lists(signature), lists(parity)],
            names=SKETCH.names,
        )


def shingle_set(data: bytes) -> set:
    words = words_in(data)
    return set(zip(*(words[i:] for i in range(min(SHINGLE, len(words)))))) if words else set()


@F.arrow_udf(T.BooleanType())
def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Whether two texts reach the similarity, on their full shingle sets."""
    last: tuple[bytes, set] = (b"", set())
    for left, right in batches:
        out = []
        for a, b in zip(left, right):
            a, b = a.as_buffer().to_pybytes(), b.as_buffer().to_pybytes()
            if a != last[0]:
                last = (a, shingle_set(a))
            other = shingle_set(b)
            both = len(last[1] & other)
            out.append(100 * both >= LINK_PERCENT * (len(last[1]) + len(other) - both) and both > 0)
        yield pa.array(out, pa.bool_())


def agreeing_lanes(a: Column, b: Column) -> Column:
    """Minima whose low bits agree."""
    odd = F.lit(0x5555555555555555)
    differing = F.lit(0)
    for i in range(HASHES * LOW_BITS // 64):
        z = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        differing = differing + F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(odd))
    return HASHES - differing


def estimated_similarity(a: Column, b: Column) -> Column:
    """Estimate corrected for the quarter of lanes that agree by chance."""
    return (agreeing_lanes(a, b) / HASHES - 0.25) / 0.75


def least_difference(a: Column, b: Column) -> Column:
    """Bits in which two parities differ: the sets differ in at least as many shingles."""
    differing = F.lit(0)
    for i in range(PARITY_BITS // 64):
        differing = differing + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return differing


def may_link(a: Column, b: Column) -> Column:
    """Sizes, parities and signatures (structs with n_shingles, signature, parity) allow a link.

    With difference d and sum of sizes s the similarity is (s - d) / (s + d).
    """
    small, large = F.least(a["n_shingles"], b["n_shingles"]), F.greatest(a["n_shingles"], b["n_shingles"])
    apart = least_difference(a["parity"], b["parity"])
    near = (100 + LINK_PERCENT) * apart <= (100 - LINK_PERCENT) * (small + large)
    return (100 * small >= LINK_PERCENT * large) & near & (agreeing_lanes(a["signature"], b["signature"]) >= LEAST_LANES)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The stored pairs (a, b) whose texts (id, text) are linked."""
    if pairs.isEmpty():
        return pairs
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = stored(texts.join(ids, "id", "left_semi"), "minhash-texts")
    left = needed.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = needed.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a")
    return stored(both.where(linked("text_a", "text_b")).select("a", "b").distinct(), "minhash-links")


@F.arrow_udf(T.BinaryType())
def set_key_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The digest of the shingle set, as in ``sketch``; null without shingles."""
    for batch in batches:
        sets = [shingle_hashes(words_in(t.as_buffer().to_pybytes() if t.is_valid else None)) for t in batch]
        keys = [hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None for h in sets]
        yield pa.array(keys, pa.binary())


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document row."""
    return marked(documents, doc_id, text).drop("set_key")


def marked(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``near_duplicates`` with the digest of the shingle set in ``set_key``."""
    body = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    marks = body.select("doc_id", sketched("text").alias("s")).select("doc_id", "s.*")
    sketches = stored(marks, "minhash-sketches")
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    first = full.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "signature", "parity")).alias("f"))
    firsts = stored(first.select("set_key", "f.*"), "minhash-representatives")
    info = firsts.select("doc_id", F.struct("n_shingles", "signature", "parity").alias("s"))
    texts = body.where("doc_id is not null and text is not null").select(F.col("doc_id").alias("id"), "text")
    entries = firsts.select(F.explode("bands").alias("k"), F.col("doc_id").alias("d"))

    # An id with several texts stands for all of them: it links the representatives of their sets.
    several = full.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).where("low < high")
    firsts_of = firsts.select("set_key", F.col("doc_id").alias("b"))
    of_id = full.join(several.select("doc_id"), "doc_id", "left_semi").join(firsts_of, "set_key")
    of_id = stored(of_id.select(F.col("doc_id").alias("a"), "b").where("a <> b").distinct(), "minhash-ids")

    found, tried = (None if of_id.isEmpty() else components(of_id)), None
    for turn in range(STAR_ROUNDS):
        named = with_components(entries, found)
        # The smallest member first; later another one by hash.
        rank = F.struct(F.xxhash64("d", F.lit(turn)) if turn else F.lit(0).cast("long"), "d", "c")
        hubs = named.groupBy("k").agg(F.min(rank).alias("hub"), F.min("c").alias("low"), F.max("c").alias("high"))
        hubs = hubs.where("low < high").select("k", F.col("hub.d").alias("hub"), F.col("hub.c").alias("hub_c"))
        # A bucket that holds one component stays so: later rounds read the members of the others only.
        members = stored(named.join(hubs, "k"), "minhash-open")
        if members.isEmpty():
            break
        entries = members.select("k", "d")
        stars = members.where("c <> hub_c")
        stars = stars.select(F.least("hub", "d").alias("a"), F.greatest("hub", "d").alias("b")).distinct()
        pairs = estimated_pairs(stars if tried is None else stars.join(tried, ["a", "b"], "left_anti"), info)
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = merged(found, confirmed(pairs, texts))
    else:
        named = with_components(entries, found)
        open_buckets = named.groupBy("k").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("k")
        members = named.join(open_buckets, "k", "left_semi").join(info, F.col("d") == F.col("doc_id")).select("k", "c", "d", "s")
        members = stored(members, "minhash-open")
        x, y = members.alias("x"), members.alias("y")
        across = x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.c") < F.col("y.c")) & may_link(F.col("x.s"), F.col("y.s")))
        across = across.select(F.least("x.d", "y.d").alias("a"), F.greatest("x.d", "y.d").alias("b")).distinct()
        more = confirmed(stored(across.join(tried, ["a", "b"], "left_anti"), "minhash-across"), texts)
        found = merged(found, more)

    groups = firsts.select("set_key", F.col("doc_id").alias("first"))
    if found is None:
        groups = groups.withColumn("component", F.col("first"))
    else:
        groups = groups.join(found, F.col("first") == F.col("node"), "left")
        groups = groups.withColumn("component", F.coalesce("component", "first"))
    groups = groups.select("set_key", "component")
    named_rows = sketches.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    rows = named_rows.select("doc_id", "n_shingles", "set_key", component.alias("component_id"))
    return rows.withColumn("kept", kept)


def merged(found: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Components (node, component) after further links (a, b); the old ones enter as one link per node."""
    if links.isEmpty():
        return found
    if found is None:
        return components(links)
    old = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(old.unionByName(links))


def with_components(entries: DataFrame, found: DataFrame | None) -> DataFrame:
    """Band entries (k, d) with the component c of the document."""
    if found is None:
        return entries.withColumn("c", F.col("d"))
    named = entries.join(found, F.col("d") == F.col("node"), "left")
    return named.select("k", "d", F.coalesce("component", "d").alias("c"))


def estimated_pairs(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sizes and signatures allow."""
    left = info.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    right = info.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(right, "b").join(left, "a").where(may_link(F.col("sa"), F.col("sb")))
    return stored(both.select("a", "b").distinct(), "minhash-pairs")


def without_near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay: one row of each component, with its own columns."""
    marks = stored(marked(documents, doc_id, text).where("set_key is not null"), "minhash-marks")
    named, nameless = marks.where("doc_id is not null"), marks.where("doc_id is null")
    gone = stored(named.where("not kept").select(F.col("doc_id").alias("_near_id")).distinct(), "minhash-gone")
    repeated = named.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("_near_id")), "minhash-repeated")
    sets = nameless.select("set_key").distinct()
    taken = named.join(sets, "set_key", "left_semi").select(F.col("set_key").alias("_near_set")).distinct()

    # As in ``words_in``: anything but white space is a word.
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    has_id = F.col(doc_id).isNotNull()
    same_id = F.col(doc_id) == F.col("_near_id")
    stay = documents.where(worded & has_id).join(gone, same_id, "left_anti")
    parts = [documents.where(~worded), stay.join(repeated, same_id, "left_anti")]
    if not repeated.isEmpty():
        parts.append(one_row(stay.join(repeated, same_id, "left_semi").withColumn("_near_key", F.col(doc_id)), documents.columns))
    if not sets.isEmpty():
        rest = documents.where(worded & ~has_id).withColumn("_near_set", set_key_of(F.col(text).cast("binary")))
        rest = rest.join(stored(taken, "minhash-taken"), "_near_set", "left_anti")
        parts.append(one_row(rest.withColumnRenamed("_near_set", "_near_key"), documents.columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def one_row(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per ``_near_key`` the row with the smallest hash, combined before the shuffle."""
    row = F.struct(*columns)
    by = F.struct(F.xxhash64(F.to_json(row)), F.to_json(row))
    return rows.groupBy("_near_key").agg(F.min_by(row, by).alias("_near_row")).select("_near_row.*")
