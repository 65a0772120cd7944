"""Mixing sources to target weights with hash-threshold histograms, in DataFrame operations only.

Every source gets a target (``source_targets``). Whole copies of all its documents come first; the rest of the target
is a budget for one more copy of some of them. Documents are ordered by a hash of their id and text, without sorting: words are
summed per source and hash bucket, a running total over the buckets finds the bucket in which the budget ends, and
only that boundary bucket is summed again by the next hash bits. Six levels of ten bits leave one document or its exact
repetitions; as many of these are taken as bring the source nearest to its target. A document is taken once more exactly
if its hash is below the threshold of its source, or at it and among the first repetitions. Repetitions are numbered
file by file of a written table: which of them is taken makes no difference.

Sums are combined before each shuffle, so a source with a third of all rows costs at most 1,024 rows per task. The
thresholds have one row per source and are written as a table; the optimiser broadcasts them if their file is small
and else joins by sorting, where a large source can be split.

Defined results: a null source is a source of its own and comes last; a null or empty text has size 0; sources
without words have target 0. Rows without an id or with the id of another row are told apart by their texts, and equal rows are
taken one by one. Empty documents cost nothing: they come as often as others of their source, never more than
``max_repeats`` times. An empty table gives an empty result. Columns other than the id, the text and the source pass through untouched; the new columns replace
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEVELS, LEVEL_BITS = 6, 10
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_bits(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of id and text: the same on every run and in every engine."""
    whole = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, LEVELS * LEVEL_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS, share: float = 1.0
) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Targets share ``share`` of all words by weight; weights repeat along the sources in code point order, null last.
    No target exceeds ``max_repeats`` times its source: filling sources in the order in which they reach that limit
    gives the level at which the remaining ones share the rest. The windows run over one row per source.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.withColumn("_n", F.row_number().over(in_order) - 1)
        .withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * float(max_repeats))
        .withColumn("_total", F.sum("source_size").over(everything) * float(share))
    )
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after)
    filled = ranked.withColumn("_level", level).withColumn("_fits", F.col("_level") * F.col("_w") <= F.col("_cap"))
    # The first source that stays below its limit fixes the level of all later ones.
    first = F.min(F.when(F.col("_fits"), F.struct((F.col("_cap") / F.col("_w")).alias("r"), "_n", "_level")))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_first._level"), F.lit(float("inf"))) * F.col("_w"))
    return filled.withColumn("_first", first.over(everything)).select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, whole, cut, extra): copies that every document gets, the hash below which it gets one more, and how many of
    the rows with just that hash get one more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.select(
        "source",
        "target",
        "source_size",
        whole.cast("int").alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("prefix"),
    )
    for level in range(1, LEVELS + 1):
        bits = LEVEL_BITS * (LEVELS - level)
        state = stored(state, f"mix-level-{level}")
        t = state.select(F.col("source").alias("_s"), "prefix", "rest")
        inside = F.shiftright("h", bits + LEVEL_BITS) == F.col("prefix")
        sums = (
            sized.join(t, sized["source"].eqNullSafe(t["_s"]) & inside)
            .groupBy("source", "prefix", "rest", F.shiftright("h", bits).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        )
        ordered = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        running = sums.withColumn("upto", F.sum("words").over(ordered))
        # The boundary bucket is the first whose running total exceeds the budget.
        edge = running.where(F.col("upto") > F.col("rest")).groupBy("source").agg(
            F.min(F.struct("bucket", "upto", "words", "rows")).alias("edge")
        )
        e = edge.select(F.col("source").alias("_s"), "edge")
        past = F.lit((1 << (LEVEL_BITS * level)) - 1).cast("long")
        state = (
            state.join(e, state["source"].eqNullSafe(e["_s"]), "left")
            .withColumn("_open", F.col("edge").isNotNull())
            .select(
                "source",
                "target",
                "source_size",
                "whole",
                F.when(F.col("_open"), F.col("rest") - (F.col("edge.upto") - F.col("edge.words")))
                .otherwise(0.0)
                .alias("rest"),
                F.when(F.col("_open"), F.col("edge.bucket")).otherwise(past).alias("prefix"),
                F.when(F.col("_open"), F.col("edge.words") / F.col("edge.rows")).alias("each"),
                F.coalesce("edge.rows", F.lit(0)).alias("rows"),
            )
        )
        if level < LEVELS:
            state = state.drop("each", "rows")
    # Of the rows at the edge, all of one size: those that fit, and one more if that is nearer.
    fit = F.floor(F.col("rest") / F.col("each"))
    extra = F.coalesce(fit + (2 * (F.col("rest") - fit * F.col("each")) >= F.col("each")).cast("long"), F.lit(1))
    all_taken = extra >= F.col("rows")
    return stored(
        state.select(
            "source",
            "target",
            "source_size",
            "whole",
            (F.col("prefix") + all_taken.cast("int")).alias("cut"),
            F.when(all_taken, F.lit(0)).otherwise(extra).cast("long").alias("extra"),
        ),
        "mix-thresholds",
    )


def cuts_of(documents: DataFrame, doc_id: str, text: str, source: str, weights, max_repeats: int):
    """The stored sizes of all documents, and the thresholds of their sources."""
    measured = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        hash_bits(F.col(doc_id), F.col(text)).alias("h"),
    )
    sized = stored(measured, "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = thresholds(sized, source_targets(sizes, weights, max_repeats)).withColumnRenamed("source", "_s")
    return sized, cuts


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """Number the rows of a written table from 1 per ``key``, file by file: no task gets more than one file's rows of a key."""
    place = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = place.groupBy(key, "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(F.col(key).alias("_k"), F.col("_file").alias("_f"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(key, "_file").orderBy("_row"))
    joined = place.withColumn("_number", inside).join(starts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_file") == F.col("_f")))
    return joined.withColumn("_number", F.col("_start") + F.col("_number")).drop("_k", "_f", "_start", "_file", "_row")


def copies_below(hashed: str, max_repeats: int) -> Column:
    return F.least(F.col("whole") + (F.col(hashed) < F.col("cut")).cast("int"), F.lit(max_repeats))


def copies_at_edge(max_repeats: int) -> Column:
    return F.least(F.col("whole") + (F.col("_number") <= F.col("extra")).cast("int"), F.lit(max_repeats))


def mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken), one row per row of ``documents``."""
    sized, cuts = cuts_of(documents, doc_id, text, source, weights, max_repeats)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    joined = sized.join(cuts, sized["source"].eqNullSafe(cuts["_s"]))
    at_edge = (F.col("h") == F.col("cut")) & (F.col("extra") > 0)
    counted = joined.where(~at_edge).withColumn("copies", copies_below("h", max_repeats))
    if cuts.where("extra > 0").head(1):
        edge = numbered(stored(joined.where(at_edge), "mix-edge"), "source")
        counted = counted.unionByName(edge.withColumn("copies", copies_at_edge(max_repeats)).drop("_number"))
    return counted.select("doc_id", "size", "source", "source_size", "target", "copies", taken)


def mixed_documents(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Every document as often as the mix takes it, with its own columns; the texts are not shuffled."""
    _, cuts = cuts_of(documents, doc_id, text, source, weights, max_repeats)
    rows = documents.select(F.struct("*").alias("_row"), F.col(source).alias("_source"), hash_bits(F.col(doc_id), F.col(text)).alias("_h"))
    joined = rows.join(cuts.select("_s", "whole", "cut", "extra"), F.col("_source").eqNullSafe(F.col("_s")))
    at_edge = (F.col("_h") == F.col("cut")) & (F.col("extra") > 0)
    counted = joined.where(~at_edge).select("_row", copies_below("_h", max_repeats).alias("_copies"))
    if cuts.where("extra > 0").head(1):
        edge = stored(joined.where(at_edge).select(F.col("_row").alias("_document"), "_source", "whole", "extra"), "mix-edge")
        again = numbered(edge, "_source").select(F.col("_document").alias("_row"), copies_at_edge(max_repeats).alias("_copies"))
        counted = counted.unionByName(again)
    again = counted.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return again.select(*[F.col("_row").getField(c).alias(c) for c in documents.columns])
