"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license templates.

Blocks are the lines of a text, as sets of words. A block is a find for a template if it holds at least ``THRESHOLD`` of
the template's distinct words. The join is exact and uses three filters over one global order of words, rare ones first
(counted over all documents): a block must hold a word of the template's prefix (its rarest words, one more than may be
missing); it must hold enough template words at all (length); and from the position of the first common word on enough
words must be left on both sides (position). What passes is counted in full.

With ``wrapped`` every run of as many consecutive words as a template has is a block too, whatever its line breaks. Texts are
cut into overlapping pieces of twice the longest template, so that one piece holds every run; pieces pass the same filters, and
the runs of what is left are counted in full. The registered query and its SQL twin take lines only: there a notice that is
wrapped over two lines is no block.

Texts are read once. A document's lines are kept only if the whole document holds enough words of some template, which
every find needs. Templates are a fixed list of a few short notices, so their words fit into one literal array; their
ordered table is written and broadcast by its file size. A line that a third of all documents share costs one row per
document and template word; nothing is paired within a group.

Everything is DataFrame operations. Defined results: null and empty texts have no words and no labels; every row is scanned by
itself, whether its doc_id is null or repeated: blocks and finds are kept by a hash of the text, and rows of one text share
them. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, stored

THRESHOLD = 0.9
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases of the base scan with their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Short notices by which public licenses are named, with labels.
TEMPLATES = [
    ("Released under the MIT License", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under the GNU General Public License", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike License", "cc-by-sa"),
]


def normal_text(text: Column) -> Column:
    """Lower-cased words joined by one space."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD, " "))


def words_in(normal: Column) -> Column:
    return F.when(normal == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(normal, " "))


def phrase_places(words: Column, phrase: str) -> Column:
    """Start positions (from 0) at which the words of the phrase stand one after the other."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    at = lambda i: F.slice(words, i + 1, len(parts)) == F.array(*[F.lit(p) for p in parts])
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), at)).otherwise(
        F.expr("cast(array() as array<int>)")
    )


def template_rows(documents: DataFrame, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """(tid, label, t_words, token), one row per distinct word of a template; ``t_words`` counts all its words."""
    given = documents.sparkSession.createDataFrame(
        [(i, label, text) for i, (text, label) in enumerate(templates)], "tid int, label string, text string"
    )
    words = given.select("tid", "label", words_in(normal_text(F.col("text"))).alias("w"))
    return words.select("tid", "label", F.size("w").alias("t_words"), F.explode(F.array_distinct("w")).alias("token"))


def needed(n: Column | int, threshold: float) -> Column:
    """Words of a template of ``n`` that a block must hold."""
    return F.ceil(F.round(F.lit(n) * threshold if isinstance(n, int) else n * threshold, 6)).cast("int")


def scan_licenses(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    wrapped: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per document row."""
    given = template_rows(documents, templates)
    sets = [r["tokens"] for r in given.groupBy("tid").agg(F.collect_set("token").alias("tokens")).collect()]
    vocabulary = F.array(*[F.lit(t) for t in sorted(set().union(*sets))])
    normal = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("raw"), normal_text(F.col(text)).alias("t"))
    padded = F.concat(F.lit(" "), F.col("t"), F.lit(" "))
    has_phrase = F.lit(False)
    for phrase, _ in phrases:
        has_phrase = has_phrase | F.contains(padded, F.lit(f" {phrase} "))
    none = F.expr("cast(array() as array<int>)")
    split = normal.withColumn("w", words_in(F.col("t"))).withColumn("phrased", has_phrase)
    found = split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.array(
            *[
                F.when(F.col("phrased"), phrase_places(F.col("w"), phrase)).otherwise(none)
                for phrase, _ in phrases
            ]
        ).alias("places"),
        F.array_intersect("w", vocabulary).alias("known"),
        "raw",
    )
    enough = F.lit(False)
    for s in sets:
        own = F.size(F.array_intersect("known", F.array(*[F.lit(t) for t in sorted(s)])))
        enough = enough | (own >= needed(len(s), threshold))
    scanned = (F.size("known") > 0) & enough
    base = stored(
        found.select(
            "doc_id",
            "n_words",
            "places",
            "known",
            F.when(scanned, F.unhex(F.sha2("raw", 256))).alias("text_key"),
            F.when(scanned, F.split("raw", "\n")).alias("lines"),
        ),
        "license-base",
    )
    labels = template_finds(base, given, threshold, wrapped)
    positions = F.flatten("places")
    names = F.array(*[F.when(F.size(F.get("places", F.lit(i))) > 0, F.lit(l)) for i, (_, l) in enumerate(phrases)])
    base_names = F.array_sort(F.array_distinct(F.array_compact(names)))
    rows = base.drop("lines", "known")
    unscanned = rows.where("text_key is null")
    joined = rows.where("text_key is not null").join(labels, "text_key", "left").unionByName(unscanned, allowMissingColumns=True)
    all_names = F.array_sort(F.array_union(base_names, F.coalesce("found", F.expr("cast(array() as array<string>)"))))
    return joined.select(
        "doc_id",
        "n_words",
        F.size(positions).cast("long").alias("n_base"),
        F.array_min(positions).cast("long").alias("first_word"),
        F.array_max(positions).cast("long").alias("last_word"),
        F.array_join(base_names, ",").alias("base_labels"),
        F.array_join(all_names, ",").alias("labels"),
        F.when(F.size(positions) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def template_finds(base: DataFrame, given: DataFrame, threshold: float = THRESHOLD, wrapped: bool = False) -> DataFrame:
    """(text_key, found, best) of texts with a block that meets a template: the labels and the largest containment."""
    counts = base.select(F.explode("known").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))
    tokens = given.join(counts, "token", "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    # The windows run over the words of the fixed templates.
    rare_first = Window.orderBy("n_docs", "token")
    ordered = (
        tokens.withColumn("rank", F.dense_rank().over(rare_first))
        .withColumn("t_pos", F.row_number().over(Window.partitionBy("tid").orderBy("rank")))
        .withColumn("t_size", F.count(F.lit(1)).over(Window.partitionBy("tid")))
        .withColumn("need", needed(F.col("t_size"), threshold))
    )
    order = stored(ordered.select("tid", "label", "t_words", "token", "rank", "t_pos", "t_size", "need"), "license-order")
    scanned = base.where("lines is not null")
    lines = scanned.select("text_key", F.posexplode("lines").alias("line", "block"))
    blocks = lines.select("text_key", "line", words_in(normal_text(F.col("block"))).alias("w"))
    if wrapped:
        pieces = pieces_of(scanned, given)
        blocks = blocks.unionByName(pieces)
    ranks = order.select("token", "rank").distinct()
    held = (
        blocks.select("text_key", "line", F.explode(F.array_distinct("w")).alias("token"))
        .join(ranks, "token")
        .dropDuplicates(["text_key", "line", "token"])
    )
    block = Window.partitionBy("text_key", "line")
    held = held.withColumn("b_pos", F.row_number().over(block.orderBy("rank"))).withColumn(
        "b_size", F.count(F.lit(1)).over(block)
    )
    in_prefix = F.col("t_pos") <= F.col("t_size") - F.col("need") + 1
    left = F.least(F.col("b_size") - F.col("b_pos"), F.col("t_size") - F.col("t_pos")) + 1
    # The first common word decides: a later one would leave even fewer words.
    candidates = (
        held.join(order.where(in_prefix), "token")
        .where((F.col("b_size") >= F.col("need")) & (left >= F.col("need")))
        .select("text_key", "line", "tid")
        .distinct()
    )
    common = (
        candidates.join(held.select("text_key", "line", "token"), ["text_key", "line"])
        .join(order.select("tid", "token", "label", "t_size", "need"), ["tid", "token"])
        .groupBy("text_key", "line", "tid", "label", "t_size", "need")
        .agg(F.count(F.lit(1)).alias("common"))
        .where("common >= need")
    )
    if wrapped:
        runs = runs_in(common.where("line < 0"), pieces, order)
        common = common.where("line >= 0").unionByName(runs)
    return common.groupBy("text_key").agg(
        F.collect_set("label").alias("found"), F.max(F.col("common") / F.col("t_size")).alias("best")
    )


def pieces_of(scanned: DataFrame, given: DataFrame) -> DataFrame:
    """(text_key, line, w): overlapping pieces of the words of whole texts, numbered -1, -2, ..., that hold every run of words."""
    longest = given.agg(F.coalesce(F.max("t_words"), F.lit(1))).first()[0]
    words = scanned.select("text_key", words_in(normal_text(F.array_join("lines", "\n"))).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(longest))
    cut = words.select("text_key", F.posexplode(F.transform(starts, lambda i: F.slice("all", i + 1, 2 * longest))).alias("i", "w"))
    return cut.select("text_key", (-1 - F.col("i")).alias("line"), "w")


def runs_in(found: DataFrame, pieces: DataFrame, order: DataFrame) -> DataFrame:
    """The rows of ``found`` (pieces that hold enough words) with a run of words that does, and its words in common."""
    sets = order.groupBy("tid", "t_words").agg(F.collect_set("token").alias("tokens"))
    both = found.drop("common").join(pieces.distinct(), ["text_key", "line"]).join(sets, "tid")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.col("t_words") + 1, F.lit(1)))
    held = F.transform(starts, lambda i: F.size(F.array_intersect(F.slice("w", i, F.col("t_words")), F.col("tokens"))))
    return both.withColumn("common", F.array_max(held).cast("long")).where("common >= need").select(*found.columns)
