"""Labelled texts for the classifiers: a bounded, repeatable sample of the learning rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out


def training_rows(documents: DataFrame, labels: DataFrame, label: str, max_rows: int, per_label: int | None = None) -> DataFrame:
    """(text, label) of at most ``max_rows`` labelled documents that are not held out.

    Labels are taken in the order of a hash of their id, which falls out the same on every run. ``per_label`` bounds each
    of the two labels by itself. The chosen ids are few by this bound, so they are broadcast and the documents are not
    shuffled. An id with several texts is used with one of them, chosen by hash before the shuffle. Equal texts are used once, with
    their smallest label, so copies carry no more weight than one document. Null texts and labels other than 0 and 1 are not used.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).alias("label"))
    hashed = known.distinct().withColumn("_h", F.xxhash64("doc_id", F.lit(7)))
    if per_label is None:
        chosen = hashed.orderBy("_h", "doc_id", "label").limit(max_rows)
    else:
        parts = [hashed.where(F.col("label") == v).orderBy("_h", "doc_id").limit(per_label) for v in (0, 1)]
        chosen = parts[0].unionByName(parts[1])
    texts = documents.select("doc_id", "text").where("text is not null")
    named = texts.join(F.broadcast(chosen.drop("_h")), "doc_id")
    one = named.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    return one.groupBy("text").agg(F.min("label").alias("label"))
