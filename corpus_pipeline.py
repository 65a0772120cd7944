"""Training corpus pipeline: quality, near duplicates, contamination, mixture, shards.

Each stage takes all documents its predecessor kept, is written as Parquet and read again. All but the last return the columns
of ``documents``; the last one adds where each row goes.

1. quality: texts that the nearest-neighbour classifier scores below 0.3 go. Texts on which no neighbour voted stay: null and
   empty ones, those that resemble nothing, and all if there are no learning rows of both labels.
2. near_dedup: of each component of near duplicates the document with the smallest id stays, in one row; rows without an id go
   if their shingles are those of a row that stays. Texts without a word stay.
3. decontaminate: documents with at least a twentieth of their words in benchmark windows go.
4. mix: every document is repeated as often as the source targets want it, 0 to 3 times.
5. shards: all rows in the order of a Hilbert curve, cut into 8 shards.

Texts pass between the JVM and Python in batches of ``TEXT_BATCH`` rows: the session's default of 10,000 whole texts, or of as many
pairs of them, is what an executor would need most of its memory beside the heap for, once per task and on both sides.

Nulls, empty texts, repeated rows and empty tables are handled as the operators state. ``labels`` and ``benchmark`` are read
from the data folder. The result of ``run`` depends on models, so there is no SQL for it; tests compare the stages with
brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm.common import stored, table
from stayflow.llm.decontaminate import decontaminate, is_contaminated
from stayflow.llm.hilbert import shard_rows
from stayflow.llm.minhash import without_near_duplicates
from stayflow.llm.mixing import mixed_documents
from stayflow.llm.quality_knn import classify_quality
from stayflow.llm.queries import QUALITY_CUT

#: Twice ``quality_knn.BLOCK``, so that a batch is cut into whole blocks.
TEXT_BATCH = 1024
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with the session's Arrow batches bounded; the setting stays, since the result is computed later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = classify_quality(docs, table(spark, sf_dir, "labels"), into="_quality_score", vote=True)
    low = F.coalesce(F.col("_quality_score") < QUALITY_CUT, F.lit(False))
    return scored.where(~low).select(*docs.columns)


@in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


@in_small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), into="_contamination")
    return found.where(~is_contaminated(F.col("_contamination"))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = shard_rows(docs, carry=docs.columns)
    carried = [F.col("carried")[c].alias(c) for c in docs.columns if c not in PLACES]
    return placed.select(*carried, *PLACES)


#: Columns of the last stage; they replace columns of the same name.
PLACES = ["size", "text_crc32", "law", "shard", "slot", "curve_index"]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("shards", shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
