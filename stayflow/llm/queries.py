"""The registered queries of the text operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table
from .decontaminate import decontaminate, is_contaminated
from .hilbert import shard_rows
from .license_join import scan_licenses
from .minhash import near_duplicates
from .mixing import mix
from .quality_knn import classify_quality
from .quality_rules import judge
from .revisit import archive_of, resolve_revisits
from .run_index import repeated_spans
from .spelling import runs_of_letters, spelling_variants, vocabulary, with_slips
from .token_counts import over_limit, with_token_counts
from .toxicity import classify_toxicity
from .whitening import whiten

QUALITY_CUT = 0.3
TOKEN_LIMIT = 512


def predicted(score: str, cut: float) -> Column:
    return (F.col(score) >= cut).cast("int").alias("predicted")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["item_ids"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(c["item_ids"]), ","), 256).alias("items_sha256"),
        is_contaminated(c).alias("contaminated"),
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents")).select("doc_id", "quality.*")


def op4_run_index_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans(table(spark, folder, "documents")).drop("starts", "ends")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = classify_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), into="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted("score", 0.5))


def op6_minhash_bbit(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op7_quality_knn(spark: SparkSession, folder: str) -> DataFrame:
    scored = classify_quality(table(spark, folder, "documents"), table(spark, folder, "labels"), into="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted("score", QUALITY_CUT))


def op8_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_rows(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve_index"
    )


def op9_license_join(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op10_revisit_resolution(spark: SparkSession, folder: str) -> DataFrame:
    resolved = resolve_revisits(archive_of(table(spark, folder, "pages")))
    line = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit("="), h["value"])), ";")
    at = F.col("at").alias("captured_at")
    return resolved.select("record_id", "url_key", at, "kind", "status", "source_id", "source_at", line.alias("headers"))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = with_token_counts(table(spark, folder, "documents"), tokenizer_path(), into="n_tokens")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return counted.select("doc_id", n_bytes, "n_tokens", over_limit(F.col("n_tokens"), TOKEN_LIMIT).alias("over_limit"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    runs = runs_of_letters(table(spark, folder, "documents"))
    words = vocabulary(runs.select(with_slips(F.col("doc_id"), F.col("run")).alias("word")))
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows, fitted, off = whiten(table(spark, folder, "embeddings"), into="_whitening")
    w = F.col("_whitening")
    values = rows.select("vec_id", w["deviation"].alias("deviation"), F.posexplode(w["whitened"]).alias("place", "whitened"))
    explained = F.array(*map(F.lit, fitted.explained)) if fitted.explained else F.array().cast("array<double>")
    return values.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(off).alias("identity_error"),
    )


LLM_QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality_rules": op3_quality_rules,
    "op4_run_index_dedup": op4_run_index_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_bbit": op6_minhash_bbit,
    "op7_quality_knn": op7_quality_knn,
    "op8_hilbert_shards": op8_hilbert_shards,
    "op9_license_join": op9_license_join,
    "op10_revisit_resolution": op10_revisit_resolution,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}
