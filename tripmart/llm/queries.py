"""One query per operator over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    html_text,
    mixing,
    near_dups,
    neighbours,
    packing,
    quality_model,
    quality_rules,
    resampling,
    sharding,
    spelling,
    suffix_dedup,
    token_files,
    warc,
)
from tripmart.llm.oracle import ORACLE as ORACLE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", crc)
    return sharding.assign(docs, 16, keep=["doc_id", "text_crc32"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_model.classify(docs, _table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.cluster(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    found = warc.read(archives, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.without_repeats(docs, keep=["doc_id"])
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate"
    )


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_files.read(files, with_ids=False)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.occurrences(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling.forms(spelling.vocabulary(found)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    drawn = resampling.resample(docs.select("doc_id", "text"), target.select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_html_extraction": op6_html_extraction,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_warc": op8_warc,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_mixing": op10_mixing,
    "op11_token_output": op11_token_output,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_resampling": op13_resampling,
}
