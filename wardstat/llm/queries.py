"""The registered queries of the operators, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm import byte_bpe, decontamination, hard_negatives, html_blocks, line_dedup, minhash, ppm, quality, sharding, simhash, spelling, toxicity, warc
from wardstat.llm.common import held_out, stored, table
from wardstat.llm.oracles import ORACLES
from wardstat.session import scratch_path

__all__ = ["ORACLES", "QUERIES", "VOCABULARY", "toxicity_index"]

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def toxicity_index(spark: SparkSession, sf_dir: str) -> toxicity.Index:
    """Fitted on the labels outside the held-out fourth."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2)).select("doc_id", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.fit(docs, labels)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    rows = warc.with_kind(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    index = stored(warc.write_archives(rows, folder), "warc-index")
    return warc.read_records(index, folder, with_payload=False).select(
        F.col("name").cast("long").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").cast("long").alias("refers_to"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.topology(40)
    placed = sharding.assign(table(spark, sf_dir, "documents"), tree, sharding.grown(tree))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", F.col("_dropped").alias("n_dropped"), F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


def op5_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = simhash.with_fingerprint(docs).drop("text")
    return simhash.components(rows, "doc_id").select(
        "doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id")
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_index(spark, sf_dir), threshold=0.3)
    return scored.select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col("_score").alias("score"), F.col("_toxic").cast("int").alias("predicted")
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.where("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))").select(
        F.col("vec_id").alias("id"),
        F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").cast("long").alias("label"),
        F.expr("transform(embedding, x -> floor(256 * cast(x as double)))").alias("vector"),
    )
    return hard_negatives.mine(rows, F.col("id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), least_count=5, factor=5)


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.components(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=5, percent=85)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_sharding": op2_sharding,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_ppm_scoring": op5_ppm_scoring,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontamination": op7_decontamination,
    "op8_html_extraction": op8_html_extraction,
    "op9_toxicity": op9_toxicity,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}
