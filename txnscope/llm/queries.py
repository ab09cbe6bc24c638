"""Queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm import ans, codebooks, decontaminate, licenses, minhash, packing, page_text, sharding, simhash, substring, token_counts, toxicity, zones
from txnscope.llm.tables import NO_ID, documents


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _id(column: str = "key"):
    return F.when(F.col(column) != NO_ID, F.col(column))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeated(documents(spark, sf_dir).select("doc_id", "text"), window=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", "spans")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.count_tokens(documents(spark, sf_dir).select("doc_id", "text"), vocabulary("piece_bpe_32k.model"), limit=4096)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_digest(documents(spark, sf_dir), 40)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ans.round_trip_digest(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=2)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, distance=4)
    return out.select(_id().alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), _id("component_id").alias("component_id"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edit_likeness(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_benchmark(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "item_ids", "best_score", "contaminated")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_license_sentences", F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.code_digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = page_text.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.cluster_digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_toxicity, op3_token_counts, op4_sharding, op5_best_fit_packing, op6_token_files,
                                   op7_simhash, op8_fingerprints, op9_decontamination, op10_license_scan, op11_vector_codes, op12_page_text, op13_centroids, pipeline)}
ORACLES = {"op10_license_scan": licenses.oracle_sql(), "op11_vector_codes": codebooks.oracle_sql(), "op13_centroids": zones.oracle_sql()}
