"""A corpus through five operators: each stage is written and read again before the next.

Each stage works on all rows that the one before kept.  The first four return the columns
of ``documents``; the last returns the packed pieces.

Odd rows, in every stage: a null text counts as empty, null and repeated ids are rows of their own, columns whose names
clash with an operator's keep their values, an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm import decontaminate, packing, simhash, substring, toxicity
from txnscope.llm.queries import vocabulary
from txnscope.plans.frames import materialize


READ = ("doc_id", "text")  # what the operators read


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with its other columns under names that no operator adds."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in READ else f"__{c}") for c in docs.columns])


def _back(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(c if c in READ else f"`__{c}`").alias(c) for c in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on labelled documents outside the held-out fold, does not call toxic."""
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _back(toxicity.score_toxicity(_apart(docs), model).where("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group that SimHash links join: 4-word shingles, 4 bits."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that also start earlier; no document goes."""
    return _back(substring.remove_repeated(_apart(docs), window=20), docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _back(decontaminate.find_benchmark(_apart(docs), items).where("NOT contaminated"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]
# no stage but the first few joins can be put in SQL; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
