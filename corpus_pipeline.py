"""From raw documents to packed training sequences, in stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. Its rows are written and read again as the next stage's documents.
"""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimwright.llm import decontamination, packing, secret_scan, simhash, toxicity
from claimwright.session import shared_folder

SHINGLE, RADIUS = 4, 4


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, SHINGLE, RADIUS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the benchmark's passages cut out."""
    return decontamination.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secret_scan.without_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the training sequences."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return packing.pack_documents(docs, file.read())


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: The classifier and the tokenizer cannot be written in SQL; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the rows of the last."""
    folder = f"{shared_folder(spark)}/claimwright/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
