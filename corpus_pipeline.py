"""A corpus from documents to token shards: quality, near duplicates, benchmark passages, mix, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promolens.llm import decontaminate, mixing, queries, rule_ensemble, shingle_join, token_index
from promolens.session import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rule_ensemble.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_join.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    manifest = token_index.write_tokens(docs, token_index.folder_for(spark), queries.tokenizer())
    return token_index.read_digests(manifest)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", tokens),
]

# The classifier is learnt, which SQL cannot say; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of the corpus; every stage is written and read again."""
    work, docs = Workspace(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = work.keep(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
