"""The operators' queries with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, html_wrapper, importance, language_id, line_crf, mixing, prefix_trie, repeated_phrases, rule_ensemble, sharding,
               shingle_join, token_index, url_filter)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join(_docs(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir))


def op3_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = spark.createDataFrame(url_filter.RULES + [(h, "block") for h in url_filter.BLOCKED], "key string, verdict string")
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), entries)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_docs(spark, sf_dir))


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_index.write_tokens(_docs(spark, sf_dir), token_index.folder_for(spark), tokenizer())
    return token_index.read_digests(manifest)


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.judge(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_docs(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op12_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_phrases.remove_repeats(_docs(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_shingle_join, op2_mixing, op3_html_wrapper, op4_url_filter, op5_sharding, op6_rule_ensemble, op7_token_index, op8_line_crf, op9_decontaminate,
    op10_language_id, op11_prefix_trie, op12_repeated_phrases, op13_importance)}
SQL: dict[str, str] = {
    "op1_shingle_join": shingle_join.SQL, "op2_mixing": mixing.SQL, "op4_url_filter": url_filter.SQL, "op5_sharding": sharding.SQL, "op9_decontaminate": decontaminate.SQL,
    "op11_prefix_trie": prefix_trie.SQL, "op12_repeated_phrases": repeated_phrases.SQL, "op13_importance": importance.SQL}
