"""One registered query per corpus operator, over its whole table, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pseudora.llm import (
    chatformat,
    decontamination,
    filteraudit,
    mixing,
    ngramjoin,
    pii,
    prefixtrie,
    quality,
    secrets,
    tokencount,
    topk,
    toxicity,
    urlfilter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: The other queries hash, fit or choose by a seed, which tests compare with brute force.
ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": ngramjoin.ORACLE_SQL,
    "op2_secret_scan": secrets.ORACLE_SQL,
    "op6_decontaminate": decontamination.ORACLE_SQL,
    "op8_exact_top_k": topk.ORACLE_SQL,
    "op11_audit_filters": filteraudit.ORACLE_SQL,
    "op12_prefix_trie": prefixtrie.ORACLE_SQL,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query
def op3_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The given conversations hold no tool parts: derived ones put every step to work.
    return chatformat.format_chat(chatformat.with_tool_parts(table(spark, sf_dir, "conversations")))


@query
def op4_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_find_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


@query
def op11_audit_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.interaction_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
