"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalis.llm.ann import search
from vitalis.llm.common import read
from vitalis.llm.hadamard import cluster, clusters_sql
from vitalis.llm.langid import identify_language
from vitalis.llm.lexical import SEARCH_SQL, lexical_search
from vitalis.llm.line_dedup import line_classes
from vitalis.llm.lm import score_language_model
from vitalis.llm.minhash import near_duplicates
from vitalis.llm.mixing import mix_report
from vitalis.llm.packing import retrieval_pack
from vitalis.llm.quality import isolation_quality
from vitalis.llm.simhash import simhash_components
from vitalis.llm.substring_dedup import PASSAGES_SQL, repeated_passages
from vitalis.llm.toxicity import score_toxicity


def op1_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"))


def op2_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(read(spark, sf_dir, "documents"))


def op3_hierarchical_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read(spark, sf_dir, "documents"))


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))


def op5_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_pack(read(spark, sf_dir, "documents"))


def op6_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language_model(read(spark, sf_dir, "documents"))


def op9_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read(spark, sf_dir, "documents"))


def op11_hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings")).drop("centroid")


def op12_simhash_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op13_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_inverted_multi_index,
        op2_fuzzy_line_dedup,
        op3_hierarchical_langid,
        op4_passage_dedup,
        op5_lexical_packing,
        op6_gru_toxicity,
        op7_isolation_forest,
        op8_backoff_automaton,
        op9_probminhash,
        op10_mix_sources,
        op11_hadamard_clusters,
        op12_simhash_vantage,
        op13_pair_maxscore,
    )
}
ORACLE_SQL: dict[str, str] = {"op4_passage_dedup": PASSAGES_SQL, "op11_hadamard_clusters": clusters_sql(), "op13_pair_maxscore": SEARCH_SQL}
