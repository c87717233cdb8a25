"""The registered queries of the operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from variantloom.llm import (
    byte_bpe, centroid_clustering, graph_search, line_dedup, mixing, ngram_join, packing, periodic_runs, quality_neighbours,
    quality_rules, sharding, substring_dedup, toxicity_kernel,
)
from variantloom.llm.common import importable, table

SHARDS = 24


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op2_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_neighbours.judged_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_kernel.judged_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(spark, sf_dir)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined_documents(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_documents(table(spark, sf_dir, "documents"), SHARDS)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.digest(table(spark, sf_dir, "embeddings"))


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": _ready(op1_line_dedup),
    "op2_quality_neighbours": _ready(op2_quality_neighbours),
    "op3_substring_dedup": _ready(op3_substring_dedup),
    "op4_packing": _ready(op4_packing),
    "op5_toxicity": _ready(op5_toxicity),
    "op6_graph_search": _ready(op6_graph_search),
    "op7_mixing": _ready(op7_mixing),
    "op8_quality_rules": _ready(op8_quality_rules),
    "op9_ngram_join": _ready(op9_ngram_join),
    "op10_sharding": _ready(op10_sharding),
    "op11_periodic_runs": _ready(op11_periodic_runs),
    "op12_byte_bpe": _ready(op12_byte_bpe),
    "op13_centroid_clustering": _ready(op13_centroid_clustering),
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.SQL,
    "op3_substring_dedup": substring_dedup.SQL,
    "op9_ngram_join": ngram_join.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op13_centroid_clustering": centroid_clustering.SQL,
}
