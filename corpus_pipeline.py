"""A corpus pipeline of training-data operators: documents in, packed sequences out."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from variantloom.llm import line_dedup, mixing, ngram_join, packing, quality_neighbours
from variantloom.llm.common import clear, importable, stage, table, work_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the nearest-neighbour classifier does not reject."""
    scored = quality_neighbours.score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.filter(scored["score"] >= quality_neighbours.THRESHOLD).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand on many sites, except where each stands first."""
    return line_dedup.without_boilerplate(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similar texts connect: the one with the smallest id."""
    return ngram_join.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.packed_documents(docs)


def _ready(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, with its Python tasks set up; stages may be run one by one."""
    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return step(spark, docs, sf_dir)

    return run_step


STAGES = [(step.__name__, _ready(step)) for step in (quality, lines, near_duplicates, mix, pack)]

#: The classifier, the mix and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each on the written result of the one before, which then goes."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        folder = work_folder(spark, f"pipeline-{name}")
        docs = stage(step(spark, docs, sf_dir), name, folder)
        if before:
            clear(spark, before)
        before = folder
    return docs
