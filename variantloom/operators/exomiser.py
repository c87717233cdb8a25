"""Phenotype-ranked variant reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.functions.keys import mutation_id, ranked_report_contig, variant_uid


def flatten_report(report: DataFrame) -> DataFrame:
    """One row per ranked variant; genes without variants have none."""
    exploded = report.select(
        "geneSymbol", F.col("geneIdentifier.geneId").alias("geneId"), "combinedScore",
        F.size("variantEvaluations").alias("variantQty"),
        F.size("variantEvaluations.compatibleInheritanceModes").alias("qtyOfInheritance"),
        F.explode("variantEvaluations").alias("variant"),
    )
    return exploded.select(
        "geneSymbol", "geneId", F.round(F.col("combinedScore").cast("float"), 5).alias("combinedScore"), "variantQty",
        F.col("variant.chromosome").alias("chrom"), F.col("variant.ref").alias("ref"),
        F.col("variant.alt").alias("alt"), F.col("variant.position").alias("position"),
        F.col("variant.compatibleInheritanceModes").alias("inheritance"), "qtyOfInheritance",
    )


def score_rows(flat: DataFrame, build: str, specimen: Column, updated: Column) -> DataFrame:
    """Keyed score rows ready for the merge."""
    contig_name = ranked_report_contig(F.col("chrom"))
    mutation = mutation_id(contig_name, F.col("position"), F.col("ref"), F.col("alt"))
    return flat.select(
        variant_uid(mutation, build).alias("uid"), mutation.alias("mutation_id"), specimen.alias("specimen"),
        contig_name.alias("chrom"), "position", "ref", "alt", F.col("inheritance").alias("transmission"),
        F.col("combinedScore").alias("exomiser_score"), updated.alias("last_update"),
    )


def report_counts(flat: DataFrame) -> DataFrame:
    return flat.agg(F.count(F.lit(1)).alias("rows"), F.sum("qtyOfInheritance").alias("inheritance_lists"))


def specimen_id(name: Column) -> Column:
    """Sample names carry the prefix SP."""
    return F.when(name.startswith("SP"), name).otherwise(F.concat(F.lit("SP"), name))
