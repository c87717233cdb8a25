"""Cohort and laboratory allele frequencies over long calls (F1, F2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.functions.genotype import alternative_alleles, counted_alleles, zygosity

COUNTERS = ("ac", "an", "hc", "pn")


def frequency_aggregates(gt: Column) -> list[Column]:
    z = zygosity(gt)
    called = z != "UNK"
    return [
        F.coalesce(F.sum(F.when(called, alternative_alleles(gt))), F.lit(0)).cast("bigint").alias("ac"),
        F.coalesce(F.sum(F.when(called, counted_alleles(gt))), F.lit(0)).cast("bigint").alias("an"),
        F.count(F.when(z == "HOM", 1)).alias("hc"),
        F.count(F.when(z.isin("HET", "HOM"), 1)).alias("pn"),
    ]


def allele_frequency(ac: str | Column = "ac", an: str | Column = "an") -> Column:
    ac, an = (F.col(c) if isinstance(c, str) else c for c in (ac, an))
    return F.when(an > 0, ac.cast("double") / an).otherwise(F.lit(0.0))


def cohort_frequency(calls: DataFrame, keys: Sequence[str], gt: str = "gt") -> DataFrame:
    """One row per variant. Sums and counts only, so calls are reduced before the exchange."""
    return calls.groupBy(*keys).agg(*frequency_aggregates(F.col(gt))).withColumn("af", allele_frequency())


def lab_frequency(calls: DataFrame, patients: DataFrame, keys: Sequence[str], specimen: str = "specimen",
                  lab: str = "lab", gt: str = "gt") -> DataFrame:
    """One row per (variant, laboratory) that has a sample at the variant.

    No broadcast hint: Spark broadcasts the patients only when their size is known to be small,
    otherwise it shuffles both sides and splits a hot specimen."""
    with_lab = calls.join(patients.select(specimen, lab), specimen)
    return with_lab.groupBy(*keys, lab).agg(*frequency_aggregates(F.col(gt))).withColumn("af", allele_frequency())


def with_absent_labs(by_lab: DataFrame, patients: DataFrame, keys: Sequence[str], lab: str = "lab") -> DataFrame:
    """Adds zero rows so that every laboratory of the cohort appears at every variant.

    Extracts list all samples on every line and need no padding; this is for sparse call tables.
    The laboratory names come in as one scalar value (their number is the number of laboratories, not of
    patients), and only absent ones are generated."""
    names = patients.agg(F.array_sort(F.collect_set(lab))).scalar()
    seen = by_lab.groupBy(*keys).agg(F.collect_set(lab).alias("_seen"))
    absent = seen.select(*keys, F.explode(F.array_except(names, F.col("_seen"))).alias(lab))
    zeros = absent.select(*keys, lab, *[F.lit(0).cast("bigint").alias(c) for c in COUNTERS], F.lit(0.0).alias("af"))
    return by_lab.unionByName(zeros)


def cohort_and_lab_frequency(calls: DataFrame, patients: DataFrame, keys: Sequence[str],
                             specimen: str = "specimen", lab: str = "lab", gt: str = "gt") -> DataFrame:
    """Both levels in one pass: grouping sets over the already reduced (variant, laboratory) counters.

    The cohort level has a null laboratory and ``level`` = ``interne``."""
    by_lab = lab_frequency(calls, patients, keys, specimen, lab, gt).drop("af")
    columns = [*keys, lab]
    sets = by_lab.groupingSets([list(keys), columns], *columns).agg(
        *[F.sum(c).alias(c) for c in COUNTERS], F.grouping(lab).alias("_all"))
    return sets.select(
        *columns, F.when(F.col("_all") == 1, "interne").otherwise("lab").alias("level"), *COUNTERS,
        allele_frequency().alias("af"),
    )
