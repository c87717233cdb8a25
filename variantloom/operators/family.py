"""Family vectors, family genotype strings and inheritance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.functions.genotype import CARRIER, allele_origin, is_affected, zygosity
from variantloom.functions.inheritance import transmissions

NO_CALL = "./."


def families(ped: DataFrame, family: str = "family_id", order: str = "member",
             fields: Sequence[str] = ("specimen", "sex", "phenotype", "relation")) -> DataFrame:
    """One row per family with its members in order (a family has few members)."""
    return ped.groupBy(family).agg(
        F.array_sort(F.collect_list(F.struct(order, *fields))).alias("members"))


def called_families(calls: DataFrame, ped: DataFrame, keys: Sequence[str], family: str = "family_id",
                    specimen: str = "specimen", gt: str = "gt", order: str = "member") -> DataFrame:
    """One row per (variant, family) with at least one call: ordered members with their genotype.

    Starts from the calls, never from variants x families; members without a call get ``./.``."""
    called = (
        calls.select(*keys, specimen, gt).join(ped.select(specimen, family, order), specimen)
        .groupBy(*keys, family)
        .agg(F.map_from_entries(F.collect_list(F.struct(order, gt))).alias("_gts"))
    )
    return called.join(families(ped, family, order), family).select(
        *keys, family,
        F.transform("members", lambda m: m.withField(
            "gt", F.coalesce(F.try_element_at("_gts", m[order]), F.lit(NO_CALL)))).alias("members"),
    )


def after_proband(members: Column, order: str = "member") -> Column:
    """The proband followed by the members behind it in order; null for a family without proband."""
    proband = F.filter(members, lambda m: m["relation"] == "Proband")
    return F.when(F.size(proband) > 0, F.filter(members, lambda m: m[order] >= proband[0][order]))


def proband_and_relatives(members: Column) -> Column:
    """All relatives whatever their order: the option for extracts whose proband does not come first."""
    is_proband = lambda m: m["relation"] == "Proband"
    proband = F.filter(members, is_proband)
    return F.when(F.size(proband) > 0, F.concat(proband, F.filter(members, lambda m: ~is_proband(m))))


def predicate_family(members: Column) -> Column:
    """Ordered members -> the ``struct<z, sex, aff>`` array the inheritance predicates take."""
    return F.transform(members, lambda m: F.struct(
        zygosity(m["gt"]).alias("z"), m["sex"].alias("sex"), is_affected(m["phenotype"]).alias("aff")))


def genotype_string(members: Column) -> Column:
    """``relation:gt`` of the members behind the proband; null when there are none."""
    text = F.array_join(
        F.transform(F.slice(members, F.lit(2), F.greatest(F.size(members) - 1, F.lit(0))),
                    lambda m: F.concat(m["relation"], F.lit(":"), m["gt"])), ",")
    return F.when(text != "", text)


def family_inheritance(called: DataFrame, contig_name: Column, keys: Sequence[str], family: str = "family_id",
                       order: str = "member", pedigree_order: bool = False) -> DataFrame:
    """Carrier probands of families with more than one member: genotype string, origin, modes."""
    pick = proband_and_relatives if pedigree_order else (lambda m: after_proband(m, order))
    return (
        called.withColumn("_contig", contig_name)
        .withColumn("_size", F.size("members"))
        .withColumn("_line", pick(F.col("members")))
        .where(F.col("_line").isNotNull() & (F.col("_size") > 1))
        .withColumn("_family", predicate_family(F.col("_line")))
        .where(F.col("_family")[0]["z"].isin(*CARRIER))
        .select(
            *keys, family, genotype_string(F.col("_line")).alias("genotype_family"),
            transmissions(F.col("_family"), F.col("_contig")).alias("transmission"),
        )
        .withColumn("origin", allele_origin(F.col("genotype_family")))
    )
