"""Inheritance predicates over a family array.

A family is an array of ``struct<z, sex, aff>``: the proband first, then the relatives in order.
Relatives are told apart by their sex, and only the proband's status counts when ``strict`` is false."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from variantloom.functions.genotype import is_affected, is_girl, is_boy, zygosity


def member(gt: Column, sex: Column, phenotype: Column) -> Column:
    return F.struct(zygosity(gt).alias("z"), sex.alias("sex"), is_affected(phenotype).alias("aff"))


def _considered(family: Column, strict: bool) -> Column:
    return family if strict else F.slice(family, 1, 1)


def _affected(family: Column) -> Column:
    return F.filter(family, lambda m: m["aff"])


def autosomal_dominant(family: Column, strict: bool = True) -> Column:
    seen = _considered(family, strict)
    # an affected relative without a call is tolerated, an affected proband without one is not
    proband = seen[0]
    relatives = F.slice(seen, F.lit(2), F.greatest(F.size(seen) - 1, F.lit(0)))
    proband_fits = F.when(proband["aff"], proband["z"] == "HET").otherwise(~proband["z"].isin("HET", "HOM"))
    relatives_fit = F.forall(
        relatives,
        lambda m: F.when(m["aff"], m["z"].isin("HET", "UNK")).otherwise(~m["z"].isin("HET", "HOM")),
    )
    someone = (F.size(family) == 1) | F.exists(seen, lambda m: m["aff"])
    return proband_fits & relatives_fit & someone


def autosomal_recessive(family: Column, strict: bool = True) -> Column:
    seen = _considered(family, strict)
    fit = F.forall(
        seen, lambda m: F.when(m["aff"], m["z"] == "HOM").otherwise(~m["z"].isin("HOM", "HOM REF"))
    )
    return fit & ((F.size(family) == 1) | (F.size(_affected(seen)) <= 1))


def de_novo(family: Column, strict: bool = True) -> Column:
    """Needs an affected proband with relatives; unaffected members are homozygous reference or not called."""
    affected_het = lambda m: m["z"].isin("HET", "UNK")
    unaffected_ref = lambda m: m["z"].isin("HOM REF", "UNK")
    proband = family[0]
    relatives = F.slice(family, F.lit(2), F.greatest(F.size(family) - 1, F.lit(0)))
    if strict:
        fit = F.forall(family, lambda m: F.when(m["aff"], affected_het(m)).otherwise(unaffected_ref(m)))
        single = F.size(F.filter(family, lambda m: m["aff"] & (m["z"] == "HET"))) <= 1
    else:
        fit = affected_het(proband) & F.forall(relatives, unaffected_ref)
        single = F.lit(True)
    return (F.size(family) > 1) & proband["aff"] & fit & single


def x_recessive(family: Column, strict: bool = True) -> Column:
    proband = family[0]
    boy, girl = is_boy(proband["sex"]), is_girl(proband["sex"])
    carries = (proband["z"] == "HOM") | (boy & (proband["z"] == "HET"))
    alone = proband["aff"] & carries
    relatives = F.slice(family, F.lit(2), F.greatest(F.size(family) - 1, F.lit(0)))

    def fits(m: Column) -> Column:
        for_girl = F.when(m["sex"] == "1", m["aff"] & (m["z"] != "HOM REF")).when(
            m["sex"] == "2", ~m["z"].isin("HOM", "HOM REF"))
        for_boy = F.when(
            m["sex"] == "1",
            F.when(m["aff"], m["z"] != "HOM REF").otherwise(~m["z"].isin("HOM", "HET")),
        ).when(m["sex"] == "2", F.when(m["aff"], m["z"].isin("HOM", "UNK")).otherwise(m["z"] != "HOM"))
        return F.coalesce(F.when(girl, for_girl).otherwise(for_boy), F.lit(True))

    together = carries & F.forall(relatives, fits)
    verdict = F.when(F.size(family) == 1, alone).otherwise(together) if strict else alone
    return (boy | girl) & verdict


def x_dominant(family: Column, strict: bool = True) -> Column:
    """Female probands only."""
    proband = family[0]
    girl = is_girl(proband["sex"])
    alone = proband["aff"] & (proband["z"] == "HET")
    relatives = F.slice(family, F.lit(2), F.greatest(F.size(family) - 1, F.lit(0)))
    absent = lambda m: m["z"].isin("HOM REF", "UNK")
    proband_fits = F.when(proband["aff"], proband["z"] == "HET").otherwise(absent(proband))
    relatives_fit = F.forall(relatives, lambda m: F.when(m["aff"], m["z"] != "HOM REF").otherwise(absent(m)))
    source = proband["aff"] | F.exists(
        relatives, lambda m: m["aff"] & ((m["sex"] == "1") | (m["z"] == "HET")))
    together = proband_fits & relatives_fit & source
    verdict = F.when(F.size(family) == 1, alone).otherwise(together) if strict else alone
    return girl & verdict


def transmissions(family: Column, contig_name: Column, strict: bool = True) -> Column:
    """Modes that fit, by chromosome; null when none does."""
    contig_upper = F.upper(contig_name)
    autosome = ~contig_upper.isin("X", "Y")
    on_x = contig_upper == "X"
    modes = F.array_compact(F.array(
        F.when(autosome & autosomal_dominant(family, strict), "AD"),
        F.when(autosome & autosomal_recessive(family, strict), "AR"),
        F.when(on_x & x_dominant(family, strict), "XD"),
        F.when(on_x & x_recessive(family, strict), "XR"),
        F.when(de_novo(family, strict), "DeNovo"),
    ))
    return F.when(F.size(modes) > 0, modes)
