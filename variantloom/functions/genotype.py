"""Genotype and clinical scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Allele-origin literals, genotype string of (father, mother) -> parent the allele comes from.
FROM_FATHER = (
    "FTH:0/1,MTH:0/0", "FTH:0|1,MTH:0/0", "FTH:1/0,MTH:0/0", "FTH:1|0,MTH:0/0", "FTH:1/1,MTH:0/0",
    "FTH:1|1,MTH:0/0", "FTH:1/1,MTH:1/0", "FTH:1|1,MTH:0/1", "FTH:1/1,MTH:1|0", "FTH:1|1,MTH:0|1",
)
FROM_MOTHER = (
    "FTH:0/0,MTH:0/1", "FTH:0/0,MTH:1|0", "FTH:0/0,MTH:1/0", "FTH:0|0,MTH:0|1", "FTH:0/0,MTH:1/1",
    "FTH:0/0,MTH:1|1", "FTH:1/0,MTH:1/1", "FTH:0/1,MTH:1|1", "FTH:1|0,MTH:1/1", "FTH:0|1,MTH:1|1",
)
# Impact -> score.
IMPACT_SCORES = {"HIGH": 4, "MODERATE": 3, "LOW": 2, "MODIFIER": 1}
# Prediction codes.
FATHMM_CODES = {"D": "DAMAGING", "T": "TOLERATED"}
POLYPHEN2_HVAR_CODES = {"B": "BENIGN", "P": "POSSIBLY DAMAGING", "D": "PROBABLY DAMAGING"}
LRT_CODES = {"N": "NEUTRAL", "D": "DELETERIOUS", "U": "UNKNOWN"}
SIFT_CODES = {"D": "DAMAGING", "T": "TOLERATED"}

CALLED = ("HET", "HOM", "HOM REF")
CARRIER = ("HET", "HOM")


def _alleles(gt: Column) -> tuple[Column, Column]:
    return F.substring(gt, 1, 1), F.substring(gt, 3, 1)


def zygosity(gt: Column) -> Column:
    """UNK, HOM REF, HET or HOM. Haploid, longer and missing genotypes are UNK."""
    first, second = _alleles(gt)
    diploid = (F.length(gt) == 3) & (first != ".") & (second != ".")
    return (
        F.when(~F.coalesce(diploid, F.lit(False)), "UNK")
        .when(first != second, "HET")
        .when(first == "0", "HOM REF")
        .otherwise("HOM")
    )


def _count_in(gt: Column, *symbols: str) -> Column:
    first, second = _alleles(gt)
    hits = first.isin(*symbols).cast("int") + second.isin(*symbols).cast("int")
    return F.coalesce(hits, F.lit(0))


def alternative_alleles(gt: Column) -> Column:
    """Alleles equal to 1; higher allele numbers do not count (input is normalised)."""
    return _count_in(gt, "1")


def counted_alleles(gt: Column) -> Column:
    return _count_in(gt, "0", "1")


def is_carrier(gt: Column) -> Column:
    return zygosity(gt).isin(*CARRIER)


def code_table(codes: dict, value: Column) -> Column:
    """Literal lookup; a code that is not listed (or null) gives null."""
    picked = F.lit(None)
    for code, meaning in codes.items():
        picked = F.when(value == code, F.lit(meaning)).otherwise(picked)
    return picked


def impact_score(impact: Column) -> Column:
    return F.coalesce(code_table(IMPACT_SCORES, F.upper(impact)), F.lit(0)).cast("int")


def depth_total(ad_ref: Column, ad_alt: Column) -> Column:
    return ad_ref + ad_alt


def depth_ratio(ad_ref: Column, ad_alt: Column) -> Column:
    total = depth_total(ad_ref, ad_alt)
    return F.when(total > 0, ad_alt.cast("double") / total).otherwise(F.lit(0.0))


def is_boy(sex: Column) -> Column:
    return F.coalesce(sex == "1", F.lit(False))


def is_girl(sex: Column) -> Column:
    return F.coalesce(sex == "2", F.lit(False))


def is_affected(phenotype: Column) -> Column:
    """Anything but 1 counts as affected."""
    return F.coalesce(phenotype != "1", F.lit(True))


def allele_origin(genotype_family: Column) -> Column:
    return F.when(genotype_family.isin(*FROM_FATHER), "FTH").when(genotype_family.isin(*FROM_MOTHER), "MTH")
