"""Golden scalars, golden rows of the inheritance predicates, and the predicates against their rules in plain Python."""

import itertools

import pytest
from pyspark.sql import functions as F

from variantloom.functions import genotype as g, inheritance as inh

# Pedigree name -> (proband sex, father phenotype, mother phenotype); None: proband alone.
PEDIGREES = {
    "0": ("1", None, None), "0F": ("2", None, None), "1": ("1", "1", "1"), "1F": ("2", "1", "1"),
    "2": ("1", "2", "1"), "2F": ("2", "2", "1"), "2M": ("1", "1", "2"), "FMth": ("2", "1", "2"),
    "3": ("1", "2", "HP:0000268"), "3F": ("2", "2", "HP:0000268"),
}
# Rule, pedigree, mode, genotypes of proband, father and mother, expected.
GOLDEN = [
    ("AD", "0", "strict", "0/1 0/0 0/0", True),
    ("AD", "0", "strict", "0/1 ./. 0/0", True),
    ("AD", "0", "strict", "1/1 0/0 ./.", False),
    ("AD", "0", "strict", "0/0 1/0 0/0", False),
    ("AD", "1", "strict", "0/1 0/0 0/0", True),
    ("AD", "1", "strict", "0/1 ./. 0/0", True),
    ("AD", "1", "strict", "1/1 0/0 ./.", False),
    ("AD", "1", "strict", "0/0 1/0 0/0", False),
    ("AD", "1", "lax", "0/1 0/0 0/0", True),
    ("AD", "1", "lax", "0/1 ./. 0/0", True),
    ("AD", "1", "lax", "1/1 0/0 ./.", False),
    ("AD", "1", "lax", "0/0 1/0 0/0", False),
    ("AD", "2", "strict", "0/1 ./. 0/0", True),
    ("AD", "2", "strict", "1/0 ./. ./.", True),
    ("AD", "2", "strict", "1/1 0/0 ./.", False),
    ("AD", "2", "strict", "0/1 0/0 0/0", False),
    ("AD", "2", "lax", "0/1 0/0 0/0", True),
    ("AD", "2", "lax", "0/1 ./. 0/0", True),
    ("AD", "2", "lax", "1/1 0/0 ./.", False),
    ("AD", "2", "lax", "0/0 1/0 0/0", False),
    ("AD", "3", "strict", "1/0 ./. ./.", True),
    ("AD", "3", "strict", "0/1 1/0 1/0", True),
    ("AD", "3", "strict", "1/1 0/0 ./.", False),
    ("AD", "3", "strict", "0/1 0/0 0/0", False),
    ("AD", "3", "lax", "0/1 0/0 0/0", True),
    ("AD", "3", "lax", "0/1 ./. 0/0", True),
    ("AD", "3", "lax", "1/1 0/0 ./.", False),
    ("AD", "3", "lax", "0/0 1/0 0/0", False),
    ("AR", "0", "strict", "1/1 0/0 ./.", True),
    ("AR", "0", "strict", "1/1 0/0 0/0", True),
    ("AR", "0", "strict", "0/1 0/0 0/0", False),
    ("AR", "0", "strict", "0/1 ./. 0/0", False),
    ("AR", "1", "strict", "1/1 1/0 1/0", True),
    ("AR", "1", "strict", "1/1 0/1 ./.", True),
    ("AR", "1", "strict", "1/1 0/0 ./.", False),
    ("AR", "1", "strict", "0/1 0/0 0/0", False),
    ("AR", "1", "lax", "1/1 0/0 ./.", True),
    ("AR", "1", "lax", "1/1 0/0 0/0", True),
    ("AR", "1", "lax", "0/1 0/0 0/0", False),
    ("AR", "1", "lax", "0/1 ./. 0/0", False),
    ("AR", "2", "strict", "1/1 0/0 ./.", False),
    ("AR", "2", "strict", "0/1 0/0 0/0", False),
    ("AR", "2", "strict", "0/1 ./. 0/0", False),
    ("AR", "2", "lax", "1/1 0/0 ./.", True),
    ("AR", "2", "lax", "1/1 0/0 0/0", True),
    ("AR", "2", "lax", "0/1 0/0 0/0", False),
    ("AR", "2", "lax", "0/1 ./. 0/0", False),
    ("AR", "3", "strict", "1/1 0/0 ./.", False),
    ("AR", "3", "strict", "0/1 0/0 0/0", False),
    ("AR", "3", "strict", "0/1 ./. 0/0", False),
    ("AR", "3", "lax", "1/1 0/0 ./.", True),
    ("AR", "3", "lax", "1/1 0/0 0/0", True),
    ("AR", "3", "lax", "0/1 0/0 0/0", False),
    ("AR", "3", "lax", "0/1 ./. 0/0", False),
    ("DN", "0", "strict", "1/1 0/0 ./.", False),
    ("DN", "0", "strict", "0/1 0/0 0/0", False),
    ("DN", "0", "strict", "0/1 ./. 0/0", False),
    ("DN", "0", "lax", "1/1 0/0 ./.", False),
    ("DN", "0", "lax", "0/1 0/0 0/0", False),
    ("DN", "0", "lax", "0/1 ./. 0/0", False),
    ("DN", "1", "strict", "0/1 0/0 0/0", True),
    ("DN", "1", "strict", "0/1 ./. 0/0", True),
    ("DN", "1", "strict", "1/1 0/0 ./.", False),
    ("DN", "1", "strict", "0/0 1/0 0/0", False),
    ("DN", "1", "lax", "0/1 0/0 0/0", True),
    ("DN", "1", "lax", "0/1 ./. 0/0", True),
    ("DN", "1", "lax", "1/1 0/0 ./.", False),
    ("DN", "1", "lax", "0/0 1/0 0/0", False),
    ("DN", "2", "strict", "0/1 ./. 0/0", True),
    ("DN", "2", "strict", "1/0 ./. ./.", True),
    ("DN", "2", "strict", "1/1 0/0 ./.", False),
    ("DN", "2", "strict", "0/1 0/0 0/0", False),
    ("DN", "2", "lax", "0/1 0/0 0/0", True),
    ("DN", "2", "lax", "0/1 ./. 0/0", True),
    ("DN", "2", "lax", "1/1 0/0 ./.", False),
    ("DN", "2", "lax", "0/0 1/0 0/0", False),
    ("DN", "3", "strict", "1/0 ./. ./.", True),
    ("DN", "3", "strict", "1/1 0/0 ./.", False),
    ("DN", "3", "strict", "0/1 0/0 0/0", False),
    ("DN", "3", "lax", "0/1 0/0 0/0", True),
    ("DN", "3", "lax", "0/1 ./. 0/0", True),
    ("DN", "3", "lax", "1/1 0/0 ./.", False),
    ("DN", "3", "lax", "0/0 1/0 0/0", False),
    ("XR", "0", "strict", "1/1 0/0 ./.", True),
    ("XR", "0", "strict", "0/1 0/0 0/0", True),
    ("XR", "0", "strict", "0/0 1/0 0/0", False),
    ("XR", "0", "strict", "0/0 0/0 1/0", False),
    ("XR", "0F", "strict", "1/1 0/0 ./.", True),
    ("XR", "0F", "strict", "1/1 0/0 0/0", True),
    ("XR", "0F", "strict", "0/1 0/0 0/0", False),
    ("XR", "0F", "strict", "0/1 ./. 0/0", False),
    ("XR", "1", "strict", "1/1 0/0 ./.", True),
    ("XR", "1", "strict", "0/1 0/0 0/0", True),
    ("XR", "1", "strict", "0/0 1/0 0/0", False),
    ("XR", "1", "strict", "0/0 0/0 1/0", False),
    ("XR", "1F", "strict", "1/1 0/0 ./.", False),
    ("XR", "1F", "strict", "0/1 0/0 0/0", False),
    ("XR", "1F", "strict", "0/1 ./. 0/0", False),
    ("XR", "2", "strict", "0/1 ./. 0/0", True),
    ("XR", "2", "strict", "1/0 ./. ./.", True),
    ("XR", "2", "strict", "1/1 0/0 ./.", False),
    ("XR", "2", "strict", "0/1 0/0 0/0", False),
    ("XR", "2F", "strict", "1/1 1/0 1/0", True),
    ("XR", "2F", "strict", "1/1 0/1 ./.", True),
    ("XR", "2F", "strict", "1/1 0/0 ./.", False),
    ("XR", "2F", "strict", "0/1 0/0 0/0", False),
    ("XR", "FMth", "strict", "1/1 0/0 ./.", False),
    ("XR", "FMth", "strict", "0/1 0/0 0/0", False),
    ("XR", "FMth", "strict", "0/1 ./. 0/0", False),
    ("XR", "3", "strict", "1/0 ./. ./.", True),
    ("XR", "3", "strict", "1/1 0/1 ./.", True),
    ("XR", "3", "strict", "1/1 0/0 ./.", False),
    ("XR", "3", "strict", "0/1 0/0 0/0", False),
    ("XR", "3F", "strict", "1/1 1/0 1/0", True),
    ("XR", "3F", "strict", "1/1 0/1 ./.", True),
    ("XR", "3F", "strict", "1/1 0/0 ./.", False),
    ("XR", "3F", "strict", "0/1 0/0 0/0", False),
    ("XD", "0", "strict", "1/1 0/0 ./.", False),
    ("XD", "0", "strict", "0/1 0/0 0/0", False),
    ("XD", "0", "strict", "0/1 ./. 0/0", False),
    ("XD", "0F", "strict", "0/1 0/0 0/0", True),
    ("XD", "0F", "strict", "0/1 ./. 0/0", True),
    ("XD", "0F", "strict", "1/1 0/0 ./.", False),
    ("XD", "0F", "strict", "0/0 1/0 0/0", False),
    ("XD", "1", "strict", "1/1 0/0 ./.", False),
    ("XD", "1", "strict", "0/1 0/0 0/0", False),
    ("XD", "1", "strict", "0/1 ./. 0/0", False),
    ("XD", "2M", "strict", "1/1 0/0 ./.", False),
    ("XD", "2M", "strict", "0/1 0/0 0/0", False),
    ("XD", "2M", "strict", "0/1 ./. 0/0", False),
    ("XD", "1F", "strict", "0/1 0/0 0/0", True),
    ("XD", "1F", "strict", "0/1 ./. 0/0", True),
    ("XD", "1F", "strict", "1/1 0/0 ./.", False),
    ("XD", "1F", "strict", "0/0 1/0 0/0", False),
    ("XD", "2", "strict", "1/1 0/0 ./.", False),
    ("XD", "2", "strict", "0/1 0/0 0/0", False),
    ("XD", "2", "strict", "0/1 ./. 0/0", False),
    ("XD", "2F", "strict", "0/1 ./. 0/0", True),
    ("XD", "2F", "strict", "1/0 ./. ./.", True),
    ("XD", "2F", "strict", "1/1 0/0 ./.", False),
    ("XD", "2F", "strict", "0/1 0/0 0/0", False),
    ("XD", "FMth", "strict", "1/0 ./. ./.", True),
    ("XD", "FMth", "strict", "0/1 0/0 1/1", True),
    ("XD", "FMth", "strict", "1/1 0/0 ./.", False),
    ("XD", "FMth", "strict", "0/1 0/0 0/0", False),
]
# Clinical review. pedigree, genotypes -> {(predicate, mode): expected}
REVIEW = [
    ("1", "0/1 0/0 0/0", {("DN", "lax"): True, ("DN", "strict"): True}),
    ("2M", "0/1 0/0 0/1", {("AD", "lax"): True, ("AR", "lax"): False, ("AD", "strict"): True, ("AR", "strict"): False}),
    ("2M", "0/1 0/0 1/1", {("AD", "lax"): True, ("AR", "lax"): False, ("AR", "strict"): False}),
    ("1", "0/1 0/0 ./.", {("DN", "strict"): True}),
    ("2M", "0/1 0/0 ./.", {("AD", "lax"): True, ("AR", "lax"): False, ("AD", "strict"): True, ("AR", "strict"): False}),
    ("3", "0/1 0/1 0/1", {("AD", "lax"): True, ("AR", "lax"): False, ("AD", "strict"): True, ("AR", "strict"): False}),
    ("2M", "0/1 0/1 ./.", {("AD", "lax"): True, ("AR", "lax"): False, ("AD", "strict"): False, ("AR", "strict"): False}),
    ("1", "0/1 0/1 ./.", {("AD", "lax"): True, ("AR", "lax"): False, ("AD", "strict"): False, ("AR", "strict"): False}),
    ("2", "0/1 0/1 ./.", {("AD", "lax"): True, ("AR", "lax"): False, ("AD", "strict"): True, ("AR", "strict"): False}),
    ("3", "0/1 0/1 ./.", {("AD", "lax"): True, ("AR", "lax"): False, ("AD", "strict"): True, ("AR", "strict"): False}),
    ("1", "1/1 0/1 0/1", {("AD", "lax"): False, ("AR", "lax"): True, ("AD", "strict"): False, ("AR", "strict"): True}),
    ("2", "1/1 0/1 0/1", {("AR", "lax"): True, ("AR", "strict"): False}),
    ("3", "1/1 0/1 0/1", {("AR", "lax"): True, ("AR", "strict"): False}),
]
RULES = {
    "AD": inh.autosomal_dominant, "AR": inh.autosomal_recessive, "DN": inh.de_novo, "XR": inh.x_recessive,
    "XD": inh.x_dominant,
}


def _is_affected(phenotype):
    return phenotype != "1"


def _plain(rule, strict, family):
    """The rules as written down for the data: members are (zygosity, sex, affected), the proband first."""
    zygosity, sex, affected = family[0]
    seen = family if strict else family[:1]
    alone = len(family) == 1
    if rule == "AD":
        for place, (z, _, ill) in enumerate(seen):
            if ill and not (z == "HET" or (place > 0 and z == "UNK")) or not ill and z in ("HET", "HOM"):
                return False
        return alone or any(ill for _, _, ill in seen)
    if rule == "AR":
        for z, _, ill in seen:
            if ill and z != "HOM" or not ill and z.startswith("HOM"):
                return False
        return alone or sum(ill for _, _, ill in seen) <= 1
    if rule == "DN":
        if alone or not affected:
            return False
        # without strict, relatives count as unaffected
        for place, (z, _, ill) in enumerate(family):
            if z not in ("UNK", "HET" if ill and (strict or place == 0) else "HOM REF"):
                return False
        return not strict or sum(ill and z == "HET" for z, _, ill in family) <= 1
    boy = sex == "1"
    if rule == "XR":
        carries = zygosity == "HOM" or (boy and zygosity == "HET")
        if alone or not strict:
            return affected and carries
        for z, s, ill in family[1:]:
            if not boy:
                fits = ill and z != "HOM REF" if s == "1" else not z.startswith("HOM")
            elif s == "1":
                fits = z != "HOM REF" if ill else z not in ("HOM", "HET")
            else:
                fits = z in ("HOM", "UNK") if ill else z != "HOM"
            carries = carries and fits
        return carries
    if boy:
        return False
    if alone or not strict:
        return affected and zygosity == "HET"
    for place, (z, _, ill) in enumerate(family):
        if ill and (z != "HET" if place == 0 else z == "HOM REF") or not ill and z not in ("HOM REF", "UNK"):
            return False
    return any(ill and (place == 0 or s == "1" or z == "HET") for place, (z, s, ill) in enumerate(family))


def _cases():
    for rule, ped, mode, genotypes, wanted in GOLDEN:
        yield rule, ped, mode, genotypes, wanted
    for ped, genotypes, outcomes in REVIEW:
        for (rule, mode), wanted in outcomes.items():
            yield rule, ped, mode, genotypes, wanted


def _members(ped):
    sex, father, mother = PEDIGREES[ped]
    return [(sex, "2")] + ([] if father is None else [("1", father), ("2", mother)])


def _all_combinations():
    calls = {"0/0": "HOM REF", "0/1": "HET", "1/0": "HET", "1/1": "HOM", "./.": "UNK"}
    for rule, mode, ped in itertools.product(RULES, ("strict", "lax"), PEDIGREES):
        members = _members(ped)
        for gts in itertools.product(calls, repeat=len(members)):
            family = [(calls[gt], s, _is_affected(p)) for gt, (s, p) in zip(gts, members)]
            yield rule, ped, mode, " ".join(gts), _plain(rule, mode == "strict", family)


@pytest.mark.parametrize("cases, least", [(_cases, 150), (_all_combinations, 9000)])
def test_inheritance(spark, cases, least):
    rows = []
    for rule, ped, mode, genotypes, wanted in cases():
        family = [(gt, s, p) for gt, (s, p) in zip(genotypes.split(), _members(ped))]
        rows.append((rule, ped, mode, genotypes, wanted, family))
    assert len(rows) > least
    df = spark.createDataFrame(
        rows, "rule string, ped string, mode string, genotypes string, wanted boolean, "
              "members array<struct<gt: string, sex: string, phenotype: string>>")
    family = F.transform("members", lambda m: inh.member(m["gt"], m["sex"], m["phenotype"]))
    verdict = F.lit(None).cast("boolean")
    for rule, predicate in RULES.items():
        for mode in ("strict", "lax"):
            verdict = F.when((F.col("rule") == rule) & (F.col("mode") == mode),
                             predicate(F.col("family"), mode == "strict")).otherwise(verdict)
    wrong = df.withColumn("family", family).withColumn("verdict", verdict).where("NOT (verdict <=> wanted)").collect()
    assert wrong == []


@pytest.mark.parametrize("function, cases", [
    (g.zygosity, {"0/0": "HOM REF", "0|0": "HOM REF", "0/1": "HET", "1/2": "HET", "1/1": "HOM", "2/2": "HOM",
                  "./.": "UNK", "1/.": "UNK", "1": "UNK", "0/10": "UNK"}),
    (g.alternative_alleles, {"0/0": 0, "0|0": 0, "./.": 0, "0/1": 1, "1/0": 1, "1/1": 2, "1|1": 2, "2/2": 0}),
    (g.counted_alleles, {"0/0": 2, "0|0": 2, "0/1": 2, "1/0": 2, "1/1": 2, "1|1": 2, "./.": 0}),
    (g.impact_score, {"HIGH": 4, "high": 4, "MODERATE": 3, "LOW": 2, "MODIFIER": 1, "BOB": 0, "": 0, None: 0}),
    (g.allele_origin, {"FTH:0/1,MTH:0/0": "FTH", "FTH:0/0,MTH:0/1": "MTH", "FTH:0/0,MTH:0|1": None,
                       "MTH:0/1,FTH:0/0": None}),
])
def test_scalars(spark, function, cases):
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select("v", function(F.col("v"))).collect()
    assert {r[0]: r[1] for r in rows} == cases
