"""Keys, genotypes, frequencies, donors and inheritance over long call tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from variantloom.functions import genotype as g, inheritance as inh, keys as k
from variantloom.operators import calls as c, family as fam, frequency as fr
from variantloom.operators.grouping import nest
from variantloom.plans.bridge import BUILD, Inputs
from variantloom.plans.registry import query

ZYGOSITY = """CASE WHEN length({gt}) <> 3 OR substr({gt}, 1, 1) = '.' OR substr({gt}, 3, 1) = '.' THEN 'UNK'
 WHEN substr({gt}, 1, 1) <> substr({gt}, 3, 1) THEN 'HET' WHEN substr({gt}, 1, 1) = '0' THEN 'HOM REF' ELSE 'HOM' END"""
ALT_ALLELES = "(cast(substr({gt}, 1, 1) = '1' AS int) + cast(substr({gt}, 3, 1) = '1' AS int))"
ALL_ALLELES = "(cast(substr({gt}, 1, 1) IN ('0', '1') AS int) + cast(substr({gt}, 3, 1) IN ('0', '1') AS int))"
MUTATION = ("concat('chr', substr(chrom, 4), ':g.', cast(pos AS string), ref, '>', "
            "string_split(replace(alt, ',<NON_REF>', ''), ',')[1])")
PRIMARY = "length(substr(chrom, 4)) <= 2"


def z(gt: str = "gt") -> str:
    return ZYGOSITY.format(gt=gt)


def counters(gt: str = "gt") -> str:
    called = f"{z(gt)} <> 'UNK'"
    return f"""cast(coalesce(sum(CASE WHEN {called} THEN {ALT_ALLELES.format(gt=gt)} END), 0) AS bigint) AS ac,
 cast(coalesce(sum(CASE WHEN {called} THEN {ALL_ALLELES.format(gt=gt)} END), 0) AS bigint) AS an,
 count(CASE WHEN {z(gt)} = 'HOM' THEN 1 END) AS hc, count(CASE WHEN {z(gt)} IN ('HET', 'HOM') THEN 1 END) AS pn"""


AF = "CASE WHEN an > 0 THEN cast(ac AS double) / an ELSE 0.0 END AS af"


def _primary_sites(t: Inputs) -> DataFrame:
    return t.view("gx_sites").where(k.is_primary_contig(F.col("chrom")))


# ---- keys ---------------------------------------------------------------------------------------

@query("variant_keys", f"""
SELECT site_id, substr(chrom, 4) AS contig, replace(alt, ',<NON_REF>', '') AS alt_allele, {MUTATION} AS mutation_id,
 upper(md5(concat({MUTATION}, '@GRCh38'))) AS uid FROM gx_sites WHERE {PRIMARY}""", "gx_sites")
def _(t):
    name = k.contig(F.col("chrom"))
    return _primary_sites(t).select(
        "site_id", name.alias("contig"), k.clean_alt(F.col("alt")).alias("alt_allele"),
        k.mutation_id(name, F.col("pos"), F.col("ref"), F.col("alt")).alias("mutation_id"),
    ).withColumn("uid", k.variant_uid(F.col("mutation_id"), BUILD))


LEGACY_KEY = ("concat(substr(chrom, 4), ':g.', cast(pos AS string), 'chr', ref, '>', "
              "string_split(replace(alt, ',<NON_REF>', ''), ',')[1])")


@query("variant_keys_sha1", f"""
SELECT site_id, {LEGACY_KEY} AS mutation_id, upper(sha1({LEGACY_KEY})) AS uid FROM gx_sites WHERE {PRIMARY}""",
       "gx_sites")
def _(t):
    key = k.legacy_mutation_id(k.contig(F.col("chrom")), F.col("pos"), F.col("ref"), F.col("alt"))
    return _primary_sites(t).select("site_id", key.alias("mutation_id"), k.sha1_hex(key).alias("uid"))


@query("variant_keys_sha256", f"""
SELECT site_id, upper(sha256({MUTATION})) AS uid FROM gx_sites WHERE {PRIMARY}""", "gx_sites")
def _(t):
    key = k.mutation_id(k.contig(F.col("chrom")), F.col("pos"), F.col("ref"), F.col("alt"))
    return _primary_sites(t).select("site_id", k.sha256_hex(key).alias("uid"))


@query("contig_filter_counts", f"""
SELECT chrom, {PRIMARY} AS is_kept, count(*) AS sites FROM gx_sites GROUP BY chrom""", "gx_sites")
def _(t):
    return t.view("gx_sites").groupBy("chrom").agg(
        F.first(k.is_primary_contig(F.col("chrom"))).alias("is_kept"), F.count(F.lit(1)).alias("sites"))


# ---- genotypes and depths -----------------------------------------------------------------------

@query("genotype_class", f"""
SELECT site_id, specimen, gt, {z()} AS zygosity, {ALT_ALLELES.format(gt='gt')} AS alt_alleles,
 {ALL_ALLELES.format(gt='gt')} AS alleles FROM gx_calls""", "gx_calls")
def _(t):
    gt = F.col("gt")
    return t.view("gx_calls").select(
        "site_id", "specimen", "gt", g.zygosity(gt).alias("zygosity"), g.alternative_alleles(gt).alias("alt_alleles"),
        g.counted_alleles(gt).alias("alleles"))


@query("depth_ratio", """
SELECT site_id, specimen, ad_alt, ad_ref + ad_alt AS ad_total,
 CASE WHEN ad_ref + ad_alt > 0 THEN cast(ad_alt AS double) / (ad_ref + ad_alt) ELSE 0.0 END AS ad_freq FROM gx_calls""",
       "gx_calls")
def _(t):
    ref, alt = F.col("ad_ref"), F.col("ad_alt")
    return t.view("gx_calls").select(
        "site_id", "specimen", "ad_alt", g.depth_total(ref, alt).alias("ad_total"),
        g.depth_ratio(ref, alt).alias("ad_freq"))


@query("depth_pointer", """
SELECT site_id, specimen, gt, cast(coalesce(sum(CASE WHEN gt = './.' THEN 1 ELSE 2 END) OVER (
 PARTITION BY site_id ORDER BY specimen ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS ad_start
FROM gx_calls""", "gx_calls")
def _(t):
    calls = t.view("gx_calls").select("site_id", "specimen", "gt")
    return c.depth_pointer(calls, ["site_id"], "specimen", "gt", chunk=256)


@query("affected_and_sex_flags", """
SELECT specimen, sex = '1' AS boy, sex = '2' AS girl, phenotype <> '1' AS affected FROM gx_ped""", "gx_ped")
def _(t):
    return t.view("gx_ped").select(
        "specimen", g.is_boy(F.col("sex")).alias("boy"), g.is_girl(F.col("sex")).alias("girl"),
        g.is_affected(F.col("phenotype")).alias("affected"))


# ---- frequencies --------------------------------------------------------------------------------

@query("cohort_frequency", f"""
SELECT *, {AF} FROM (SELECT site_id, {counters()} FROM gx_calls GROUP BY site_id)""", "gx_calls")
def cohort_frequency(t):
    return fr.cohort_frequency(t.view("gx_calls"), ["site_id"])


@query("lab_frequency", f"""
SELECT *, {AF} FROM (SELECT site_id, lab, {counters()} FROM gx_calls JOIN gx_patients USING (specimen)
 GROUP BY site_id, lab)""", "gx_calls", "gx_patients")
def _(t):
    return fr.lab_frequency(t.view("gx_calls"), t.view("gx_patients"), ["site_id"])


@query("lab_frequency_all_labs", f"""
SELECT *, {AF} FROM (
 SELECT s.site_id, l.lab, coalesce(ac, 0) AS ac, coalesce(an, 0) AS an, coalesce(hc, 0) AS hc, coalesce(pn, 0) AS pn
 FROM (SELECT DISTINCT site_id FROM gx_calls) s CROSS JOIN (SELECT DISTINCT lab FROM gx_patients) l
 LEFT JOIN (SELECT site_id, lab, {counters()} FROM gx_calls JOIN gx_patients USING (specimen)
 GROUP BY site_id, lab) f ON f.site_id = s.site_id AND f.lab = l.lab)""", "gx_calls", "gx_patients")
def _(t):
    patients = t.view("gx_patients")
    by_lab = fr.lab_frequency(t.view("gx_calls"), patients, ["site_id"])
    return fr.with_absent_labs(by_lab, patients, ["site_id"])


@query("cohort_and_lab_grouping_sets", f"""
SELECT *, {AF} FROM (SELECT site_id, lab, CASE WHEN grouping(lab) = 1 THEN 'interne' ELSE 'lab' END AS level,
 {counters()} FROM gx_calls JOIN gx_patients USING (specimen) GROUP BY GROUPING SETS ((site_id), (site_id, lab)))""",
       "gx_calls", "gx_patients")
def _(t):
    return fr.cohort_and_lab_frequency(t.view("gx_calls"), t.view("gx_patients"), ["site_id"])


# ---- donors and families ------------------------------------------------------------------------

@query("carriers", f"""
SELECT site_id, specimen, patient_id, lab, strategy, gt, {z()} AS zygosity FROM gx_calls
JOIN gx_patients USING (specimen) WHERE {z()} IN ('HET', 'HOM')""", "gx_calls", "gx_patients")
def _(t):
    carriers = t.view("gx_calls").where(g.is_carrier(F.col("gt")))
    return carriers.join(t.view("gx_patients"), "specimen").select(
        "site_id", "specimen", "patient_id", "lab", "strategy", "gt", g.zygosity(F.col("gt")).alias("zygosity"))


@query("donors_nested", f"""
SELECT site_id, cast(floor(specimen / 1000) AS bigint) AS page, count(*) AS donors,
 string_agg(concat(cast(specimen AS string), '=', {z()}, '/', patient_id), ',' ORDER BY specimen) AS digest
FROM gx_calls JOIN gx_patients USING (specimen) WHERE {z()} IN ('HET', 'HOM')
GROUP BY site_id, cast(floor(specimen / 1000) AS bigint)""", "gx_calls", "gx_patients")
def _(t):
    carriers = t.view("gx_calls").where(g.is_carrier(F.col("gt"))).withColumn("zygosity", g.zygosity(F.col("gt")))
    donors = carriers.join(t.view("gx_patients"), "specimen")
    nested = nest(donors, ["site_id"], "specimen", ["patient_id", "zygosity", "gt"], "donors", page_size=1000)
    label = lambda d: F.concat(
        d["specimen"].cast("string"), F.lit("="), d["zygosity"], F.lit("/"), d["patient_id"])
    return nested.select(
        "site_id", "page", F.size("donors").cast("bigint").alias("donors"),
        F.array_join(F.transform("donors", label), ",").alias("digest"))


TRIO = """trio AS (
SELECT site_id, chrom, fam.*, coalesce(gp, './.') AS gt_p, coalesce(gf, './.') AS gt_f, coalesce(gm, './.') AS gt_m
FROM (SELECT c.site_id, p.family_id AS fid, max(CASE WHEN member = 0 THEN gt END) AS gp,
 max(CASE WHEN member = 1 THEN gt END) AS gf, max(CASE WHEN member = 2 THEN gt END) AS gm
 FROM gx_calls c JOIN gx_ped p ON p.specimen = c.specimen GROUP BY c.site_id, p.family_id) x
JOIN (SELECT family_id, max(CASE WHEN member = 0 THEN sex END) AS sex_p,
 max(CASE WHEN member = 1 THEN sex END) AS sex_f, max(CASE WHEN member = 2 THEN sex END) AS sex_m,
 max(CASE WHEN member = 0 THEN phenotype END) AS ph_p, max(CASE WHEN member = 1 THEN phenotype END) AS ph_f,
 max(CASE WHEN member = 2 THEN phenotype END) AS ph_m, count(*) AS n_members FROM gx_ped GROUP BY family_id) fam
 ON fam.family_id = x.fid JOIN gx_sites USING (site_id)),
trio_z AS (SELECT *, {zp} AS zp, {zf} AS zf, {zm} AS zm, ph_p <> '1' AS ap, coalesce(ph_f, '1') <> '1' AS af,
 coalesce(ph_m, '1') <> '1' AS am, n_members >= 2 AS has_f, n_members >= 3 AS has_m FROM trio)""".format(
    zp=z("gt_p"), zf=z("gt_f"), zm=z("gt_m"))
TRIO_VIEWS = ("gx_calls", "gx_ped", "gx_sites")

# predicates written out per role, for families of a proband and up to two parents
_DOMINANT_PARENT = "(NOT {has} OR CASE WHEN {a} THEN {z} IN ('HET', 'UNK') ELSE {z} NOT IN ('HET', 'HOM') END)"
_RECESSIVE_PARENT = "(NOT {has} OR CASE WHEN {a} THEN {z} = 'HOM' ELSE {z} NOT IN ('HOM', 'HOM REF') END)"
_DENOVO_PARENT = "(NOT {has} OR CASE WHEN {a} THEN {z} IN ('HET', 'UNK') ELSE {z} IN ('HOM REF', 'UNK') END)"


def _parents(rule: str) -> str:
    return " AND ".join(rule.format(has=f"has_{r}", a=f"a{r}", z=f"z{r}") for r in "fm")


AD = f"CASE WHEN ap THEN zp = 'HET' ELSE zp NOT IN ('HET', 'HOM') END AND {_parents(_DOMINANT_PARENT)} AND (n_members = 1 OR ap OR af OR am)"
AR = (f"CASE WHEN ap THEN zp = 'HOM' ELSE zp NOT IN ('HOM', 'HOM REF') END AND {_parents(_RECESSIVE_PARENT)} "
      "AND (n_members = 1 OR cast(ap AS int) + cast(af AS int) + cast(am AS int) <= 1)")
DENOVO = (f"n_members > 1 AND ap AND zp IN ('HET', 'UNK') AND {_parents(_DENOVO_PARENT)} AND "
          "cast(ap AND zp = 'HET' AS int) + cast(af AND zf = 'HET' AS int) + cast(am AND zm = 'HET' AS int) <= 1")
XR = """CASE WHEN sex_p NOT IN ('1', '2') THEN false
 WHEN n_members = 1 THEN ap AND (zp = 'HOM' OR (sex_p = '1' AND zp = 'HET'))
 WHEN sex_p = '2' THEN zp = 'HOM' AND (NOT has_f OR (af AND zf <> 'HOM REF')) AND (NOT has_m OR zm NOT IN ('HOM', 'HOM REF'))
 ELSE zp IN ('HOM', 'HET') AND (NOT has_f OR CASE WHEN af THEN zf <> 'HOM REF' ELSE zf NOT IN ('HOM', 'HET') END)
  AND (NOT has_m OR CASE WHEN am THEN zm IN ('HOM', 'UNK') ELSE zm <> 'HOM' END) END"""
XD = """CASE WHEN sex_p <> '2' THEN false WHEN n_members = 1 THEN ap AND zp = 'HET'
 ELSE CASE WHEN ap THEN zp = 'HET' ELSE zp IN ('HOM REF', 'UNK') END
  AND (NOT has_f OR CASE WHEN af THEN zf <> 'HOM REF' ELSE zf IN ('HOM REF', 'UNK') END)
  AND (NOT has_m OR CASE WHEN am THEN zm <> 'HOM REF' ELSE zm IN ('HOM REF', 'UNK') END)
  AND (ap OR (has_f AND af) OR (has_m AND am AND zm = 'HET')) END"""


def called_families(t: Inputs) -> DataFrame:
    return fam.called_families(t.view("gx_calls"), t.view("gx_ped"), ["site_id"])


def _predicate(name: str, sql: str, rule) -> None:
    @query(name, f"WITH {TRIO} SELECT site_id, family_id, {sql} AS fits FROM trio_z", *TRIO_VIEWS)
    def _(t):
        return called_families(t).select(
            "site_id", "family_id", rule(fam.predicate_family(F.col("members"))).alias("fits"))


_predicate("transmission_ad", AD, inh.autosomal_dominant)
_predicate("transmission_ar", AR, inh.autosomal_recessive)
_predicate("transmission_denovo", DENOVO, inh.de_novo)
_predicate("transmission_xr", XR, inh.x_recessive)
_predicate("transmission_xd", XD, inh.x_dominant)


@query("family_vector", f"""WITH {TRIO} SELECT site_id, family_id, n_members AS members,
 concat_ws(',', concat('Proband:', gt_p), CASE WHEN has_f THEN concat('FTH:', gt_f) END,
 CASE WHEN has_m THEN concat('MTH:', gt_m) END) AS vector FROM trio_z""", *TRIO_VIEWS)
def _(t):
    label = lambda m: F.concat(m["relation"], F.lit(":"), m["gt"])
    return called_families(t).select(
        "site_id", "family_id", F.size("members").cast("bigint").alias("members"),
        F.array_join(F.transform("members", label), ",").alias("vector"))


GENOTYPE_FAMILY = ("concat_ws(',', CASE WHEN has_f THEN concat('FTH:', gt_f) END, "
                   "CASE WHEN has_m THEN concat('MTH:', gt_m) END)")


@query("family_genotype_string", f"""WITH {TRIO} SELECT site_id, family_id, {GENOTYPE_FAMILY} AS genotype_family
FROM trio_z WHERE n_members > 1 AND zp IN ('HET', 'HOM')""", *TRIO_VIEWS)
def _(t):
    line = fam.after_proband(F.col("members"))
    return called_families(t).where(F.size("members") > 1).withColumn("line", line).where(
        g.is_carrier(F.col("line")[0]["gt"])).select(
        "site_id", "family_id", fam.genotype_string(F.col("line")).alias("genotype_family"))


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


ORIGIN = (f"CASE WHEN {GENOTYPE_FAMILY} IN ({_listed(g.FROM_FATHER)}) THEN 'FTH' "
          f"WHEN {GENOTYPE_FAMILY} IN ({_listed(g.FROM_MOTHER)}) THEN 'MTH' END")


@query("allele_origin", f"""WITH {TRIO} SELECT origin, count(*) AS families FROM (
 SELECT {ORIGIN} AS origin FROM trio_z WHERE n_members > 1 AND zp IN ('HET', 'HOM')) GROUP BY origin""", *TRIO_VIEWS)
def _(t):
    line = fam.after_proband(F.col("members"))
    carriers = called_families(t).where(F.size("members") > 1).withColumn("line", line).where(
        g.is_carrier(F.col("line")[0]["gt"]))
    return carriers.groupBy(g.allele_origin(fam.genotype_string(F.col("line"))).alias("origin")).agg(
        F.count(F.lit(1)).alias("families"))


@query("transmission_all", f"""WITH {TRIO} SELECT site_id, family_id, {GENOTYPE_FAMILY} AS genotype_family,
 {ORIGIN} AS origin, nullif(concat_ws(',',
 CASE WHEN chrom NOT IN ('chrX', 'chrY') AND {AD} THEN 'AD' END, CASE WHEN chrom NOT IN ('chrX', 'chrY') AND {AR} THEN 'AR' END,
 CASE WHEN chrom = 'chrX' AND {XD} THEN 'XD' END, CASE WHEN chrom = 'chrX' AND {XR} THEN 'XR' END,
 CASE WHEN {DENOVO} THEN 'DeNovo' END), '') AS transmission
FROM trio_z WHERE {PRIMARY} AND n_members > 1 AND zp IN ('HET', 'HOM')""", *TRIO_VIEWS)
def _(t):
    sites = _primary_sites(t).select("site_id", "chrom")
    called = called_families(t).join(sites, "site_id")
    found = fam.family_inheritance(called, k.contig(F.col("chrom")), ["site_id"])
    return found.withColumn("transmission", F.array_join("transmission", ","))
