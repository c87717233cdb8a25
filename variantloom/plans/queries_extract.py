"""Text sources, line-level evaluation, documents and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from variantloom.functions import genotype as g
from variantloom.operators import calls as c
from variantloom.functions import annotation as a
from variantloom.operators.cohort import donors, lab_members, sample_sheet
from variantloom.operators.grouping import unnest
from variantloom.plans import mutation_etl
from variantloom.plans.bridge import BUILD, EXTRACT_HEADER, SAMPLES, Inputs
from variantloom.plans.queries_annotations import KEPT_RECORDS
from variantloom.plans.queries_calls import AF, MUTATION, PRIMARY, counters, z
from variantloom.plans.registry import query
from variantloom.session import checkpoint_dir
from variantloom.sources import cohort as cohort_source, extract, sinks

LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
KEYS = ", ".join(LINE)
SHORT = "(l_linenumber % 2 = 1 AND (" + " OR ".join(f"g{i} = './.'" for i in range(SAMPLES)) + "))"
# one row per (line, sample) of the primary contigs
SAMPLE_ROWS = "smp AS (" + " UNION ALL ".join(
    f"""SELECT {KEYS}, chrom, filter, qd, {i} AS idx, g{i} AS gt, cast(r{i} AS bigint) AS ad_ref,
 cast(CASE WHEN {SHORT} AND g{i} = './.' THEN r{i} ELSE a{i} END AS bigint) AS ad_alt, q{i} AS gq
 FROM gx_line WHERE {PRIMARY}""" for i in range(SAMPLES)) + ")"


def parsed_lines(t: Inputs) -> DataFrame:
    return extract.parse_lines(t.lines(), EXTRACT_HEADER)


def _called(t: Inputs) -> DataFrame:
    return c.with_calls(parsed_lines(t))


@query("extract_lines_parse", f"""
SELECT {KEYS}, substr(chrom, 4) AS contig, pos, ref, replace(alt, ',<NON_REF>', '') AS alt, filter, qd,
 concat_ws(',', {', '.join(f'g{i}' for i in range(SAMPLES))}) AS gt,
 concat_ws(',', {', '.join(f'q{i}' for i in range(SAMPLES))}) AS gq FROM gx_line WHERE {PRIMARY}""", "gx_line")
def _(t):
    return parsed_lines(t).select(
        *LINE, "contig", "pos", "ref", "alt", "filter", "qd", F.array_join("gt", ",").alias("gt"),
        F.array_join("gq", ",").alias("gq"))


@query("line_calls", f"""WITH {SAMPLE_ROWS}
SELECT {KEYS}, idx, gt, {z()} AS zygosity, try_cast(gq AS bigint) AS gq, ad_ref, ad_alt, ad_ref + ad_alt AS ad_total,
 CASE WHEN ad_ref + ad_alt > 0 THEN cast(ad_alt AS double) / (ad_ref + ad_alt) ELSE 0.0 END AS ad_freq FROM smp""",
       "gx_line")
def _(t):
    return c.long_calls(_called(t), list(LINE))


@query("line_frequencies", f"""WITH {SAMPLE_ROWS},
tagged AS (SELECT {KEYS}, 'interne' AS lab, gt FROM smp
 UNION ALL SELECT {KEYS}, lab, gt FROM smp JOIN gx_sheet USING (idx))
SELECT *, {AF} FROM (SELECT {KEYS}, lab, {counters()} FROM tagged GROUP BY {KEYS}, lab)""", "gx_line", "gx_sheet")
def _(t):
    called = _called(t).withColumn("labs", lab_members(t.view("gx_sheet")))
    frequencies = F.map_concat(
        F.create_map(F.lit("interne"), c.line_frequency(F.col("calls"))),
        c.line_lab_frequencies(F.col("calls"), F.col("labs")))
    return called.select(*LINE, F.explode(frequencies).alias("lab", "f")).select(
        *LINE, "lab", *[F.col(f"f.{n}").alias(n.lower()) for n in ("AC", "AN", "HC", "PN", "AF")])



_FAMILY = "concat('FTH:', g1, ',MTH:', g2)"
_Z = {i: z(f"g{i}") for i in range(SAMPLES)}
_ORIGIN = (
    f"CASE WHEN {_FAMILY} IN ({', '.join(repr(v) for v in g.FROM_FATHER)}) THEN 'FTH' "
    f"WHEN {_FAMILY} IN ({', '.join(repr(v) for v in g.FROM_MOTHER)}) THEN 'MTH' END"
)
# sample 0: affected boy with unaffected father and affected mother; sample 4: affected girl behind her mother
_MODES_TRIO = f"""nullif(concat_ws(',',
 CASE WHEN chrom NOT IN ('chrX', 'chrY') AND {_Z[0]} = 'HET' AND {_Z[1]} NOT IN ('HET', 'HOM')
  AND {_Z[2]} IN ('HET', 'UNK') THEN 'AD' END,
 CASE WHEN chrom = 'chrX' AND {_Z[0]} IN ('HET', 'HOM') AND {_Z[1]} NOT IN ('HET', 'HOM') AND {_Z[2]} IN ('HOM', 'UNK')
  THEN 'XR' END,
 CASE WHEN {_Z[0]} = 'HET' AND {_Z[1]} IN ('HOM REF', 'UNK') AND {_Z[2]} = 'UNK' THEN 'DeNovo' END), '')"""
_MODES_ALONE = f"""nullif(concat_ws(',',
 CASE WHEN chrom NOT IN ('chrX', 'chrY') AND {_Z[4]} = 'HET' THEN 'AD' END,
 CASE WHEN chrom NOT IN ('chrX', 'chrY') AND {_Z[4]} = 'HOM' THEN 'AR' END,
 CASE WHEN chrom = 'chrX' AND {_Z[4]} = 'HET' THEN 'XD' END, CASE WHEN chrom = 'chrX' AND {_Z[4]} = 'HOM' THEN 'XR' END), '')"""


@query("line_donors", f"""WITH {SAMPLE_ROWS},
fam AS (SELECT {KEYS}, {_FAMILY} AS family, {_ORIGIN} AS origin, {_MODES_TRIO} AS trio, {_MODES_ALONE} AS alone FROM gx_line)
SELECT {KEYS}, specimen AS "specimenId", patient_id AS "patientId", family_id AS "familyId", relation, filter, gt,
 {z()} AS zygosity, try_cast(gq AS bigint) AS gq, try_cast(qd AS double) AS qd, ad_alt AS "adAlt", ad_ref + ad_alt AS "adTotal",
 CASE WHEN ad_ref + ad_alt > 0 THEN cast(ad_alt AS double) / (ad_ref + ad_alt) ELSE 0.0 END AS "adFreq",
 CASE WHEN idx = 0 THEN family END AS "genotypeFamily", CASE WHEN idx = 0 THEN origin END AS origin,
 CASE idx WHEN 0 THEN trio WHEN 4 THEN alone END AS transmission
FROM smp JOIN gx_sheet USING (idx) JOIN fam USING ({KEYS}) WHERE {z()} IN ('HET', 'HOM')""", "gx_line", "gx_sheet")
def _(t):
    called = _called(t).withColumn("sheet", sample_sheet(t.view("gx_sheet")))
    rows = donors(
        F.col("calls"), F.col("sheet"), F.col("contig"), F.col("filter"), c.quality_by_depth(F.col("qd")),
        F.lit("2020-03-24").cast("date"))
    return unnest(called, LINE, rows, "idx").select(
        *LINE, "specimenId", "patientId", "familyId", "relation", "filter", "gt", "zygosity", "gq", "qd", "adAlt",
        "adTotal", "adFreq", "genotypeFamily", "origin", F.array_join("transmission", ",").alias("transmission"))


# ---- text sources -------------------------------------------------------------------------------

@query("sample_list", """
SELECT o_orderkey, 0 AS idx, concat('SP', cast(o_custkey AS string)) AS specimen FROM orders
UNION ALL SELECT o_orderkey, 1, concat('SP', cast(o_orderkey AS string)) FROM orders
UNION ALL SELECT o_orderkey, 2, concat('SP', o_orderstatus) FROM orders WHERE o_orderkey % 2 = 0""")
def _(t):
    head = "concat_ws('\t', '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', "
    names = "cast(o_custkey AS string), concat('SP', o_orderkey)"
    rows = t.table("orders").selectExpr(
        "o_orderkey", f"CASE WHEN o_orderkey % 2 = 0 THEN {head}{names}, o_orderstatus) ELSE {head}{names}) END AS value")
    return extract.sample_list(rows)


@query("ped_parse", """
SELECT specimen, concat('FA', cast(family_id AS string)) AS family_id, concat('SP', cast(specimen AS string)) AS id,
 CASE WHEN member = 0 THEN concat('SP', cast(specimen + 1 AS string)) ELSE '0' END AS paternal_id,
 CASE WHEN member = 0 THEN concat('SP', cast(specimen + 2 AS string)) ELSE '0' END AS maternal_id, sex, phenotype
FROM gx_ped""", "gx_ped")
def _(t):
    lines = t.view("gx_ped").selectExpr("specimen", """
        concat_ws(CASE specimen % 3 WHEN 0 THEN '\t' WHEN 1 THEN ' ' ELSE '   ' END, concat('FA', family_id),
          concat('SP', specimen), CASE WHEN member = 0 THEN concat('SP', specimen + 1) ELSE '0' END,
          CASE WHEN member = 0 THEN concat('SP', specimen + 2) ELSE '0' END, sex, phenotype) AS value""")
    return cohort_source.parse_pedigree(lines)


@query("properties_slices", """
SELECT cast(o_orderkey AS string) AS owner, 0 AS pos, concat('SP', cast(o_custkey AS string), 'a') AS specimen,
 'Proband' AS relation, true AS "isProband", concat_ws(',', 'h0', CASE WHEN o_orderkey % 2 = 1 THEN 'h1' END) AS hpo,
 'p1,p2' AS patients, 's1,s2' AS specimens FROM orders
UNION ALL SELECT cast(o_orderkey AS string), 1, concat('SP', cast(o_custkey AS string), 'b'), 'MTH', false, '', '', '' FROM orders
UNION ALL SELECT cast(o_orderkey AS string), 2, concat('SP', cast(o_custkey AS string), 'c'), 'FTH', false,
 CASE WHEN o_orderkey % 2 = 1 THEN 'h2' ELSE 'h1' END, 'p3', 's3' FROM orders""")
def _(t):
    constant = lambda text: F.lit(text)
    entries = {
        "specimen": F.expr("concat('SP', o_custkey, 'a,SP', o_custkey, 'b,SP', o_custkey, 'c')"),
        "relation": constant("Proband,MTH,FTH"), "patientId": constant("A,B,C"), "familyId": constant("F,F,F"),
        "studyId": constant("E,E,E"), "gender": constant("female,female,male"), "organizationId": constant("O,O,O"),
        "laboName": constant("L,L,L"), "isProban": constant("true,false,false"),
        "isAffected": constant("true,false,false"), "practitionerId": constant("R,R,R"),
        "HpoQtyTerms": F.expr("concat(1 + o_orderkey % 2, ',0,1')"), "hpoTermsPos": constant("h0,h1,h2,."),
        "linkQty": constant("2,0,1"), "linkPatient": constant("p1,p2,p3,."), "linkSpecimen": constant("s1,s2,s3,."),
        "sequencingStrategy": constant("WXS"), "assemblyVersion": constant(BUILD), "annotationTool": constant("VEP"),
    }
    rows = t.table("orders").select(
        F.col("o_orderkey").cast("string").alias("owner"),
        F.inline(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries.items()])))
    return cohort_source.parse_properties(rows).select(
        "owner", "pos", "specimen", "relation", "isProband", F.array_join("hpo_terms", ",").alias("hpo"),
        F.array_join("linked_patients", ",").alias("patients"), F.array_join("linked_specimens", ",").alias("specimens"))


# ---- documents and sinks ------------------------------------------------------------------------

def documents(t: Inputs) -> DataFrame:
    rows = extract.with_keys(parsed_lines(t), BUILD)
    staging = f"{checkpoint_dir(t.spark)}/documents-{uuid.uuid4().hex}"
    return mutation_etl.staged_documents(
        rows, t.view("gx_sheet"), t.view("gx_members"), F.lit("2020-03-24").cast("date"), staging, BUILD, "VEP 97", LINE)


# lines of one variant in order; of each line the carriers, and whether it brings one that no earlier line has
_REPEATS = f"""lines AS (SELECT *, {MUTATION} AS mutation_id,
 row_number() OVER (PARTITION BY {MUTATION} ORDER BY {KEYS}) AS rn FROM gx_line WHERE {PRIMARY}),
uniq AS (SELECT * FROM lines WHERE rn = 1),
carried AS (SELECT mutation_id, {" + ".join(f"max(cast({_Z[i]} IN ('HET', 'HOM') AS int))" for i in range(SAMPLES))} AS donors
 FROM lines GROUP BY mutation_id)"""


@query("mutation_documents", f"""WITH {_REPEATS}, {KEPT_RECORDS},
ann AS (SELECT {KEYS}, count(DISTINCT concat_ws('/', symbol, aa_change, consequence, cdna_change, strand)) AS consequences,
 max(score) AS score, count(DISTINCT CASE WHEN gene_id IS NOT NULL AND symbol <> '' THEN concat(gene_id, symbol) END) AS genes
 FROM rec GROUP BY {KEYS})
SELECT upper(md5(concat(mutation_id, '@GRCh38'))) AS uid, mutation_id AS "mutationId", coalesce(score, 0) AS "impactScore",
 donors, coalesce(consequences, 0) AS consequences, coalesce(genes, 0) AS genes
FROM uniq JOIN carried USING (mutation_id) LEFT JOIN ann USING ({KEYS})""", "gx_line")
def _(t):
    length = lambda column: F.coalesce(F.size(column), F.lit(0)).cast("bigint")
    return documents(t).select(
        "uid", "mutationId", "impactScore", length("donors").alias("donors"),
        length("consequences").alias("consequences"), length("genes").alias("genes"))


_CARRIES = {i: f"cast({_Z[i]} IN ('HET', 'HOM') AS int)" for i in range(SAMPLES)}
_EARLIER = "OVER (PARTITION BY mutation_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_NEW = " OR ".join(f"({_CARRIES[i]} = 1 AND coalesce(max({_CARRIES[i]}) {_EARLIER}, 0) = 0)" for i in range(SAMPLES))


@query("mutation_repeated_keys", f"""WITH {_REPEATS}, {SAMPLE_ROWS},
judged AS (SELECT *, rn = 1 OR {_NEW} AS counts FROM lines),
tagged AS (SELECT {KEYS}, 'interne' AS lab, gt FROM smp UNION ALL SELECT {KEYS}, lab, gt FROM smp JOIN gx_sheet USING (idx)),
per_line AS (SELECT {KEYS}, lab, {counters()} FROM tagged GROUP BY {KEYS}, lab),
summed AS (SELECT mutation_id, lab, count(*) AS lines, cast(sum(ac) AS bigint) AS ac, cast(sum(an) AS bigint) AS an,
  cast(sum(hc) AS bigint) AS hc, cast(sum(pn) AS bigint) AS pn
 FROM judged JOIN per_line USING ({KEYS}) WHERE counts GROUP BY mutation_id, lab)
SELECT mutation_id AS "mutationId", lab, ac, an, hc, pn, {AF}, donors FROM summed JOIN carried USING (mutation_id)
""", "gx_line", "gx_sheet")
def _(t):
    """Lines that share a variant: the donors of all, the counters of those that bring a new one."""
    found = documents(t).select("mutationId", F.size("donors").alias("donors"), F.explode("frequencies").alias("lab", "f"))
    return found.where(~F.col("lab").isin(*a.POPULATIONS)).select(
        "mutationId", "lab", *[F.col(f"f.{n}").alias(n.lower()) for n in ("AC", "AN", "HC", "PN", "AF")], "donors")


@query("mutation_documents_json", f"""WITH {_REPEATS}, {KEPT_RECORDS},
ann AS (SELECT {KEYS}, max(score) AS score FROM rec GROUP BY {KEYS})
SELECT upper(md5(concat(mutation_id, '@GRCh38'))) AS uid, mutation_id AS "mutationId", coalesce(score, 0) AS "impactScore",
 substr(chrom, 4) AS chrom, pos AS start, ref AS "refAllele", replace(alt, ',<NON_REF>', '') AS "altAllele", donors
FROM uniq JOIN carried USING (mutation_id) LEFT JOIN ann USING ({KEYS})""", "gx_line")
def _(t):
    """The documents as JSON text, read back."""
    schema = ("mutationId string, impactScore int, chrom string, start bigint, refAllele string, altAllele string, "
              "donors array<struct<specimenId: string>>")
    read = sinks.documents_as_json(documents(t)).select("uid", F.from_json("document", schema).alias("d"))
    return read.select("uid", "d.*").withColumn("donors", F.coalesce(F.size("donors"), F.lit(0)).cast("bigint"))


@query("sink_roundtrip", f"""
SELECT *, {AF} FROM (SELECT site_id, {counters()} FROM gx_calls GROUP BY site_id)""", "gx_calls")
def _(t):
    from variantloom.plans.queries_calls import cohort_frequency

    path = f"{checkpoint_dir(t.spark)}/roundtrip-{uuid.uuid4().hex}"
    sinks.write_table(cohort_frequency(t), path)
    return sinks.read_table(t.spark, path)
