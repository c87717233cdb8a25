"""Patient documents, pedigrees, phenotype terms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from variantloom.functions.genotype import CARRIER, is_affected, zygosity
from variantloom.operators import clinical as cl, genes as gn, search as se
from variantloom.plans.bridge import Inputs
from variantloom.plans.queries_calls import z
from variantloom.plans.registry import query
from variantloom.session import checkpoint_dir
from variantloom.sources.cohort import read_patients


def _wanted_samples(t: Inputs) -> DataFrame:
    """Samples the orders ask for: one of the two samples of their customer."""
    letter = F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("B")
    return t.table("orders").select(F.concat(F.lit("SP"), F.col("o_custkey"), letter).alias("specimen")).distinct()


WANTED = """wanted AS (SELECT DISTINCT o_custkey AS k, o_orderkey % 2 = 0 AS a,
 concat('SP', cast(o_custkey AS string), CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END) AS specimen FROM orders)"""


@query("patient_by_id", """
SELECT concat('PA', cast(c_custkey AS string)) AS id, concat('FA', cast(c_custkey // 3 AS string)) AS "familyId",
 CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def _(t):
    wanted = t.table("orders").select(F.concat(F.lit("PA"), F.col("o_custkey")).alias("id"))
    return cl.document_by_id(t.patient_documents(), wanted).select("id", "familyId", "gender")


@query("patient_search_top1", f"""WITH {WANTED}
SELECT specimen, concat('PA', cast(k AS string)) AS id FROM wanted JOIN customer ON c_custkey = k""")
def _(t):
    return cl.documents_of_samples(t.patient_documents(), _wanted_samples(t)).select("specimen", "id")


#: The texts of a patient document, lists joined by a space.
PATIENT_TEXT = """concat_ws(' ', concat('PA', k), concat('FA', k // 3), CASE WHEN k % 2 = 0 THEN 'female' ELSE 'male' END, concat('ET', n),
 concat('SP', k, 'A SP', k, 'B WXS WGS'), concat('PR', n, ' PR', n, ' ci', k, 'A ci', k, 'B OR', n, ' OR', n), m, m,
 substr(m, 1, 3), concat('L', n % 4), CASE WHEN k % 5 <> 0 THEN concat('CI', k, 'A CI', k, 'B AS', k % 17, ' AS', k % 17, ' OR', k % 7,
 ' OR', k % 7, ' ROLE', k % 11, ' ROLE', k % 11, ' POS NEG ', CASE WHEN k % 2 = 0 THEN 'POS' ELSE 'NEG' END, ' HP ', lpad(cast(k AS string), 9, '0'),
 ' HP ', lpad(cast(k + 1 AS string), 9, '0'), ' HP ', lpad(cast(k + 2 AS string), 9, '0'), ' HP ', lpad(cast(k + 3 AS string), 9, '0'),
 ' term ', k, ' term ', k + 1, ' term ', k + 2, ' term ', k + 3) END, concat('ROLE', k % 11), concat('P0 P', k % 11, ' OTHER role', k % 11,
 ' OR0 OR', k % 13), CASE WHEN k % 3 = 0 THEN concat('PA', k + 1, ' PA', k + 2, ' FTH MTH') END)"""
#: What is asked for: a sample, a family, a phenotype, a patient, or words that half of all documents have.
ASKED = """CASE WHEN k % 7 = 0 THEN 'Female, WGS!' WHEN k % 4 = 0 THEN concat('sP', k, 'a (Wxs)') WHEN k % 4 = 1
 THEN concat('family fa', cast(floor(k / 3) AS bigint), ' FEMALE') WHEN k % 4 = 2 THEN concat('HP:', lpad(cast(k AS string), 9, '0'), ' term')
 ELSE concat('pa', k, '/', 'machinery automobile') END"""


@query("patient_text_search", f"""WITH docs AS (
 SELECT concat('PA', k) AS id, {PATIENT_TEXT} AS body FROM (SELECT c_custkey AS k, c_nationkey AS n, c_mktsegment AS m FROM customer)),
tf AS (SELECT id, token, count(*) AS f FROM (SELECT id, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS token FROM docs) GROUP BY id, token),
weights AS (SELECT token, cast(round(1000 * ln(1 + (SELECT count(*) FROM docs) / count(*))) AS bigint) AS w FROM tf GROUP BY token),
asked AS (SELECT DISTINCT k, {ASKED} AS body FROM (SELECT o_custkey AS k FROM orders)),
wanted AS (SELECT DISTINCT body, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS token FROM asked),
scored AS (SELECT body, id, cast(sum((2 * w * f) // (f + 1)) AS bigint) AS score FROM wanted JOIN weights USING (token) JOIN tf USING (token) GROUP BY body, id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY score DESC, id) AS place FROM scored)
SELECT k AS asked, place AS hit, id, score FROM asked JOIN ranked USING (body) WHERE place <= 2""")
def _(t):
    root = f"{checkpoint_dir(t.spark)}/search-{uuid.uuid4().hex}"
    t.patient_documents().write.json(f"{root}/patients")
    se.write_index(read_patients(t.spark, f"{root}/patients"), "id", root)
    asked = t.table("orders").select(F.col("o_custkey").alias("k")).distinct().selectExpr("k", f"{ASKED} AS body")
    return se.search(root, asked, "k", "body", 2).select(
        F.col("query").alias("asked"), F.col("rank").cast("bigint").alias("hit"), F.col("document").alias("id"), "score")


@query("patient_hpo_terms", """
SELECT concat('PA', cast(k AS string)) AS id, CASE WHEN k % 5 = 0 THEN '' ELSE concat_ws(',',
 concat('term ', k, ' (HP:', lpad(cast(k AS string), 9, '0'), ')'),
 concat('term ', k + 1, ' (HP:', lpad(cast(k + 1 AS string), 9, '0'), ')'),
 CASE WHEN k % 2 = 0 THEN concat('term ', k + 3, ' (HP:', lpad(cast(k + 3 AS string), 9, '0'), ')') END) END AS terms
FROM (SELECT c_custkey AS k FROM customer)""")
def _(t):
    return t.patient_documents().select(
        "id", F.array_join(cl.hpo_terms(F.col("clinicalImpressions")), ",").alias("terms"))


@query("patient_request_lookup", f"""WITH {WANTED}
SELECT specimen, concat('PA', k) AS patient_id, concat('ET', c_nationkey) AS study_id,
 CASE WHEN k % 3 = 0 THEN 'Proband' END AS relation, k % 3 = 0 OR k % 4 = 1 AS affected,
 CASE WHEN a THEN 'WXS' ELSE 'WGS' END AS strategy, concat('PR', c_nationkey) AS requester_id,
 concat('OR', c_nationkey) AS requester_org_id, c_mktsegment AS lab_name,
 CASE WHEN a THEN substr(c_mktsegment, 1, 3) ELSE concat('L', c_nationkey % 4) END AS lab,
 CASE WHEN k % 5 = 0 THEN concat('P', k % 11) ELSE concat('AS', k % 17) END AS practitioner_id,
 CASE WHEN k % 5 = 0 THEN concat('OR', k % 13) ELSE concat('OR', k % 7) END AS organization_id
FROM wanted JOIN customer ON c_custkey = k""")
def _(t):
    found = cl.documents_of_samples(t.patient_documents(), _wanted_samples(t))
    return cl.patient_attributes(found).select(
        "specimen", "patient_id", "study_id", "relation", "affected", "strategy", "requester_id", "requester_org_id",
        "lab_name", "lab", "practitioner_id", "organization_id")


def _links(t: Inputs) -> DataFrame:
    return cl.linked_relatives(t.patient_documents())


def _patients(t: Inputs) -> DataFrame:
    documents = t.patient_documents()
    return documents.select(
        F.col("id").alias("patient_id"), F.get("serviceRequests", F.lit(0))["specimen"][0]["id"].alias("specimen"),
        F.when(F.col("isProband"), "Proband").alias("relation"))


@query("proband_links", """
SELECT concat('PA', p.k) AS proband_id, string_agg(concat('PA', r.k), ',' ORDER BY concat('PA', r.k)) AS patients,
 string_agg(concat('SP', r.k, 'A'), ',' ORDER BY concat('SP', r.k, 'A')) AS specimens
FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0) p
JOIN (SELECT c_custkey AS k FROM customer) r ON r.k IN (p.k + 1, p.k + 2) GROUP BY p.k""")
def _(t):
    return cl.proband_links(_links(t), _patients(t)).select(
        "proband_id", F.array_join("linked_patients", ",").alias("patients"),
        F.array_join("linked_specimens", ",").alias("specimens"))


@query("patient_relations", """
SELECT concat('PA', c_custkey) AS patient_id,
 CASE c_custkey % 3 WHEN 0 THEN 'Proband' WHEN 1 THEN 'FTH' ELSE 'MTH' END AS relation FROM customer""")
def _(t):
    return cl.with_relations(_patients(t), _links(t)).select("patient_id", "relation")


def _terms(t: Inputs) -> DataFrame:
    patients = t.view("gx_patients").select("specimen", F.array("hpo_a", "hpo_b").alias("codes"))
    return cl.affected_terms(patients, t.view("gx_ped"), "specimen", "codes")


def _gene_terms(t: Inputs) -> DataFrame:
    hpo = t.view("gx_members").where(F.col("member").startswith("HP:"))
    return hpo.select("ensembl_id", gn.hpo_code(F.col("member")).alias("code"))


MATCHES = """terms AS (SELECT specimen, code FROM (
 SELECT specimen, hpo_a AS code FROM gx_patients UNION SELECT specimen, hpo_b FROM gx_patients
 UNION SELECT specimen, phenotype FROM gx_ped WHERE length(phenotype) > 2) JOIN gx_ped USING (specimen) WHERE phenotype <> '1'),
hits AS (SELECT specimen, cast(count(*) AS bigint) AS matches FROM terms
 JOIN (SELECT DISTINCT ensembl_id, string_split(member, ',')[1] AS code FROM gx_members WHERE member LIKE 'HP:%') g USING (code)
 GROUP BY specimen)"""


@query("hpo_match_count", f"WITH {MATCHES} SELECT * FROM hits", "gx_patients", "gx_ped", "gx_members")
def hpo_match_count(t):
    return cl.hpo_matches(_gene_terms(t), _terms(t), "ensembl_id", "specimen", "code")


@query("hpo_match_per_variant", f"""WITH {MATCHES}
SELECT site_id, specimen, cast(count(*) AS bigint) AS matches
FROM (SELECT DISTINCT site_id, specimen FROM gx_calls WHERE {z()} IN ('HET', 'HOM')) JOIN terms USING (specimen)
JOIN (SELECT DISTINCT site_id, gene_id AS ensembl_id FROM gx_ann) USING (site_id)
JOIN (SELECT DISTINCT ensembl_id, string_split(member, ',')[1] AS code FROM gx_members WHERE member LIKE 'HP:%') g
 USING (ensembl_id, code) GROUP BY site_id, specimen""", "gx_patients", "gx_ped", "gx_members", "gx_calls", "gx_ann")
def _(t):
    carriers = t.view("gx_calls").where(zygosity(F.col("gt")).isin(*CARRIER))
    genes = t.view("gx_ann").select("site_id", F.col("gene_id").alias("ensembl_id"))
    return cl.hpo_matches_per_variant(
        carriers, genes, _gene_terms(t), _terms(t), "site_id", "ensembl_id", "specimen", "code")


@query("donor_phenotypes", f"""WITH {MATCHES}
SELECT specimen, CASE WHEN phenotype <> '1' AND coalesce(matches, 0) > 0 THEN concat_ws(',', hpo_a, hpo_b,
 CASE WHEN length(phenotype) > 2 THEN phenotype END) END AS phenotypes
FROM gx_patients JOIN gx_ped USING (specimen) LEFT JOIN hits USING (specimen)""", "gx_patients", "gx_ped", "gx_members")
def _(t):
    rows = t.view("gx_patients").join(t.view("gx_ped"), "specimen").join(hpo_match_count(t), "specimen", "left")
    terms = cl.donor_phenotypes(
        F.array("hpo_a", "hpo_b"), F.col("phenotype"), is_affected(F.col("phenotype")),
        F.coalesce("matches", F.lit(0)))
    return rows.select("specimen", F.array_join(terms, ",").alias("phenotypes"))


# ---- samples against pedigree and patients ------------------------------------------------------

def _samples(t: Inputs) -> DataFrame:
    key = F.col("c_custkey")
    return t.table("customer").select(key.alias("idx"), F.concat(F.lit("SP"), key).alias("specimen"))


def _ped(t: Inputs) -> DataFrame:
    return t.view("gx_ped").select(
        F.concat(F.lit("sp"), F.col("specimen")).alias("id"), "family_id", "sex", "phenotype")


@query("sample_pedigree", """
SELECT c_custkey AS idx, family_id, sex, phenotype FROM customer JOIN gx_ped ON specimen = c_custkey""", "gx_ped")
def _(t):
    return cl.by_pedigree_id(_samples(t), _ped(t), "specimen", "id").select("idx", "family_id", "sex", "phenotype")


@query("missing_pedigree", """
SELECT concat('SP', c_custkey) AS specimen FROM customer WHERE c_custkey NOT IN (SELECT specimen FROM gx_ped)""", "gx_ped")
def _(t):
    known = _ped(t).select(F.upper("id").alias("specimen"))
    return cl.missing_from(_samples(t), known, "specimen").select("specimen")


@query("required_pedigree", """
SELECT specimen, count(*) AS sites FROM gx_calls JOIN gx_ped USING (specimen) GROUP BY specimen""", "gx_calls", "gx_ped")
def _(t):
    calls = t.view("gx_calls").groupBy("specimen").agg(F.count(F.lit(1)).alias("sites"))
    ped = t.view("gx_ped").select(F.col("specimen").alias("id"))
    return cl.require_pedigree(calls, ped, "specimen", "id").select("specimen", "sites")


@query("missing_patient", """
SELECT c_custkey AS idx FROM customer WHERE c_custkey IN (SELECT specimen FROM gx_patients)""", "gx_patients")
def _(t):
    patients = t.view("gx_patients").select(F.concat(F.lit("SP"), F.col("specimen")).alias("specimen"))
    return cl.known_samples(_samples(t), patients, "specimen").select("idx")


@query("pedigree_patients", """
SELECT family_id, specimen, patient_id, lab, relation FROM gx_ped JOIN gx_patients USING (specimen)""",
       "gx_ped", "gx_patients")
def _(t):
    return t.view("gx_ped").join(t.view("gx_patients"), "specimen").select(
        "family_id", "specimen", "patient_id", "lab", "relation")
