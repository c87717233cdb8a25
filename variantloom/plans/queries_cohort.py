"""The composed cohort, extracts of several files, and the load validation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from variantloom.operators import clinical
from variantloom.plans import other_jobs
from variantloom.plans.bridge import BUILD, EXTRACT_HEADER, RECORDS, SAMPLES, Inputs
from variantloom.plans.queries_calls import MUTATION, PRIMARY
from variantloom.plans.registry import query
from variantloom.session import checkpoint_dir
from variantloom.sources import extract


def _composed(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Sample columns, pedigree and properties from the customers, beside their patient documents."""
    people = t.table("customer")
    key = F.col("c_custkey")
    cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    name = F.when(key % 10 == 9, cat("SPX", key)).otherwise(cat("SP", key, "A"))
    samples = people.select(key.alias("idx"), name.alias("specimen")).unionByName(
        people.where(key % 7 == 0).select((key + 10_000_000).alias("idx"), F.lower(name).alias("specimen")))
    relative = lambda step: F.when(key % 3 == 0, cat("sp", key + step, "a")).otherwise(F.lit("0"))
    pedigree = people.where(key % 11 != 5).select(
        cat("FA", F.floor(key / 3)).alias("family_id"), F.lower(name).alias("id"), relative(1).alias("paternal_id"),
        relative(2).alias("maternal_id"), F.when(key % 2 == 0, "2").otherwise("1").alias("sex"),
        F.when(key % 5 == 0, "HP:0000268").otherwise("1").alias("phenotype"))
    properties = people.where(key % 20 != 19).select(
        name.alias("specimen"), cat("PP", key).alias("patientId"), F.lit("EP").alias("studyId"), F.lit("RP").alias("practitionerId"),
        F.lit("OP").alias("organizationId"), F.lit("WXS").alias("sequencingStrategy"), F.lit("LP").alias("laboName"),
        F.lit("SIS").alias("relation"), F.array(cat("term ", key)).alias("hpo_terms"))
    return clinical.composed_sheet(samples, pedigree, t.patient_documents(), properties)


_PEOPLE = """people AS (SELECT c_custkey AS key, c_nationkey AS nation, c_mktsegment AS segment,
 CASE WHEN c_custkey % 10 = 9 THEN concat('SPX', cast(c_custkey AS string)) ELSE concat('SP', cast(c_custkey AS string), 'A') END AS name
 FROM customer)"""


@query("sample_sheet_build", f"""WITH {_PEOPLE}
SELECT p.key AS idx, p.name AS specimen, concat('FA', cast(floor(p.key / 3) AS bigint)) AS family_id,
 CASE WHEN p.key % 10 = 9 THEN 'SIS' WHEN p.key % 3 = 0 THEN 'Proband'
  WHEN l.key IS NOT NULL THEN CASE WHEN p.key % 3 = 1 THEN 'FTH' ELSE 'MTH' END ELSE 'SIS' END AS relation,
 CASE WHEN p.key % 2 = 0 THEN '2' ELSE '1' END AS sex, CASE WHEN p.key % 5 = 0 THEN 'HP:0000268' ELSE '1' END AS phenotype,
 CASE WHEN p.key % 10 = 9 THEN 'LP' ELSE substr(p.segment, 1, 3) END AS lab,
 CASE WHEN p.key % 10 = 9 THEN concat('PP', cast(p.key AS string)) ELSE concat('PA', cast(p.key AS string)) END AS patient_id,
 CASE WHEN p.key % 10 = 9 THEN 'EP' ELSE concat('ET', cast(p.nation AS string)) END AS study_id,
 CASE WHEN p.key % 10 = 9 THEN 'RP' WHEN p.key % 5 = 0 THEN concat('P', cast(p.key % 11 AS string))
  ELSE concat('AS', cast(p.key % 17 AS string)) END AS practitioner_id,
 CASE WHEN p.key % 10 = 9 THEN 'OP' WHEN p.key % 5 = 0 THEN concat('OR', cast(p.key % 13 AS string))
  ELSE concat('OR', cast(p.key % 7 AS string)) END AS organization_id,
 CASE WHEN p.key % 10 = 9 THEN 'properties' ELSE 'document' END AS origin
FROM people p LEFT JOIN people l ON l.key = p.key - p.key % 3
WHERE p.key % 11 <> 5 AND p.key % 20 <> 19""")
def _(t):
    return _composed(t)[0].select(
        "idx", "specimen", "family_id", "relation", "sex", "phenotype", "lab", "patient_id", "study_id", "practitioner_id",
        "organization_id", "origin")


@query("sample_rejects", f"""WITH {_PEOPLE}
SELECT key + 10000000 AS idx, lower(name) AS specimen, 'listed again' AS reason FROM people WHERE key % 7 = 0
UNION ALL SELECT key, name, CASE WHEN key % 20 = 19 THEN 'no patient' ELSE 'no pedigree' END FROM people
WHERE key % 20 = 19 OR key % 11 = 5""")
def _(t):
    return _composed(t)[1]


#: Lines of an extract file, about, where there are many.
FILE_LINES = 500_000


def written_extracts(t: Inputs) -> str:
    """The extract lines as compressed files, half of them with another order of columns, each file with its header."""
    root = f"{checkpoint_dir(t.spark)}/extracts-{uuid.uuid4().hex}"
    files = max(4, t.table("lineitem").count() // 2 // FILE_LINES)
    cells = t.lines().select("l_linenumber", F.split("value", "\t").alias("c"))
    for part, order in enumerate((EXTRACT_HEADER, EXTRACT_HEADER[:1] + EXTRACT_HEADER[:0:-1])):
        rows = cells.where(F.col("l_linenumber") % 2 == part).select(*[F.col("c")[EXTRACT_HEADER.index(n)].alias(n) for n in order])
        rows.coalesce(files).write.csv(f"{root}/part={part}", sep="\t", header=True, quote="", compression="gzip")
    return f"{root}/part=*"


@query("extract_many_headers", f"""
SELECT upper(md5(concat({MUTATION}, '@{BUILD}'))) AS uid, substr(chrom, 4) AS contig, pos, ref, replace(alt, ',<NON_REF>', '') AS alt,
 filter, qd, concat_ws(',', {', '.join(f'g{i}' for i in range(SAMPLES))}) AS gt,
 concat_ws(',', {', '.join(f'q{i}' for i in range(SAMPLES))}) AS gq FROM gx_line WHERE {PRIMARY}""", "gx_line")
def _(t):
    return extract.read_extract(t.spark, written_extracts(t), BUILD).select(
        "uid", "contig", "pos", "ref", "alt", "filter", "qd", F.array_join("gt", ",").alias("gt"), F.array_join("gq", ",").alias("gq"))


_CHECKED = f"""lines AS (SELECT l_linenumber, {MUTATION} AS mutation_id, CASE WHEN NOT ({PRIMARY}) THEN 'discarded'
 WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'error' END AS status FROM gx_line),
kept AS (SELECT mutation_id, upper(md5(concat(mutation_id, '@{BUILD}'))) AS uid, l_linenumber FROM lines WHERE status IS NULL),
stored AS (SELECT DISTINCT uid, CASE WHEN uid < '4' THEN concat(mutation_id, '+') WHEN uid < '8' THEN lower(mutation_id)
 ELSE mutation_id END AS stored FROM kept WHERE l_linenumber <> 3)"""


def _checked(t: Inputs) -> dict[str, DataFrame]:
    """The lines, some with a position that is no number, against most of their variants, some stored under another id."""
    broken = F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.regexp_replace("value", "^([^\t]*)\t[^\t]*", "$1\tx"))
    lines = t.lines("l_returnflag").withColumn("value", F.coalesce(broken, "value"))
    rows = extract.with_keys(extract.parse_lines(lines, EXTRACT_HEADER, primary_only=False), BUILD)
    stored = rows.where((F.length("contig") <= 2) & F.col("pos").isNotNull() & (F.col("l_linenumber") != 3)).select(
        "uid", F.when(F.col("uid") < "4", F.concat("mutation_id", F.lit("+"))).when(F.col("uid") < "8", F.lower("mutation_id"))
        .otherwise(F.col("mutation_id")).alias("mutationId")).distinct()
    return other_jobs.load_check(rows, stored)


@query("validation_job", f"""WITH {_CHECKED}
SELECT (SELECT count(*) FROM lines) AS processed, count(CASE WHEN stored IS NOT NULL THEN 1 END) AS found,
 count(CASE WHEN stored IS NULL THEN 1 END) AS not_found, (SELECT count(*) FROM lines WHERE status = 'discarded') AS discarded,
 (SELECT count(*) FROM lines WHERE status = 'error') AS errors, (SELECT count(*) * {RECORDS} FROM lines) AS annotations,
 (SELECT count(*) FROM lines) AS total, CASE WHEN count(CASE WHEN stored IS NULL THEN 1 END) = 0 THEN 'passed' ELSE 'failed' END AS verdict,
 {RECORDS}.0::DOUBLE AS average
FROM kept LEFT JOIN stored USING (uid)""", "gx_line")
def _(t):
    return _checked(t)["statistics"]


@query("state_collisions", f"""WITH {_CHECKED}
SELECT uid, count(*) AS n, min(mutation_id) AS mutation_id, min(stored) AS stored FROM kept JOIN stored USING (uid)
WHERE lower(stored) <> lower(mutation_id) GROUP BY uid""", "gx_line")
def _(t):
    return _checked(t)["collisions"]
