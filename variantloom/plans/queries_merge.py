"""Batch merges, ranked reports, validation, older extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from variantloom.functions import annotation as a
from variantloom.functions.genotype import is_carrier
from variantloom.functions.keys import is_primary_contig
from variantloom.operators import exomiser as ex, frequency as fr, legacy as lg, merge as m, validation as va
from variantloom.operators.documents import split_genes
from variantloom.operators.grouping import unnest
from variantloom.plans.bridge import BUILD, Inputs
from variantloom.plans.queries_annotations import KEPT_RECORDS, annotated
from variantloom.plans.queries_calls import AF, MUTATION, PRIMARY, counters, z
from variantloom.plans.queries_extract import KEYS, LINE, parsed_lines
from variantloom.plans.registry import query
from variantloom.sources import extract, knowledge

BATCH_VIEWS = ("gx_calls", "gx_batches")


def _batch(t: Inputs, number: int) -> DataFrame:
    return t.view("gx_batches").where(F.col("batch") == number)


def _carriers(calls: DataFrame, key: str = "site_id") -> DataFrame:
    return calls.where(is_carrier(F.col("gt"))).select(key, "specimen", "gt")


def _touched(t: Inputs, key: str = "site_id", of=lambda calls: calls) -> DataFrame:
    one, two = (_carriers(of(_batch(t, n)), key) for n in (1, 2))
    return m.touched_keys(one, two, key, "specimen")


def _merge_sql(key: str, source: str, extra: str = "") -> str:
    """Counters of two batches merged by the any-new-donor rule; ``extra`` is a comma-led sub-key."""
    sub = extra.lstrip(", ")
    same = f"o.{key} = n.{key}" + (f" AND o.{sub} = n.{sub}" if sub else "")
    keep = (f"o.{key} IS NOT NULL OR t.{key} IS NOT NULL OR coalesce(o.{key}, n.{key}) NOT IN (SELECT {key} FROM o)"
            if sub else "true")
    pick = lambda c: (f"CASE WHEN o.{key} IS NULL THEN n.{c} WHEN n.{key} IS NOT NULL AND t.{key} IS NOT NULL "
                      f"THEN o.{c} + n.{c} ELSE o.{c} END AS {c}")
    shown = f", coalesce(o.{sub}, n.{sub}) AS {sub}" if sub else ""
    return f"""
o AS (SELECT {key}{extra}, {counters()} FROM {source} WHERE batch = 1 GROUP BY {key}{extra}),
n AS (SELECT {key}{extra}, {counters()} FROM {source} WHERE batch = 2 GROUP BY {key}{extra}),
t AS (SELECT DISTINCT {key} FROM {source} x WHERE batch = 2 AND {z()} IN ('HET', 'HOM') AND NOT EXISTS (
 SELECT 1 FROM {source} y WHERE y.batch = 1 AND y.{key} = x.{key} AND y.specimen = x.specimen AND {z('y.gt')} IN ('HET', 'HOM')))
SELECT *, {AF} FROM (SELECT coalesce(o.{key}, n.{key}) AS {key}{shown}, {', '.join(pick(c) for c in ('ac', 'an', 'hc', 'pn'))}
FROM o FULL JOIN n ON {same} LEFT JOIN t ON t.{key} = coalesce(o.{key}, n.{key}) WHERE {keep})"""


@query("merge_mutations", "WITH " + _merge_sql("site_id", "gx_batches"), *BATCH_VIEWS)
def _(t):
    one, two = (fr.cohort_frequency(_batch(t, n), ["site_id"]) for n in (1, 2))
    return m.merge_counters(one, two, _touched(t), "site_id")


@query("merge_donors", f"""
SELECT site_id, specimen, arg_min(gt, batch) AS gt FROM gx_batches WHERE {z()} IN ('HET', 'HOM') GROUP BY site_id, specimen""",
       *BATCH_VIEWS)
def _(t):
    return m.merge_donors(_carriers(_batch(t, 1)), _carriers(_batch(t, 2)), "site_id", "specimen")


@query("merge_labs", "WITH lb AS (SELECT * FROM gx_batches JOIN gx_patients USING (specimen))," + _merge_sql(
    "site_id", "lb", ", lab"), *BATCH_VIEWS, "gx_patients")
def _(t):
    patients = t.view("gx_patients")
    one, two = (fr.lab_frequency(_batch(t, n), patients, ["site_id"]) for n in (1, 2))
    return m.merge_counters(one, two, _touched(t), "site_id", ["lab"])


@query("merge_exact", f"""
SELECT *, {AF} FROM (SELECT site_id, {counters()} FROM (
 SELECT site_id, specimen, arg_min(gt, batch) AS gt FROM gx_batches GROUP BY site_id, specimen) GROUP BY site_id)""",
       *BATCH_VIEWS)
def _(t):
    return m.merge_calls_exactly(_batch(t, 1), _batch(t, 2), "site_id", "specimen")


@query("merge_genes", """
SELECT DISTINCT gene_id, site_id FROM gx_ann WHERE symbol <> ''""", "gx_ann")
def _(t):
    rows = t.view("gx_ann").where("symbol <> ''").select("gene_id", "site_id", "ord_b")
    return m.merge_members(rows.where("ord_b <= 4"), rows.where("ord_b >= 3"), "gene_id", "site_id")


@query("merge_gene_donors", """WITH gb AS (SELECT b.*, chrom FROM gx_batches b JOIN gx_sites USING (site_id)),"""
       + _merge_sql("chrom", "gb"), *BATCH_VIEWS, "gx_sites")
def _(t):
    """The mutation merge on another key: here few keys that hold most rows each."""
    sites = t.view("gx_sites").select("site_id", "chrom")
    keyed = lambda calls: calls.join(sites, "site_id")
    one, two = (fr.cohort_frequency(keyed(_batch(t, n)), ["chrom"]) for n in (1, 2))
    return m.merge_counters(one, two, _touched(t, "chrom", keyed), "chrom")


@query("merge_overwrite", """
SELECT site_id, batch AS version, specimen FROM (
 SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY batch DESC, specimen) AS rn FROM gx_batches) WHERE rn = 1""",
       *BATCH_VIEWS)
def _(t):
    """Whole documents by key: each batch has one version of a site, the later batch replaces it."""
    version = lambda n: _batch(t, n).groupBy("site_id").agg(F.min("specimen").alias("specimen")).select(
        "site_id", F.lit(n).alias("version"), "specimen")
    return m.overwrite_by_key(version(1), version(2), "site_id", "version")


@query("donor_append", """
SELECT site_id, specimen, min(batch) AS batch FROM gx_batches GROUP BY site_id, specimen""", *BATCH_VIEWS)
def _(t):
    columns = ("site_id", "specimen", "batch")
    return m.append_missing(_batch(t, 1).select(*columns), _batch(t, 2).select(*columns), "site_id", "specimen")


# ---- ranked reports -----------------------------------------------------------------------------

RANKED = """ranked AS (
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 2 END AS variants, k,
 CASE WHEN l_suppkey % 25 = 22 THEN 23 ELSE l_suppkey % 25 + 1 END AS chrom, l_orderkey * 10 + l_linenumber + 5 * k AS position,
 substr('ACGT', cast(l_partkey % 4 + 1 AS int), 1) AS ref, substr('CGTA', cast(l_partkey % 4 + 1 AS int), 1) AS alt,
 CASE k WHEN 0 THEN 'AD,AR' ELSE 'XR' END AS inheritance, round(l_discount + l_linenumber / 1000.0, 5) AS score
FROM lineitem, (VALUES (0), (1)) v(k) WHERE l_linenumber <> 7 AND (k = 0 OR l_linenumber % 2 = 1)),
keyed AS (SELECT *, concat('chr', CASE WHEN chrom = 23 THEN 'X' ELSE cast(chrom AS string) END, ':g.', cast(position AS string),
 ref, '>', alt) AS mutation_id FROM ranked)"""


@query("exomiser_flatten", f"""WITH {RANKED}
SELECT concat('SYM', l_suppkey) AS "geneSymbol", concat('ENSG', l_suppkey) AS "geneId", score AS "combinedScore",
 variants AS "variantQty", chrom, ref, alt, position, inheritance, variants AS "qtyOfInheritance" FROM keyed""")
def _(t):
    return ex.flatten_report(t.ranked_report()).withColumns({
        "inheritance": F.array_join("inheritance", ","),
        "combinedScore": F.round(F.col("combinedScore").cast("double"), 5)})


@query("exomiser_counts", f"""WITH {RANKED}
SELECT count(*) AS rows, cast(sum(variants) AS bigint) AS inheritance_lists FROM keyed""")
def _(t):
    return ex.report_counts(ex.flatten_report(t.ranked_report()))


def _scores(t: Inputs) -> DataFrame:
    flat = ex.flatten_report(t.ranked_report())
    # the sample a report belongs to: here one of two, by position
    specimen = F.when(F.col("position") % 2 == 0, "SP0").otherwise("SP1")
    return ex.score_rows(flat, BUILD, specimen, F.lit("2020-05-01").cast("date"))


_STORED = f"""stored AS (SELECT DISTINCT {MUTATION} AS mutation_id FROM gx_line WHERE {PRIMARY})"""


def _stored(t: Inputs) -> DataFrame:
    return extract.with_keys(parsed_lines(t), BUILD).select("uid", "mutation_id").distinct()


@query("exomiser_merge", f"""WITH {RANKED}, {_STORED}
SELECT mutation_id, specimen, score AS exomiser_score FROM (
 SELECT mutation_id, concat('SP', s) AS specimen, s FROM stored, (VALUES (0), (1)) v(s)) d LEFT JOIN (
 SELECT mutation_id, position % 2 AS s, max(score) AS score FROM keyed GROUP BY ALL) k USING (mutation_id, s)""", "gx_line")
def _(t):
    stored = _stored(t)
    donors = stored.select(
        "uid", "mutation_id", F.explode(F.array(F.lit("SP0"), F.lit("SP1"))).alias("specimen"))
    merged, _ = m.merge_scores(donors, stored, _scores(t), "uid", "specimen")
    return merged.select("mutation_id", "specimen", F.round(F.col("exomiser_score").cast("double"), 5).alias("exomiser_score"))


@query("exomiser_stubs", f"""WITH {RANKED}, {_STORED}
SELECT mutation_id, inheritance AS transmission, score AS exomiser_score, concat('SP', position % 2) AS specimen FROM keyed
WHERE mutation_id NOT IN (SELECT mutation_id FROM stored)""", "gx_line")
def _(t):
    stored = _stored(t)
    donors = stored.select("uid", F.lit("SP0").alias("specimen"))
    _, stubs = m.merge_scores(donors, stored, _scores(t), "uid", "specimen")
    return stubs.select(
        "mutation_id", F.array_join("transmission", ",").alias("transmission"),
        F.round(F.col("exomiser_score").cast("double"), 5).alias("exomiser_score"), "specimen")


@query("score_stubs_unique", f"""WITH {RANKED}, {_STORED}
SELECT mutation_id, inheritance AS transmission, score AS exomiser_score, concat('SP', position % 2) AS specimen FROM (
 SELECT *, row_number() OVER (PARTITION BY mutation_id ORDER BY score DESC, position % 2, inheritance) AS rn FROM keyed
 WHERE mutation_id NOT IN (SELECT mutation_id FROM stored)) WHERE rn = 1""", "gx_line")
def _(t):
    """One stub per variant that is not stored, as the score job adds them to its state."""
    stored = _stored(t)
    donors = stored.select("uid", F.lit("SP0").alias("specimen"))
    _, absent = m.merge_scores(donors, stored, _scores(t), "uid", "specimen")
    absent = absent.withColumns({
        "transmission": F.array_join("transmission", ","), "exomiser_score": F.round(F.col("exomiser_score").cast("double"), 5)})
    stubs = m.one_stub_per_key(absent, "uid", F.col("exomiser_score"), "specimen", "transmission")
    return stubs.select("mutation_id", "transmission", "exomiser_score", "specimen")


# ---- validation ---------------------------------------------------------------------------------

@query("validate_load", """
SELECT count(*) AS processed, count(CASE WHEN kept AND stored THEN 1 END) AS found,
 count(CASE WHEN kept AND NOT stored THEN 1 END) AS not_found, count(CASE WHEN NOT kept THEN 1 END) AS discarded,
 cast(0 AS bigint) AS errors, count(*) AS total,
 CASE WHEN count(CASE WHEN kept AND NOT stored THEN 1 END) = 0 THEN 'passed' ELSE 'failed' END AS verdict
FROM (SELECT length(substr(chrom, 4)) <= 2 AS kept, site_id IN (SELECT site_id FROM gx_batches WHERE batch = 2) AS stored
 FROM gx_sites)""", *BATCH_VIEWS, "gx_sites")
def _(t):
    discarded = ~is_primary_contig(F.col("chrom"))
    return va.load_statistics(va.classify_load(t.view("gx_sites"), _batch(t, 2), "site_id", discarded))


def _line_keys(t: Inputs) -> DataFrame:
    return extract.with_keys(parsed_lines(t), BUILD).select("uid", "mutation_id")


@query("duplicate_keys", f"""
SELECT upper(md5(concat({MUTATION}, '@GRCh38'))) AS uid, count(*) AS n FROM gx_line WHERE {PRIMARY}
GROUP BY 1 HAVING count(*) > 1""", "gx_line")
def _(t):
    return va.duplicate_keys(_line_keys(t), "uid")


@query("key_collisions", f"""WITH batch AS (
 SELECT {MUTATION} AS mutation_id, upper(md5(concat({MUTATION}, '@GRCh38'))) AS uid FROM gx_line WHERE {PRIMARY}),
stored AS (SELECT uid, CASE WHEN substr(uid, 1, 1) = 'A' THEN concat(mutation_id, '+') ELSE mutation_id END AS mutation_id FROM batch)
SELECT uid, count(DISTINCT mutation_id) AS identities FROM (SELECT uid, mutation_id FROM batch UNION ALL SELECT uid, mutation_id FROM stored)
GROUP BY 1 HAVING count(DISTINCT mutation_id) > 1""", "gx_line")
def _(t):
    """The extract against a stored table that has other variants under some of its uids."""
    batch = _line_keys(t)
    other = F.when(F.col("uid").startswith("A"), F.concat("mutation_id", F.lit("+"))).otherwise(F.col("mutation_id"))
    return va.key_collisions(batch.unionByName(batch.withColumn("mutation_id", other)), "uid", "mutation_id")


@query("parent_child_split", f"""WITH {KEPT_RECORDS}
SELECT {KEYS}, gene_id AS "ensemblId", symbol AS "geneSymbol", arg_min(biotype, pos) AS biotype, 'gene' AS name,
 cast(l_orderkey AS string) AS parent FROM rec WHERE gene_id IS NOT NULL GROUP BY {KEYS}, gene_id, symbol""", "gx_line")
def _(t):
    documents = annotated(t).select(
        *LINE, F.col("l_orderkey").cast("string").alias("uid"), a.genes_of(F.col("annotations")).alias("genes"))
    return split_genes(documents, "uid", LINE).select(*LINE, "ensemblId", "geneSymbol", "biotype", "join.name", "join.parent")


# ---- older wide extracts ------------------------------------------------------------------------

def _legacy(t: Inputs) -> DataFrame:
    return knowledge.parse_legacy_lines(t.legacy_lines())


_FIRST = lambda c: f"trim(string_split(v_{c}, ',')[1])"


@query("legacy_first_value", f"""
SELECT {KEYS}, {_FIRST('exAC_AC')} AS "exAC_AC", {_FIRST('exAC_AF')} AS "exAC_AF", {_FIRST('SIFT_pred')} AS "SIFT_pred",
 {_FIRST('GERP___RS')} AS "GERP___RS", '' AS "gnomAD_genomes_AC" FROM gx_legacy""", "gx_legacy")
def _(t):
    return lg.first_values(_legacy(t)).select(
        *LINE, "exAC_AC", "exAC_AF", "SIFT_pred", "GERP___RS", "gnomAD_genomes_AC")


@query("legacy_populations", f"""
SELECT {KEYS}, try_cast({_FIRST('exAC_AC')} AS bigint) AS exac_ac, try_cast({_FIRST('exAC_AF')} AS double) AS exac_af,
 {_FIRST('exAC_AC')} <> '' OR {_FIRST('exAC_AF')} <> '' AS exac, v_d1000Gp3_AFR_AF <> '' AS kg,
 try_cast(v_gnomAD_exomes_AN AS bigint) AS gnomad_an, false AS esp FROM gx_legacy""", "gx_legacy")
def _(t):
    rows = lg.first_values(_legacy(t)).select(*LINE, *[lg.population(s).alias(s) for s in lg.SOURCES])
    return rows.select(
        *LINE, F.col("ExAc.AC").alias("exac_ac"), F.col("ExAc.AF").alias("exac_af"), F.col("ExAc.available").alias("exac"),
        F.col("1000Gp3.available").alias("kg"), F.col("gnomAD_exomes.AN").alias("gnomad_an"),
        F.col("ESP6500.available").alias("esp"))


_TYPE = ("CASE WHEN v_mixed = 'true' THEN 'MIXED' WHEN v_del = 'true' THEN 'DEL' WHEN v_ins = 'true' THEN 'INS' "
         "WHEN v_mnp = 'true' THEN 'MNP' WHEN v_snp = 'true' THEN 'SNP' END")
_LEGACY_ID = ("concat(substr(v_chrom, 4), ':g.', v_position, 'chr', v_reference, '>', "
              "string_split(replace(v_alt, ',<NON_REF>', ''), ',')[1])")


@query("legacy_documents", f"""
SELECT {KEYS}, upper(sha1({_LEGACY_ID})) AS uid, {_LEGACY_ID} AS mutation_id, {_TYPE} AS type,
 nullif(trim(v_id), '') AS "dbSNP_ID", nullif(v_lof, '') AS lof, v_ac2 AS ac2, try_cast(v_GERP___RS AS double) AS gerp,
 nullif({_FIRST('SIFT_pred')}, '') AS sift, try_cast(v_dp AS int) AS depth, try_cast(v_qual AS double) AS quality,
 CASE WHEN v_het = 'true' THEN 'Het' WHEN v_hom = 'true' THEN 'Hom' END AS zygosity FROM gx_legacy""", "gx_legacy")
def _(t):
    rows = _legacy(t)
    keys = F.struct(*LINE).alias("line")
    documents = lg.variant_documents(
        rows, line=keys, familyId=F.lit("FA1"), donorId=F.col("l_suppkey").cast("string"))
    return documents.select(
        "donor.line.*", "uid", "mutation_id", "type", "dbSNP_ID", F.col("lossOfFunctionEffect").alias("lof"), "ac2",
        F.col("GERP___RS").alias("gerp"), F.col("predictions.SIFT").alias("sift"), "donor.depth", "donor.quality",
        "donor.zygosity")


@query("legacy_annotation_zip", f"""
SELECT {KEYS}, 'G' AS allele, concat('e', cast(l_linenumber AS string)) AS effet, 'HIGH' AS impact, concat('SYM', l_suppkey) AS gene,
 cast(NULL AS string) AS "geneId", 1 AS rank, CASE WHEN l_linenumber > 1 THEN l_linenumber - 1 END AS "cdnaPos",
 CASE WHEN l_linenumber > 1 THEN 100 END AS "cdnaLen", 0 AS "cdsPos", 30 AS "cdsLen", cast(NULL AS int) AS "aaPos",
 cast(NULL AS int) AS "aaLen", l_linenumber AS distance, cast(NULL AS string) AS errors FROM gx_legacy
UNION ALL SELECT {KEYS}, 'T', 'e0', 'LOW', NULL, concat('ENSG', l_suppkey), NULL, 5, 200, NULL, NULL, 5, 8, NULL, 'W1' FROM gx_legacy""",
       "gx_legacy")
def _(t):
    rows = _legacy(t)
    lists = {c: F.split(F.col(c), ",") for c in lg.ANNOTATION_COLUMNS}
    split = rows.select(*LINE, *[v.alias(c) for c, v in lists.items()])
    zipped = lg.annotation_structs({c: F.col(c) for c in lg.ANNOTATION_COLUMNS})
    return unnest(split, LINE, zipped, "allele").select(
        *LINE, "allele", "effet", "impact", "gene", "geneId", "rank", "cdnaPos", "cdnaLen", "cdsPos", "cdsLen", "aaPos",
        "aaLen", "distance", "errors")


@query("legacy_donor_append", f"""
SELECT {_LEGACY_ID} AS mutation_id, l_suppkey AS donor, min(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 2 END) AS batch
FROM gx_legacy GROUP BY 1, 2""", "gx_legacy")
def _(t):
    keyed = _legacy(t).withColumn("batch", F.when(F.trim("hom") == "true", 1).otherwise(2))
    keyed = lg.variant_documents(keyed, donorId=F.col("l_suppkey"), batch=F.col("batch")).select(
        "mutation_id", F.col("donor.donorId").alias("donor"), F.col("donor.batch").alias("batch"))
    one = keyed.where("batch = 1").dropDuplicates(["mutation_id", "donor"])
    return m.append_missing(one, keyed.where("batch = 2"), "mutation_id", "donor")
