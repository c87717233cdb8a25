"""Functional annotations inside extract lines, and genes with their knowledge sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.functions import annotation as a
from variantloom.functions.fields import double_or_null, id_list, long_or_null, set_text, text_or_null, yes_flag
from variantloom.functions.genotype import impact_score
from variantloom.operators import genes as gn
from variantloom.operators.grouping import nest, settled, unnest
from variantloom.operators.validation import annotation_statistics
from variantloom.plans.bridge import EXTRACT_HEADER, RECORDS, Inputs
from variantloom.plans.mutation_etl import annotation_rows, with_annotations
from variantloom.plans.registry import query
from variantloom.sources import extract

LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
KEYS = ", ".join(LINE)
_AT = {name: i for i, name in enumerate(a.RECORD_FIELDS)}
_ALT = "replace(alt, ',<NON_REF>', '')"
_SCORE = "CASE upper({impact}) WHEN 'HIGH' THEN 4 WHEN 'MODERATE' THEN 3 WHEN 'LOW' THEN 2 WHEN 'MODIFIER' THEN 1 ELSE 0 END"
PRIMARY = "length(substr(chrom, 4)) <= 2"


def _record_sql(j: int) -> str:
    f = lambda name: f"f{j}_{_AT[name]}"
    absent = lambda name: f"nullif(nullif({f(name)}, ''), '.')"
    matched = {0: "l_linenumber % 2 = 0", 1: "true", 2: "false"}[j]
    before = " AND ".join(f"bad{i} = 0" for i in range(j + 1))
    return f"""SELECT {KEYS}, {j} AS pos, {absent('SYMBOL')} AS symbol, {absent('Gene')} AS gene_id,
 CASE WHEN {matched} AND {f('Amino_acids')} <> '.' THEN concat(substr({f('Amino_acids')}, 1, 1), {f('Protein_position')},
  substr({f('Amino_acids')}, 3)) END AS aa_change,
 array_to_string(list_sort(list_distinct(string_split({f('Consequence')}, '&'))), ',') AS consequence,
 CASE WHEN {f('CDS_position')} <> '' THEN concat({f('CDS_position')}, ref, '>', {_ALT}) END AS cdna_change,
 try_cast({f('STRAND')} AS bigint) AS strand, {absent('IMPACT')} AS impact, {_SCORE.format(impact=f('IMPACT'))} AS score,
 {absent('BIOTYPE')} AS biotype, {absent('Feature')} AS feature_id, {absent('EXON')} AS exon, {absent('PICK')} AS pick,
 {f('CANONICAL')} = 'YES' AS canonical, {absent('RefSeq')} AS refseq_id,
 try_cast({f('phyloP17way_primate_rankscore')} AS double) AS phylop17way, {matched} AS matched,
 {f('rs_dbSNP151')} AS dbsnp, {f('clinvar_id')} AS clinvar, {absent('clinvar_OMIM')} AS omim,
 {absent('clinvar_Orphanet')} AS orphanet, {f('PUBMED')} AS pubmed, {f('clinvar_clnsig')} AS clinvar_sig,
 {f('clinvar_trait')} AS clinvar_trait, {f('VARIANT_CLASS')} AS variant_class,
 try_cast({f('1000Gp3_AC')} AS bigint) AS p1000_ac, try_cast({f('1000Gp3_AF')} AS double) AS p1000_af,
 cast(try_cast({f('gnomAD_exomes_AC')} AS double) AS bigint) AS gnomad_ac,
 try_cast({f('gnomAD_exomes_AF')} AS double) AS gnomad_af, try_cast({f('CADD_raw_rankscore')} AS double) AS cadd
 FROM gx_line WHERE {PRIMARY} AND {before}"""


# records of the primary contigs in front of the first malformed one
KEPT_RECORDS = "rec AS (" + "\nUNION ALL ".join(_record_sql(j) for j in range(RECORDS)) + ")"


def annotated(t: Inputs, **options) -> DataFrame:
    return with_annotations(extract.parse_lines(t.lines(), EXTRACT_HEADER), **options)


def _joined(values: Column) -> Column:
    return F.array_join(values, ",")


# ---- long annotation rows -----------------------------------------------------------------------

@query("impact_score", f"""
SELECT site_id, max({_SCORE.format(impact='impact')}) AS impact_score, count(*) AS annotations FROM gx_ann
GROUP BY site_id""", "gx_ann")
def _(t):
    return t.view("gx_ann").groupBy("site_id").agg(
        F.max(impact_score(F.col("impact"))).alias("impact_score"), F.count(F.lit(1)).alias("annotations"))


@query("null_suppressed_fields", f"""
SELECT site_id, ord_a, ord_b, ord_c, ord_d, nullif(nullif(impact, ''), '.') AS impact, nullif(pick, '') AS pick,
 canonical = 'YES' AS canonical, try_cast(pop_ac AS bigint) AS pop_ac, try_cast(pop_af AS double) AS pop_af FROM gx_ann""",
       "gx_ann")
def _(t):
    return t.view("gx_ann").select(
        "site_id", "ord_a", "ord_b", "ord_c", "ord_d", text_or_null(F.col("impact")).alias("impact"),
        text_or_null(F.col("pick")).alias("pick"), yes_flag(F.col("canonical")).alias("canonical"),
        long_or_null(F.col("pop_ac")).alias("pop_ac"), double_or_null(F.col("pop_af")).alias("pop_af"))


@query("annotation_takewhile_sites", """
WITH bad AS (SELECT site_id, min(row(ord_a, ord_b, ord_c, ord_d)) AS first_bad FROM gx_ann WHERE malformed = 1 GROUP BY site_id)
SELECT x.site_id, count(*) AS kept, min(ord_a) AS first_order FROM gx_ann x LEFT JOIN bad USING (site_id)
WHERE first_bad IS NULL OR row(ord_a, ord_b, ord_c, ord_d) < first_bad GROUP BY x.site_id""", "gx_ann")
def _(t):
    return rows_before_malformed(t.view("gx_ann")).groupBy("site_id").agg(
        F.count(F.lit(1)).alias("kept"), F.min("ord_a").alias("first_order"))


ORDER = ("ord_a", "ord_b", "ord_c", "ord_d")


def rows_before_malformed(rows: DataFrame) -> DataFrame:
    """Long form of the take-while rule: the first malformed position is a partially aggregated minimum."""
    at = F.struct(*ORDER)
    bad = rows.where("malformed = 1").groupBy("site_id").agg(F.min(at).alias("first_bad"))
    return rows.join(bad, "site_id", "left").where(F.col("first_bad").isNull() | (at < F.col("first_bad")))


@query("consequence_groups_sites", """
SELECT site_id, symbol, consequence, strand, count(*) AS annotations, bool_or(pick <> '') AS pick,
 bool_or(canonical = 'YES') AS canonical, arg_min(gene_id, row(ord_a, ord_b, ord_c, ord_d)) AS gene_id,
 arg_min(impact, row(ord_a, ord_b, ord_c, ord_d)) AS impact
FROM (SELECT * REPLACE (array_to_string(list_sort(list_distinct(string_split(consequence, '&'))), ',') AS consequence) FROM gx_ann)
GROUP BY site_id, symbol, consequence, strand""", "gx_ann")
def _(t):
    """Groups over long rows: only the first annotation's values and flags are carried, so rows reduce before the exchange."""
    at = F.struct(*ORDER)
    rows = t.view("gx_ann").withColumn("consequence", _joined(a.consequence_set(F.col("consequence"))))
    first = F.min(F.struct(at.alias("at"), "gene_id", "impact"))
    return rows.groupBy("site_id", "symbol", "consequence", "strand").agg(
        F.count(F.lit(1)).alias("annotations"), F.bool_or(F.col("pick") != "").alias("pick"),
        F.bool_or(yes_flag(F.col("canonical"))).alias("canonical"), first.alias("first"),
    ).select("site_id", "symbol", "consequence", "strand", "annotations", "pick", "canonical", "first.gene_id",
             "first.impact")


@query("variant_types", """
SELECT site_id, string_agg(DISTINCT variant_class, ',' ORDER BY variant_class) AS type FROM gx_ann
WHERE variant_class <> '' GROUP BY site_id""", "gx_ann")
def _(t):
    return t.view("gx_ann").where("variant_class <> ''").select("site_id", "variant_class").distinct().groupBy(
        "site_id").agg(_joined(F.array_sort(F.collect_set("variant_class"))).alias("type"))


@query("external_id_members", """
SELECT DISTINCT site_id, regexp_replace(unnest(string_split(dbsnp, '&')), '^_', '') AS id FROM gx_ann""", "gx_ann")
def _(t):
    return t.view("gx_ann").select("site_id", F.explode(id_list(F.col("dbsnp"))).alias("id")).distinct()


# ---- annotations of a line ----------------------------------------------------------------------

@query("annotation_parse", f"""WITH {KEPT_RECORDS}
SELECT {KEYS}, pos, symbol, gene_id, consequence, impact, strand, biotype, feature_id, exon, pick, canonical, refseq_id,
 phylop17way FROM rec""", "gx_line")
def _(t):
    return annotation_rows(annotated(t), LINE).select(
        *LINE, "pos", "symbol", "gene_id", _joined(F.col("consequence")).alias("consequence"), "impact", "strand",
        "biotype", "feature_id", "exon", "pick", "canonical", "refseq_id", "phylop17way")


def _kept_counts(stop: bool) -> str:
    whole = " + ".join(
        f"cast({' AND '.join(f'bad{i} = 0' for i in (range(j + 1) if stop else (j,)))} AS int)" for j in range(RECORDS))
    return f"SELECT {KEYS}, {whole} AS kept FROM gx_line WHERE {PRIMARY}"


@query("annotation_takewhile", _kept_counts(True), "gx_line")
def _(t):
    return annotated(t).select(*LINE, F.size("annotations").alias("kept"))


@query("annotation_skip_malformed", _kept_counts(False), "gx_line")
def _(t):
    return annotated(t, stop_at_malformed=False).select(*LINE, F.size("annotations").alias("kept"))


@query("consequence_groups", f"""WITH {KEPT_RECORDS}
SELECT {KEYS}, symbol AS "geneAffectedSymbol", CASE WHEN symbol IS NOT NULL THEN arg_min(coalesce(gene_id, ''), pos) END AS gene,
 aa_change AS "aaChange", cdna_change AS "cdnaChange", consequence, strand, min(pos) AS pos,
 arg_min(coalesce(impact, ''), pos) AS impact, arg_min(biotype, pos) AS biotype, bool_or(pick IS NOT NULL) AS pick,
 bool_or(canonical) AS canonical, string_agg(feature_id, ',' ORDER BY pos) AS transcripts
FROM rec GROUP BY {KEYS}, symbol, aa_change, consequence, cdna_change, strand""", "gx_line")
def _(t):
    groups = unnest(annotated(t), LINE, a.consequence_groups(F.col("annotations")), "pos")
    return groups.select(
        *LINE, "geneAffectedSymbol",
        F.when(F.col("geneAffectedSymbol").isNotNull(), F.coalesce("geneAffectedId", F.lit(""))).alias("gene"),
        "aaChange", "cdnaChange", _joined(F.col("consequence")).alias("consequence"), "strand", "pos",
        F.coalesce("impact", F.lit("")).alias("impact"), "biotype", "pick", "canonical",
        _joined(F.transform("transcripts", lambda x: x["featureId"])).alias("transcripts"))


def _id_set_sql(column: str) -> str:
    return (f"nullif(array_to_string(list_sort(list_distinct(flatten(list(list_transform(CASE WHEN {column} <> '' THEN "
            f"string_split({column}, '&') ELSE [] END, lambda v: regexp_replace(v, '^_', '')))))), ','), '') AS {column}")


_SETS = {"dbsnp": "dbsnp", "clinvar": "clinvar", "omim": "omim", "orphanet": "orphanet", "pubmed": "pubmed",
         "clinvar_sig": "clinvar_sig", "clinvar_trait": "clinvar_trait", "variant_class": "types"}


@query("external_id_sets", f"""WITH {KEPT_RECORDS}
SELECT {KEYS}, {', '.join(_id_set_sql(c) for c in _SETS)} FROM rec GROUP BY {KEYS}""", "gx_line")
def _(t):
    return annotated(t).withColumn("ids", a.id_sets(F.col("records"))).select(
        *LINE, *[set_text(F.col(f"ids.{member}")).alias(name) for name, member in _SETS.items()])


@query("population_frequency_last", f"""WITH {KEPT_RECORDS},
last AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY pos DESC) AS rn FROM rec
 WHERE p1000_af IS NOT NULL OR gnomad_af IS NOT NULL)
SELECT {KEYS}, CASE WHEN p1000_af IS NOT NULL THEN p1000_ac END AS p1000_ac, p1000_af,
 CASE WHEN gnomad_af IS NOT NULL THEN gnomad_ac END AS gnomad_ac, gnomad_af FROM last WHERE rn = 1""", "gx_line")
def _(t):
    last = settled(annotated(t), "p", a.last_populations(F.col("annotations"))).where("p IS NOT NULL")
    return last.select(
        *LINE, F.col("p.1000Gp3.AC").alias("p1000_ac"), F.col("p.1000Gp3.AF").alias("p1000_af"),
        F.col("p.gnomAD_exomes.AC").alias("gnomad_ac"), F.col("p.gnomAD_exomes.AF").alias("gnomad_af"))


@query("transcript_predictions", f"""WITH {KEPT_RECORDS}
SELECT {KEYS}, pos, CASE WHEN pos = 0 OR l_linenumber % 3 = 0 THEN 0.1 ELSE 0.2 END AS fathmm_score,
 CASE pos WHEN 0 THEN 'DAMAGING' ELSE 'TOLERATED' END AS fathmm, CASE pos WHEN 0 THEN 'TOLERATED' END AS sift,
 CASE WHEN pos = 0 OR l_linenumber % 3 = 0 THEN 0.3 ELSE 0.4 END AS sift_score,
 CASE pos WHEN 0 THEN 'BENIGN' ELSE 'POSSIBLY DAMAGING' END AS polyphen2_hvar, 'NEUTRAL' AS lrt, cadd
FROM rec WHERE matched AND cadd IS NOT NULL""", "gx_line")
def _(t):
    rows = annotation_rows(annotated(t), LINE).where("predictions IS NOT NULL")
    p = lambda name: F.col(f"predictions.{name}")
    return rows.select(
        *LINE, "pos", p("FATHMM_score").alias("fathmm_score"), p("FATHMM").alias("fathmm"), p("SIFT").alias("sift"),
        p("SIFT_score").alias("sift_score"), p("Polyphen2_HVAR_pred").alias("polyphen2_hvar"),
        p("LRT_pred").alias("lrt"), p("CADD_score").alias("cadd"))


@query("protein_coding_change", f"""WITH {KEPT_RECORDS} SELECT {KEYS}, pos, aa_change, cdna_change FROM rec""", "gx_line")
def _(t):
    return annotation_rows(annotated(t), LINE).select(*LINE, "pos", "aa_change", "cdna_change")


@query("annotation_stats", f"""WITH {KEPT_RECORDS}
SELECT count(*) AS variants, cast(sum(n) AS bigint) AS annotations, avg(n) AS average FROM (
 SELECT x.l_orderkey, count(rec.pos) AS n FROM gx_line x LEFT JOIN rec USING ({KEYS}) WHERE {PRIMARY}
 GROUP BY x.l_orderkey, {', '.join(f'x.{k}' for k in LINE[1:])})""", "gx_line")
def _(t):
    return annotation_statistics(annotated(t), F.col("annotations"))


# ---- genes --------------------------------------------------------------------------------------

@query("gene_members_pivot", """
SELECT ensembl_id, max(CASE WHEN member LIKE 'symbol:%' THEN substr(member, 8) END) AS symbol,
 max(CASE WHEN member LIKE 'geneid:%' THEN substr(member, 8) END) AS "geneId",
 max(CASE WHEN member LIKE 'map_location:%' THEN substr(member, 14) END) AS location,
 max(CASE WHEN member LIKE 'hgnc:%' THEN substr(member, 6) END) AS hgnc,
 max(CASE WHEN member LIKE 'name:%' THEN substr(member, 6) END) AS name,
 coalesce(string_agg(CASE WHEN member LIKE 'alias:%' THEN substr(member, 7) END, ';' ORDER BY member), '') AS alias,
 coalesce(string_agg(CASE WHEN member LIKE 'omim:%' THEN substr(member, 6) END, ';' ORDER BY member), '') AS "geneMim",
 coalesce(string_agg(CASE WHEN member LIKE 'Rad:%' THEN substr(member, 5) END, ';' ORDER BY member), '') AS radboudumc,
 coalesce(string_agg(CASE WHEN member LIKE 'HP:%' THEN concat(string_split(member, ',')[2], ' (', string_split(member, ',')[1], ')') END,
  ';' ORDER BY concat(string_split(member, ',')[2], ' (', string_split(member, ',')[1])), '') AS hpo
FROM gx_members GROUP BY ensembl_id""", "gx_genes", "gx_members")
def _(t):
    lists = ("alias", "geneMim", "radboudumc", "hpo")
    return gn.gene_profiles(t.view("gx_members")).select(
        "ensembl_id", "symbol", "geneId", "location", "hgnc", "name", *[F.array_join(c, ";").alias(c) for c in lists])


@query("omim_struct", """
SELECT ensembl_id, substr(string_split(member, ';')[1], 4, 6) AS "phenotypeMim",
 substr(string_split(member, ';')[1], 10) AS phenotype,
 CASE WHEN len(string_split(member, ';')) = 2 THEN string_split(member, ';')[2] END AS inheritance
FROM gx_members WHERE member LIKE 'op:%'""", "gx_genes", "gx_members")
def _(t):
    rows = t.view("gx_members").where(F.col("member").startswith("op:"))
    return rows.select("ensembl_id", gn.omim_entry(F.col("member")).alias("o")).select(
        "ensembl_id", "o.phenotypeMim", "o.phenotype", _joined(F.col("o.inheritance")).alias("inheritance"))


@query("orphanet_struct", """
SELECT ensembl_id, replace(string_split(member, ';')[2], 'did:', '') AS "dataId",
 concat(string_split(string_split(member, ';')[1], ',')[2], ' (', string_split(string_split(member, ';')[1], ',')[1], ')') AS panel
FROM gx_members WHERE member LIKE 'Orph:%'""", "gx_genes", "gx_members")
def _(t):
    rows = t.view("gx_members").where(F.col("member").startswith("Orph:"))
    return rows.select("ensembl_id", gn.orphanet_entry(F.col("member")).alias("o")).select("ensembl_id", "o.*")


@query("gene_symbol_reconcile", """
SELECT gene_id, CASE WHEN official IS NOT NULL AND lower(official) <> lower(symbol) THEN official ELSE symbol END AS symbol,
 CASE WHEN lower(official) <> lower(symbol) THEN symbol END AS old_symbol, count(*) AS annotations
FROM gx_ann LEFT JOIN gx_genes ON ensembl_id = gene_id GROUP BY ALL""", "gx_ann", "gx_genes")
def _(t):
    rows = t.view("gx_ann").groupBy("gene_id", "symbol").agg(F.count(F.lit(1)).alias("annotations"))
    fixed = gn.with_official_symbols(rows, t.view("gx_members"), "gene_id", "symbol")
    return fixed.groupBy("gene_id", "symbol", "old_symbol").agg(F.sum("annotations").alias("annotations"))


@query("gene_lookup", """
SELECT g.gene_id AS ensembl_id, member FROM (SELECT DISTINCT gene_id FROM gx_ann) g
LEFT JOIN gx_members ON ensembl_id = g.gene_id""", "gx_ann", "gx_members")
def _(t):
    genes = t.view("gx_ann").select(F.col("gene_id").alias("ensembl_id"))
    return gn.members_of(t.view("gx_members"), genes)


@query("symbol_lookup", """
SELECT s.symbol, ensembl_id FROM (SELECT DISTINCT replace(symbol, 'SYM', 'OFF') AS symbol FROM gx_ann) s
JOIN gx_genes ON official = s.symbol""", "gx_ann", "gx_genes")
def _(t):
    symbols = t.view("gx_ann").select(F.replace("symbol", F.lit("SYM"), F.lit("OFF")).alias("symbol"))
    return gn.genes_for_symbols(t.view("gx_members"), symbols)


@query("gene_variants", """
SELECT gene_id, site_id, symbol FROM gx_ann WHERE trim(gene_id) <> '' AND trim(symbol) <> '' GROUP BY ALL""", "gx_ann")
def _(t):
    return gn.distinct_genes(t.view("gx_ann"), ["site_id"])


@query("gene_variant_pages", """
SELECT gene_id, cast(floor(site_id / 1000) AS bigint) AS page, count(DISTINCT site_id) AS variants,
 string_agg(DISTINCT cast(site_id AS string), ',' ORDER BY cast(site_id AS string)) AS ids
FROM gx_ann WHERE trim(symbol) <> '' GROUP BY gene_id, cast(floor(site_id / 1000) AS bigint)""", "gx_ann")
def _(t):
    rows = gn.distinct_genes(t.view("gx_ann"), ["site_id"]).select("gene_id", "site_id").distinct()
    nested = nest(rows, ["gene_id"], "site_id", [], "variants")
    texts = F.array_sort(F.transform("variants", lambda v: v["site_id"].cast("string")))
    return nested.select("gene_id", "page", F.size("variants").cast("bigint").alias("variants"), _joined(texts).alias("ids"))


@query("gene_index_build", """
SELECT ensembl_id, official AS symbol, cast(gene_no AS string) AS "geneId", alias FROM gx_genes WHERE gene_no % 5 <> 0""",
       "gx_genes")
def _(t):
    references = t.view("gx_genes").select(F.concat(
        F.lit("MIM:"), F.col("gene_no"), F.lit("|HGNC:HGNC:"), F.col("gene_no"), F.lit("|Ensembl:"), F.col("ensembl_id"),
        F.lit("|Ensembl:ENSX"), F.col("gene_no")).alias("db_xrefs"))
    return gn.gene_index(references, t.view("gx_members")).select(
        "ensembl_id", "symbol", "geneId", _joined(F.col("alias")).alias("alias"))
