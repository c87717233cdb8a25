"""The partitioned state after two batches, and the documents nested from it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from variantloom.functions import keys as k
from variantloom.functions.genotype import is_carrier
from variantloom.operators import frequency as fr
from variantloom.plans import state_store
from variantloom.plans.bridge import BUILD, Inputs
from variantloom.plans.queries_calls import MUTATION, PRIMARY, z
from variantloom.plans.queries_merge import _merge_sql
from variantloom.plans.registry import query
from variantloom.session import checkpoint_dir
from variantloom.sources.sinks import document_member, open_members
from variantloom.streaming import delta_stream

#: Members of a page, so few that the given tables fill several.
PAGE = 3


def _batch(t: Inputs, number: int) -> dict[str, DataFrame]:
    """Flat tables of one batch of calls: variants of its sites, genes annotated by its part of the records."""
    name = k.contig(F.col("chrom"))
    sites = t.view("gx_sites").where(k.is_primary_contig(F.col("chrom"))).select(
        "site_id", name.alias("chrom"), k.mutation_id(name, F.col("pos"), F.col("ref"), k.clean_alt(F.col("alt"))).alias("mutationId"))
    sites = sites.withColumn("uid", k.variant_uid(F.col("mutationId"), BUILD))
    calls = t.view("gx_batches").where(F.col("batch") == number).join(sites.select("site_id", "uid"), "site_id")
    part = F.col("ord_b") <= 4 if number == 1 else F.col("ord_b") >= 3
    genes = t.view("gx_ann").where(part & (F.trim("symbol") != "")).join(sites, "site_id").join(
        t.view("gx_genes"), F.col("gene_id") == F.col("ensembl_id"))
    return {
        "variants": calls.select("uid").distinct().join(sites, "uid").drop("site_id"),
        "cohort": fr.cohort_frequency(calls, ["uid"]),
        "labs": fr.lab_frequency(calls, t.view("gx_patients"), ["uid"]),
        "donors": calls.where(is_carrier(F.col("gt"))).select("uid", F.col("specimen").cast("string").alias("specimenId"), "gt"),
        "gene_variants": genes.select("ensembl_id", F.col("mutationId").alias("mutation_id")).distinct(),
        "gene_aliases": genes.where(F.lower("official") != F.lower("symbol")).select("ensembl_id", F.col("symbol").alias("alias")).distinct(),
        "genes": genes.groupBy("ensembl_id").agg(F.min("official").alias("symbol")),
    }


def _published(t: Inputs) -> str:
    """The folder of the documents, published after each of two batches; the second overwrites its own ranges only."""
    root = f"{checkpoint_dir(t.spark)}/documents-query-{uuid.uuid4().hex}"
    for number in (1, 2):
        touched = state_store.upsert(t.spark, f"{root}/state", _batch(t, number), digits=1)
        state_store.publish(t.spark, f"{root}/state", f"{root}/documents", touched)
    return f"{root}/documents"


def _state(t: Inputs) -> dict[str, DataFrame]:
    """Written in two batches, read back."""
    root = f"{checkpoint_dir(t.spark)}/state-query-{uuid.uuid4().hex}"
    for number in (1, 2):
        state_store.upsert(t.spark, root, _batch(t, number), digits=1)
    return state_store.read_state(t.spark, root)


@query("state_documents", f"""WITH keyed AS (
 SELECT site_id, substr(chrom, 4) AS chrom, {MUTATION} AS mutation_id FROM gx_sites WHERE {PRIMARY}),
cohort AS (WITH {_merge_sql("site_id", "gx_batches")}),
lb AS (SELECT * FROM gx_batches JOIN gx_patients USING (specimen)),
labs AS (WITH {_merge_sql("site_id", "lb", ", lab")}),
lab_text AS (SELECT site_id, string_agg(concat_ws(':', lab, ac, an, hc, pn), ',' ORDER BY lab) AS labs FROM labs GROUP BY site_id),
donors AS (SELECT site_id, cast(specimen AS string) AS specimen, arg_min(gt, batch) AS gt FROM gx_batches
 WHERE {z()} IN ('HET', 'HOM') GROUP BY site_id, specimen),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY site_id ORDER BY md5(specimen)) - 1) // {PAGE} AS page FROM donors),
pages AS (SELECT site_id, page, string_agg(concat_ws(':', specimen, gt), ',' ORDER BY specimen) AS donors FROM ranked GROUP BY ALL),
wanted AS (SELECT site_id, page FROM pages UNION SELECT site_id, 0 FROM cohort)
SELECT upper(md5(concat(mutation_id, '@GRCh38'))) AS uid, cast(w.page AS bigint) AS page,
 CASE WHEN w.page = 0 THEN mutation_id END AS "mutationId", CASE WHEN w.page = 0 THEN k.chrom END AS chrom,
 CASE WHEN w.page = 0 THEN ac END AS ac, CASE WHEN w.page = 0 THEN an END AS an, CASE WHEN w.page = 0 THEN hc END AS hc,
 CASE WHEN w.page = 0 THEN pn END AS pn, CASE WHEN w.page = 0 THEN af END AS af, CASE WHEN w.page = 0 THEN labs END AS labs, donors
FROM wanted w JOIN keyed k USING (site_id) LEFT JOIN cohort USING (site_id) LEFT JOIN lab_text USING (site_id)
LEFT JOIN pages p ON p.site_id = w.site_id AND p.page = w.page""", "gx_sites", "gx_calls", "gx_batches", "gx_patients")
def _(t):
    found = state_store.mutation_documents(_state(t), PAGE)
    cohort = F.col("frequencies")["interne"]
    labs = F.array_sort(F.map_entries(F.map_filter("frequencies", lambda key, _: key != "interne")))
    of = lambda entry: F.concat_ws(":", entry["key"], *[entry["value"][c] for c in ("AC", "AN", "HC", "PN")])
    return found.select(
        "uid", "page", "mutationId", "chrom", *[cohort[c].alias(c.lower()) for c in ("AC", "AN", "HC", "PN", "AF")],
        F.array_join(F.transform(labs, of), ",").alias("labs"),
        F.array_join(F.transform("donors", lambda d: F.concat_ws(":", d["specimenId"], d["gt"])), ",").alias("donors"))


@query("gene_documents", f"""WITH keyed AS (SELECT site_id, {MUTATION} AS mutation_id FROM gx_sites WHERE {PRIMARY}),
named AS (SELECT gene_id AS ensembl_id, symbol, official, mutation_id FROM gx_ann JOIN keyed USING (site_id)
 JOIN gx_genes ON ensembl_id = gene_id WHERE trim(symbol) <> ''),
genes AS (SELECT ensembl_id, min(official) AS symbol,
  string_agg(DISTINCT CASE WHEN lower(official) <> lower(symbol) THEN symbol END, ',' ORDER BY CASE WHEN lower(official) <> lower(symbol) THEN symbol END) AS alias
 FROM named GROUP BY ensembl_id),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY ensembl_id ORDER BY md5(mutation_id)) - 1) // {PAGE} AS page
 FROM (SELECT DISTINCT ensembl_id, mutation_id FROM named)),
pages AS (SELECT ensembl_id, cast(page AS bigint) AS page, string_agg(mutation_id, ',' ORDER BY mutation_id) AS variants FROM ranked GROUP BY ALL)
SELECT ensembl_id, page, variants, CASE WHEN page = 0 THEN symbol END AS symbol,
 CASE WHEN page = 0 THEN coalesce(alias, '') END AS alias FROM pages JOIN genes USING (ensembl_id)""", "gx_sites", "gx_ann", "gx_genes")
def _(t):
    found = state_store.gene_documents(_state(t), PAGE)
    return found.select("ensembl_id", "page", F.array_join("variants", ",").alias("variants"), "symbol",
                        F.array_join("alias", ",").alias("alias"))


@query("document_variant_paths", f"""WITH keyed AS (SELECT site_id, {MUTATION} AS mutation_id FROM gx_sites WHERE {PRIMARY}),
cohort AS (WITH {_merge_sql("site_id", "gx_batches")}), lb AS (SELECT * FROM gx_batches JOIN gx_patients USING (specimen)),
labs AS (WITH {_merge_sql("site_id", "lb", ", lab")})
SELECT mutation_id, c.an AS cohort_an, l.ac AS lab_ac, l.af AS lab_af FROM keyed JOIN cohort c USING (site_id)
LEFT JOIN labs l ON l.site_id = keyed.site_id AND l.lab = 'LAB1'""", "gx_sites", "gx_calls", "gx_batches", "gx_patients")
def _(t):
    stored = t.spark.read.parquet(f"{_published(t)}/mutations").where("page = 0")
    at = lambda kind, *path: document_member("document", kind, *path)
    return stored.select(
        at("string", "mutationId").alias("mutation_id"), at("bigint", "frequencies", "interne", "AN").alias("cohort_an"),
        at("bigint", "frequencies", "LAB1", "AC").alias("lab_ac"), at("double", "frequencies", "LAB1", "AF").alias("lab_af"))


@query("document_open_keys", f"""WITH keyed AS (SELECT site_id, {MUTATION} AS mutation_id FROM gx_sites WHERE {PRIMARY}),
cohort AS (WITH {_merge_sql("site_id", "gx_batches")}), lb AS (SELECT * FROM gx_batches JOIN gx_patients USING (specimen)),
labs AS (WITH {_merge_sql("site_id", "lb", ", lab")})
SELECT upper(md5(concat(mutation_id, '@GRCh38'))) AS uid, name, an, af FROM keyed JOIN (
 SELECT site_id, lab AS name, an, af FROM labs UNION ALL SELECT site_id, 'interne', an, af FROM cohort) USING (site_id)""",
       "gx_sites", "gx_calls", "gx_batches", "gx_patients")
def _(t):
    stored = t.spark.read.parquet(f"{_published(t)}/mutations").where("page = 0")
    return open_members(stored, "document", "frequencies", ["uid"]).select(
        "uid", F.col("key").alias("name"), document_member("value", "bigint", "AN").alias("an"), document_member("value", "double", "AF").alias("af"))


@query("stream_state", f"""WITH cohort AS (WITH {_merge_sql("site_id", "gx_batches")}),
lb AS (SELECT * FROM gx_batches JOIN gx_patients USING (specimen)),
labs AS (WITH {_merge_sql("site_id", "lb", ", lab")}),
lab_text AS (SELECT site_id, string_agg(concat_ws(':', lab, ac, an, hc, pn), ',' ORDER BY lab) AS labs FROM labs GROUP BY site_id),
donors AS (SELECT site_id, specimen, arg_min(gt, batch) AS gt FROM gx_batches WHERE {z()} IN ('HET', 'HOM') GROUP BY site_id, specimen),
carriers AS (SELECT site_id, cast(count(*) AS bigint) AS donors, cast(sum(specimen) AS bigint) AS specimens,
 cast(sum(CASE WHEN gt = '1/1' THEN 1 ELSE 0 END) AS bigint) AS homozygous FROM donors GROUP BY site_id)
SELECT * FROM cohort LEFT JOIN lab_text USING (site_id) LEFT JOIN carriers USING (site_id)""", "gx_calls", "gx_batches", "gx_patients")
def _(t):
    """Both batches come as files and are merged by the stream."""
    root = f"{checkpoint_dir(t.spark)}/stream-query-{uuid.uuid4().hex}"
    schema = "site_id long, specimen long, gt string"
    for number in (1, 2):
        calls = t.view("gx_batches").where(F.col("batch") == number).selectExpr(
            *[f"cast({c} AS {kind}) AS {c}" for c, kind in (f.split() for f in schema.split(", "))])
        calls.write.mode("append").parquet(f"{root}/calls")
        delta_stream.start(t.spark, f"{root}/calls", schema, f"{root}/state", laboratories=t.view("gx_patients")).awaitTermination()
    state = delta_stream.read_state(t.spark, f"{root}/state")
    labs = state["labs"].groupBy("site_id").agg(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws(":", "lab", "ac", "an", "hc", "pn"))), ",").alias("labs"))
    carriers = state["donors"].groupBy("site_id").agg(
        F.count(F.lit(1)).alias("donors"), F.sum("specimen").alias("specimens"), F.count(F.when(F.col("gt") == "1/1", 1)).alias("homozygous"))
    return state["cohort"].join(labs, "site_id", "left").join(carriers, "site_id", "left")
