"""Patients, pedigrees and their documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.functions.genotype import is_affected
from variantloom.operators.grouping import first_by_content, last_by_key


def hpo_terms(impressions: Column) -> Column:
    """``display (code)`` of every phenotype of the positive observations, in document order."""
    observations = F.flatten(F.transform(impressions, lambda c: c["observations"]))
    positive = F.filter(observations, lambda o: o["observed"] == "POS")
    phenotypes = F.flatten(F.transform(positive, lambda o: o["phenotype"]))
    return F.transform(phenotypes, lambda p: F.concat(p["display"], F.lit(" ("), p["code"], F.lit(")")))


def _same(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def request_of(requests: Column, specimen: Column) -> Column:
    """First service request that lists the sample."""
    lists_it = lambda r: F.exists(r["specimen"], lambda s: _same(s["id"], specimen))
    return F.get(F.filter(requests, lists_it), F.lit(0))


def impression_of(impressions: Column, reference: Column) -> Column:
    return F.get(F.filter(impressions, lambda c: _same(c["id"], reference)), F.lit(0))


def practitioner_of(practitioners: Column, role: Column) -> Column:
    return F.get(F.filter(practitioners, lambda p: _same(p["role_id"], role)), F.lit(0))


def patient_attributes(documents: DataFrame, specimen: str = "specimen") -> DataFrame:
    """Flat patient rows for (document, sample) rows: request, assessor, laboratory, HPO terms.

    Assessor and organisation come from the clinical impression the request names; a patient without
    impressions falls back to the general practitioner's role."""
    chosen = (
        documents.withColumn("_request", request_of(F.col("serviceRequests"), F.col(specimen)))
        .withColumn("_impression", impression_of(F.col("clinicalImpressions"), F.col("_request.ci_ref")))
        .withColumn("_role", F.get("generalPractitioner", F.lit(0))["id"])
        .withColumn("_practitioner", practitioner_of(F.col("practitioners"), F.col("_role")))
    )
    seen = F.size("clinicalImpressions") > 0
    has_request = F.col("_request").isNotNull()
    either = lambda a, b: F.when(has_request, F.when(seen, F.col(a)).otherwise(F.col(b)))
    return chosen.select(
        specimen, F.col("id").alias("patient_id"), F.col("familyId").alias("family_id"),
        F.get("studies", F.lit(0))["id"].alias("study_id"),
        F.when(F.col("isProband"), "Proband").alias("relation"), F.col("status").alias("affected"), "gender",
        F.col("_request.code.text").alias("strategy"),
        F.col("_request.requester_id").alias("requester_id"),
        F.col("_request.requester_org_id").alias("requester_org_id"),
        F.col("_request.requester_org_name").alias("lab_name"),
        F.col("_request.requester_org_alias").alias("lab"),
        either("_impression.assessor_id", "_practitioner.id").alias("practitioner_id"),
        either("_impression.assessor_org_id", "_practitioner.role_org_id").alias("organization_id"),
        hpo_terms(F.col("clinicalImpressions")).alias("hpo_terms"),
    )


def documents_of_samples(documents: DataFrame, specimens: DataFrame, specimen: str = "specimen") -> DataFrame:
    """The document of every sample: samples inside the service requests are exploded and joined on equality;
    when several documents list a sample, the first by id wins."""
    listed = documents.select(
        "id", F.explode(F.flatten(F.transform("serviceRequests", lambda r: r["specimen"]["id"]))).alias(specimen))
    first = listed.groupBy(specimen).agg(F.min("id").alias("id"))
    return specimens.select(specimen).distinct().join(first, specimen).join(documents, "id")


def linked_relatives(documents: DataFrame) -> DataFrame:
    """Proband -> relatives: one row per link, with the relation the proband's document gives."""
    return documents.where("isProband").select(
        F.col("id").alias("proband_id"), F.inline("link")).select(
        "proband_id", F.col("id").alias("patient_id"), F.col("relationship").alias("relation"))


def with_relations(patients: DataFrame, links: DataFrame) -> DataFrame:
    """Relatives get the relation named by their proband."""
    named = links.groupBy("patient_id").agg(F.max("relation").alias("_relation"))
    return patients.join(named, "patient_id", "left").withColumn(
        "relation", F.coalesce("_relation", "relation")).drop("_relation")


def proband_links(links: DataFrame, patients: DataFrame) -> DataFrame:
    """Linked patient and sample ids per proband."""
    samples = patients.select("patient_id", "specimen")
    return links.join(samples, "patient_id").groupBy("proband_id").agg(
        F.array_sort(F.collect_list("patient_id")).alias("linked_patients"),
        F.array_sort(F.collect_list("specimen")).alias("linked_specimens"))


def by_pedigree_id(samples: DataFrame, ped: DataFrame, specimen: str, ped_id: str, how: str = "inner") -> DataFrame:
    """Samples joined with their pedigree row, ignoring the case of ids."""
    left = samples.withColumn("_id", F.lower(F.col(specimen).cast("string")))
    right = ped.withColumn("_id", F.lower(F.col(ped_id).cast("string")))
    if specimen == ped_id:
        right = right.drop(ped_id)
    return left.join(right, "_id", how).drop("_id")


def require_pedigree(samples: DataFrame, ped: DataFrame, specimen: str, ped_id: str) -> DataFrame:
    """Sample rows with their pedigree; the job fails at the first sample that has none."""
    matched = by_pedigree_id(samples, ped.withColumn("_found", F.lit(True)), specimen, ped_id, "left")
    message = F.concat(F.lit("sample without pedigree entry: "), F.col(specimen).cast("string"))
    checked = F.when(F.col("_found"), F.col("_found")).otherwise(F.raise_error(message).cast("boolean"))
    return matched.where(checked).drop("_found")


def missing_from(samples: DataFrame, known: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return samples.join(known, on, "left_anti")


def known_samples(samples: DataFrame, patients: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Samples with a patient; the index of the sample column is part of the row and stays valid."""
    return samples.join(patients, on, "left_semi")


def hpo_matches(gene_terms: DataFrame, patient_terms: DataFrame, gene: str, patient: str, code: str) -> DataFrame:
    """Number of (gene, phenotype code) hits of each affected patient.

    Genes are counted per code first, so a common code joins as one row and no gene-patient pairs are built."""
    per_code = gene_terms.select(gene, code).distinct().groupBy(code).agg(F.count(F.lit(1)).alias("_genes"))
    hits = patient_terms.select(patient, code).distinct().join(per_code, code)
    return hits.groupBy(patient).agg(F.sum("_genes").alias("matches"))


def hpo_matches_per_variant(carriers: DataFrame, variant_genes: DataFrame, gene_terms: DataFrame,
                            patient_terms: DataFrame, variant: str, gene: str, patient: str, code: str) -> DataFrame:
    """Number of (gene, phenotype code) hits of each affected carrier among the genes of the variant.

    Starts from the carriers' calls; a variant's genes are counted per code first."""
    codes = (
        variant_genes.select(variant, gene).distinct().join(gene_terms.select(gene, code).distinct(), gene)
        .groupBy(variant, code).agg(F.count(F.lit(1)).alias("_genes"))
    )
    terms = carriers.select(variant, patient).distinct().join(patient_terms.select(patient, code).distinct(), patient)
    return terms.join(codes, [variant, code]).groupBy(variant, patient).agg(F.sum("_genes").alias("matches"))


def affected_terms(patients: DataFrame, ped: DataFrame, specimen: str, codes: str, phenotype: str = "phenotype"
                   ) -> DataFrame:
    """(sample, code) rows of affected members: own codes plus a pedigree phenotype that is a code itself."""
    affected = patients.select(specimen, codes).join(ped.select(specimen, phenotype), specimen).where(
        is_affected(F.col(phenotype)) & ~F.col(phenotype).isin("-9", "0"))
    return affected.select(
        specimen, F.explode(F.array_union(F.col(codes), F.when(
            F.length(phenotype) > 2, F.array(phenotype)).otherwise(F.array().cast("array<string>")))).alias("code"))


def donor_phenotypes(terms: Column, phenotype: Column, affected: Column, matches: Column) -> Column:
    """HPO terms of an affected carrier with matches, extended by a pedigree phenotype code."""
    extended = F.when(F.length(phenotype) > 2, F.array_append(terms, phenotype)).otherwise(terms)
    return F.when(affected & (matches > 0), extended)


def patients_from_lists(lists: DataFrame, owner: str, columns: Sequence[str], hpo_counts: str, hpo: str,
                        link_counts: str, link_patients: str, link_specimens: str) -> DataFrame:
    """Cohort given as parallel comma lists, one row per owner -> one row per sample.

    The two shared lists are cut by running counts inside the row's own arrays."""
    listed = lambda c: F.split(F.col(c), ",")
    count = lambda c: F.transform(listed(c), lambda v: v.cast("int"))
    before = lambda arr, i: F.aggregate(F.slice(arr, F.lit(1), i), F.lit(0), lambda a, v: a + v)
    parsed = lists.select(
        owner, *[listed(c).alias(c) for c in columns], count(hpo_counts).alias("_hn"), count(link_counts).alias("_ln"),
        listed(hpo).alias("_h"), listed(link_patients).alias("_lp"), listed(link_specimens).alias("_ls"),
    )
    rows = parsed.select("*", F.posexplode(F.arrays_zip(*columns)).alias("pos", "_row"))
    cut = lambda items, n: F.slice(F.col(items), before(F.col(n), F.col("pos")) + 1, F.get(n, F.col("pos")))
    return rows.select(
        owner, "pos", "_row.*", cut("_h", "_hn").alias("hpo_terms"), cut("_lp", "_ln").alias("linked_patients"),
        cut("_ls", "_ln").alias("linked_specimens"),
    )


def document_by_id(documents: DataFrame, wanted: DataFrame, key: str = "id") -> DataFrame:
    """Equality lookup; with a literal id use ``where`` so that the filter reaches the scan."""
    return documents.join(wanted.select(key).distinct(), key, "left_semi")


def first_hit(hits: DataFrame, query: str, order: Sequence[Column]) -> DataFrame:
    """First hit per query."""
    return last_by_key(hits, [query], order)


def composed_sheet(samples: DataFrame, pedigree: DataFrame, documents: DataFrame | None = None,
                   properties: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(the sample sheet, the rejected samples) for the sample columns of an extract: ``idx, specimen``.

    A sample's patient is the document whose service requests list it, or else its row of the properties. What the
    document leaves open is looked for further on: assessor and organisation in the request's impression, then in the general
    practitioner's role; the relation in the document, in the links of its proband, in the properties, and in
    the pedigree, where another member names it as a parent; a blank property is none. The family, sex and phenotype come from the pedigree.

    Nothing is dropped without a word: ``rejects`` has ``idx, specimen, reason`` of samples that are listed again,
    have no patient, or have no pedigree row. The others keep their column index. Of several pedigree rows or
    properties of one sample the first by content counts."""
    key = lambda column: F.lower(F.trim(column))
    columns = samples.select("idx", "specimen").withColumn("_id", key("specimen"))
    first = columns.groupBy("_id").agg(F.min("idx").alias("_first"))
    columns = columns.join(first, "_id").withColumn("_again", F.col("idx") > F.col("_first")).drop("_first")

    ped = first_by_content(pedigree.withColumn("_id", key("id")), ["_id"])
    named = ped.select(F.explode(F.array(
        F.struct(key("paternal_id").alias("_id"), F.lit("FTH").alias("_parent")),
        F.struct(key("maternal_id").alias("_id"), F.lit("MTH").alias("_parent")))).alias("p")).select("p.*")
    parents = named.groupBy("_id").agg(F.min("_parent").alias("_parent"))
    facts = ped.select("_id", "family_id", "sex", "phenotype", F.lit(True).alias("_pedigree")).join(parents, "_id", "left")

    text = lambda name: F.lit(None).cast("string").alias(name)
    fields = ("patient_id", "study_id", "practitioner_id", "organization_id", "strategy", "lab")
    people = None
    if documents is not None:
        attributes = patient_attributes(documents_of_samples(documents, columns))
        attributes = with_relations(attributes, linked_relatives(documents))
        people = attributes.select(
            key("specimen").alias("_id"), *[F.coalesce("lab", "lab_name").alias(f) if f == "lab" else F.col(f) for f in fields],
            "relation", F.col("hpo_terms").alias("phenotypes"), F.lit("document").alias("origin"))
        people = first_by_content(people, ["_id"])
    if properties is not None:
        stated = lambda name: F.when(F.trim(name) != "", F.col(name)) if name in properties.columns else text("s")
        given = first_by_content(properties.select(
            key("specimen").alias("_id"), stated("patientId").alias("patient_id"), stated("studyId").alias("study_id"),
            stated("practitionerId").alias("practitioner_id"), stated("organizationId").alias("organization_id"),
            stated("sequencingStrategy").alias("strategy"), stated("laboName").alias("lab"), stated("relation").alias("relation"),
            F.col("hpo_terms").alias("phenotypes"), F.lit("properties").alias("origin")), ["_id"])
        people = given if people is None else people.unionByName(given.join(people, "_id", "left_anti"))
        relations = given.select("_id", F.col("relation").alias("_listed"))
    else:
        relations = columns.limit(0).select("_id", text("_listed"))
    if people is None:
        raise ValueError("patients come from documents, properties or both")

    joined = columns.join(facts, "_id", "left").join(people, "_id", "left").join(relations, "_id", "left")
    reason = F.when(F.col("_again"), "listed again").when(F.col("origin").isNull(), "no patient").when(
        F.col("_pedigree").isNull(), "no pedigree")
    joined = joined.withColumn("reason", reason)
    sheet = joined.where(F.col("reason").isNull()).select(
        "idx", "specimen", "family_id", F.coalesce("relation", "_listed", "_parent").alias("relation"), "sex", "phenotype",
        *fields, "phenotypes", "origin")
    return sheet, joined.where(F.col("reason").isNotNull()).select("idx", "specimen", "reason")
