"""Mutation job: extract lines -> variant documents and flat state tables -> merged state.

Everything up to the gene join is one narrow pass over the lines: contig filter, split, keys, calls,
frequencies, donors, inheritance and annotations are expressions on the line's own row."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from variantloom.functions import annotation as a
from variantloom.functions.fields import double_or_null, non_empty, set_text
from variantloom.operators import merge as m
from variantloom.operators.calls import line_frequency, line_lab_frequencies, with_calls
from variantloom.operators.cohort import donors, lab_members, sample_sheet
from variantloom.operators.genes import gene_profiles, reconcile_symbol, replaced_symbol
from variantloom.operators.grouping import unnest
from variantloom.session import checkpoint_dir
from variantloom.sources.sinks import COMPLETE, write_merged, write_table

COUNTS = ("AC", "AN", "HC", "PN")


def with_annotations(rows: DataFrame, stop_at_malformed: bool = True) -> DataFrame:
    """Adds ``records`` (field arrays) and ``annotations`` (typed structs) to lines with ``csq``, ``ref``, ``alt``, and what
    ``annotation_rows`` needs besides: the variant's ``predictions`` and each record's place among them in ``matches``.

    Each step is its own projection, so a record is split once however many results use it."""
    keep = a.take_while_well_formed if stop_at_malformed else a.only_well_formed
    return (
        rows.withColumn("_all", a.split_records(F.col("csq")))
        .withColumn("records", keep(F.col("_all"))).drop("_all")
        .withColumn("_source", a.first_with_transcripts(F.col("records")))
        .withColumn("_own", a.prediction_fields(F.get("records", F.col("_source"))))
        .withColumns({
            "predictions": a.transcript_predictions(F.col("_own")),
            "_transcripts": F.reverse(F.col("_own.lists.Ensembl_transcriptid")),
        }).drop("_own")
        .withColumn("matches", a.matched_predictions(F.col("records"), F.col("_transcripts"), F.col("_source")))
        .drop("_source", "_transcripts")
        .withColumn("annotations", a.parse_records(*map(F.col, ("records", "matches", "predictions", "ref", "alt"))))
    )


def annotation_rows(annotated: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per annotation of ``with_annotations``, behind the columns to keep: the same members, but made of the records'
    own rows. There they are compiled code, and members that are not read are not made."""
    each = annotated.select(
        *keep, *[F.col(c).alias(f"_{c}") for c in ("ref", "alt", "predictions", "matches")],
        F.posexplode_outer("records").alias("_at", "_fields")).where(F.col("_at").isNotNull())
    members = a.record_members(
        F.col("_fields"), F.col("_at"), F.get("_matches", F.col("_at")), F.col("_predictions"), F.col("_ref"), F.col("_alt"))
    return each.select(*keep, *[value.alias(name) for name, value in members.items()])


def _population_entries(populations: Column) -> Column:
    none = F.lit(None).cast("bigint")
    entries = F.array(*[
        F.struct(F.lit(p).alias("key"), F.when(populations[p].isNotNull(), F.struct(
            populations[p]["AC"].alias("AC"), none.alias("AN"), none.alias("HC"), none.alias("PN"),
            populations[p]["AF"].alias("AF"))).alias("value"))
        for p in a.POPULATIONS
    ])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


#: Names in a document's frequencies that are no laboratory's.
RESERVED = ("interne", *a.POPULATIONS)
#: A laboratory of such a name, or of one that begins like this, stands under its name behind this.
_OWN = "lab:"


def lab_key(lab: Column) -> Column:
    """A laboratory's name among the frequencies: never that of the cohort or of a population."""
    return F.when(lab.isin(*RESERVED) | lab.startswith(_OWN), F.concat(F.lit(_OWN), lab)).otherwise(lab)


def lab_name(key: Column) -> Column:
    return F.regexp_replace(key, f"^{_OWN}", "")


def _frequencies(calls: Column, sheet: Column, labs: Column, populations: Column) -> Column:
    """Populations, the cohort and the laboratories."""
    cohort = F.create_map(F.lit("interne"), line_frequency(F.transform(sheet, lambda s: F.get(calls, s["idx"]))))
    return F.map_concat(_population_entries(populations), cohort, line_lab_frequencies(calls, labs))


def line_documents(rows: DataFrame, cohort: DataFrame, updated: Column, build: str = "GRCh38",
                   tool: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Keyed extract rows + sample sheet -> one nested document per line, without gene knowledge.

    ``carry`` names columns of the rows that go along, for ordering lines of one variant."""
    sheet, labs = sample_sheet(cohort), lab_members(cohort.withColumn("lab", lab_key(F.col("lab"))))
    keyed = [c for c in rows.columns if c not in ("chrom", "gt", "ad", "gq", "csq", "dp", "mq", "qd", "filter")]
    parsed = with_annotations(with_calls(rows))
    # sheet and laboratories become columns once; expressions below refer to them
    staged = parsed.withColumns({"_sheet": sheet, "_labs": labs})
    staged = staged.select(
        *keyed, "records", "annotations", "calls", "_sheet", "_labs", "filter",
        double_or_null(F.col("qd")).alias("qd"),
    ).withColumns({
        "ids": a.id_sets(F.col("records")), "_populations": a.last_populations(F.col("annotations")),
    })
    ids = lambda name: non_empty(F.col(f"ids.{name}"))
    return staged.select(
        *carry, "uid", F.col("mutation_id").alias("mutationId"), F.col("dna_change").alias("dnaChange"),
        F.col("contig").alias("chrom"), F.col("pos").alias("start"), F.col("ref").alias("refAllele"),
        F.col("alt").alias("altAllele"), F.lit(build).alias("assemblyVersion"),
        F.lit(tool).cast("string").alias("annotationTool"), updated.alias("lastAnnotationUpdate"),
        a.top_impact(F.col("annotations")).alias("impactScore"), set_text(F.col("ids.types")).alias("type"),
        a.consequence_groups(F.col("annotations")).alias("consequences"),
        a.genes_of(F.col("annotations")).alias("genes"),
        donors(F.col("calls"), F.col("_sheet"), F.col("contig"), F.col("filter"), F.col("qd"), updated)
        .alias("donors"),
        _frequencies(F.col("calls"), F.col("_sheet"), F.col("_labs"), F.col("_populations")).alias("frequencies"),
        F.struct(*[ids(n).alias(o) for o, n in (
            ("dbSNP", "dbsnp"), ("clinvar", "clinvar"), ("omim", "omim"), ("orphanet", "orphanet"),
            ("pubmed", "pubmed"))]).alias("bdExt"),
        F.when(set_text(F.col("ids.clinvar")).isNotNull(), F.struct(
            set_text(F.col("ids.clinvar")).alias("clinvar_id"), ids("clinvar_sig").alias("clinvar_clinsig"),
            ids("clinvar_trait").alias("clinvar_trait"))).alias("clinvar"),
    ).withColumn("specimenList", F.transform("donors", lambda d: d["specimenId"]))


def with_gene_knowledge(documents: DataFrame, members: DataFrame) -> DataFrame:
    """Joins the gene sets (E5), corrects symbols in genes and consequences (D13, E10), sets availability flags.

    ``uid`` must be unique. Only (uid, gene) rows travel to the gene table; the document itself moves once,
    to its uid, where the merge needs it anyway."""
    profiles = gene_profiles(members).withColumn("_id", F.col("ensembl_id"))
    found = (
        unnest(documents, ["uid"], "genes", "geneSymbol").where(F.trim("geneSymbol") != "")
        .join(profiles, F.col("ensemblId") == F.col("ensembl_id"), "left")
    )
    old = replaced_symbol(F.col("geneSymbol"), F.col("symbol"))
    none = F.array().cast("array<string>")
    gene = F.struct(
        "ensemblId", reconcile_symbol(F.col("geneSymbol"), F.col("symbol")).alias("geneSymbol"), "biotype",
        *[F.col(c) for c in ("geneId", "hgnc", "name", "location")],
        non_empty(F.array_sort(F.array_union(
            F.coalesce("alias", none), F.when(old.isNotNull(), F.array(old)).otherwise(none)))).alias("alias"),
        *[non_empty(F.col(c)).alias(c) for c in ("hpo", "radboudumc", "geneMim", "orphanet", "omim")],
        old.alias("oldGeneSymbol"),
    )
    per_variant = found.groupBy("uid").agg(F.array_sort(F.collect_list(gene)).alias("_genes"))
    joined = documents.drop("genes").join(per_variant, "uid", "left")

    def corrected(c: Column) -> Column:
        hit = F.get(F.filter("_genes", lambda g: (F.lower(g["ensemblId"]) == F.lower(c["geneAffectedId"]))
                             & g["oldGeneSymbol"].isNotNull()), F.lit(0))
        return c.withField("geneAffectedSymbol", F.coalesce(hit["geneSymbol"], c["geneAffectedSymbol"]))

    any_gene = lambda field: F.coalesce(F.exists("_genes", lambda g: g[field].isNotNull()), F.lit(False))
    flags = {f"bdExt.{n}": n for n in ("dbSNP", "clinvar", "omim", "orphanet", "pubmed")}
    available = {n: F.col(path).isNotNull() for path, n in flags.items()}
    for n in ("hpo", "orphanet", "radboudumc"):
        available[n] = available.get(n, F.lit(False)) | any_gene(n)
    return joined.select(
        *[c for c in joined.columns if c not in ("consequences", "_genes")],
        F.when(F.col("_genes").isNull(), F.col("consequences"))
        .otherwise(F.transform("consequences", corrected)).alias("consequences"),
        F.transform("_genes", lambda g: g.dropFields("oldGeneSymbol")).alias("genes"),
        F.transform(F.filter("_genes", lambda g: g["oldGeneSymbol"].isNotNull()), lambda g: F.struct(
            g["ensemblId"].alias("ensemblId"), g["oldGeneSymbol"].alias("alias"))).alias("newAliases"),
        F.map_filter(F.create_map(*[x for n, v in available.items() for x in (F.lit(n), v)]), lambda _, v: v)
        .alias("availableDbExt"),
    )


def numbered_lines(documents: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Adds ``_line``, the place of a line among those of its variant: the order columns, then a digest of the content."""
    content = F.sha2(F.to_json(F.struct(*[c for c in documents.columns if c not in order])), 256)
    return documents.withColumn("_line", F.struct(*order, content.alias("_content")))


def joined_lines(documents: DataFrame, order: Sequence[str] = (), staging: str | None = None) -> DataFrame:
    """One document per variant: lines that share a key are joined by the rule of the batch merge (H1, H2), in the
    order of ``_line``, which is dropped with the given columns (default: by content). A later line's donors of new
    samples are appended; if there is one, its counters are added and its laboratories inserted. Everything else stays
    as the first line has it. No donor is lost.

    Only repeated variants are regrouped; a single line keeps its row. However many lines a variant has, they never
    meet: every aggregate is reduced before its exchange, and what it leaves of a variant (a donor per sample column, a
    counter per laboratory) is no more than one line holds. ``documents`` is read several times: stage it."""
    names = [c for c in documents.columns if c not in (*order, "_line")]
    # joined by a value computed from the key: rows are then not taken as dealt by the key, so that a variant with
    # very many lines is split in the join and reduced in each part before the aggregate deals it
    repeated = documents.groupBy("uid").count().where("count > 1").select(F.reverse("uid").alias("_key"))
    keyed = documents.withColumn("_key", F.reverse("uid"))
    lines = keyed.join(repeated, "_key", "left_semi").drop("_key")
    single = keyed.join(repeated, "_key", "left_anti").select(*names)

    first = lines.groupBy("uid").agg(
        F.min_by(F.struct(*[n for n in names if n != "uid"]), "_line").alias("_first"), F.min("_line").alias("_line"))

    # each sample's donors of the first line that has the sample
    each = lines.select("uid", "_line", F.posexplode("donors").alias("_pos", "_donor"))
    each = each.groupBy("uid", F.col("_donor.specimenId").alias("_specimen"), F.col("_donor.idx").alias("_idx")).agg(
        F.min(F.struct("_line", "_pos", "_donor")).alias("_d"))
    each = each.groupBy("uid", "_specimen").agg(F.collect_list("_d").alias("_all"), F.min("_d._line").alias("_least"))
    brought = each.select("uid", F.filter("_all", lambda d: d["_line"].eqNullSafe(F.col("_least"))).alias("_new"), "_least")
    donors_of = brought.groupBy("uid").agg(F.array_sort(F.flatten(F.collect_list("_new"))).alias("_donors"))

    # counters of the first line and of those that bring a sample; equal lines are one
    counted = first.select("uid", "_line").unionByName(brought.select("uid", F.col("_least").alias("_line"))).distinct()
    entries = lines.select("uid", "_line", F.explode("frequencies").alias("_name", "_f")).where(F.col("_f").isNotNull())
    entries = entries.groupBy("uid", "_line", "_name").agg(F.min("_f").alias("_f")).join(counted, ["uid", "_line"], "left_semi")
    summed = entries.groupBy("uid", "_name").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("_line", "_f"))["_f"].alias("_kept"),
        *[F.coalesce(F.sum(f"_f.{c}"), F.lit(0).cast("bigint")).alias(c) for c in COUNTS])
    af = F.when(F.col("AN") > 0, F.col("AC").cast("double") / F.col("AN")).otherwise(F.lit(0.0))
    kept = F.col("_name").isin(*a.POPULATIONS) | (F.col("_n") == 1)
    entry = F.when(kept, F.col("_kept")).otherwise(F.struct(*COUNTS, af.alias("AF")))
    frequencies_of = summed.groupBy("uid").agg(
        F.map_from_entries(F.collect_list(F.struct("_name", entry.alias("_f")))).alias("_frequencies"))

    donors_now = F.coalesce(F.transform("_donors", lambda d: d["_donor"]), F.col("_first.donors"))
    changed = {
        "uid": F.col("uid"), "donors": donors_now, "specimenList": F.transform(donors_now, lambda d: d["specimenId"]),
        "frequencies": F.coalesce("_frequencies", "_first.frequencies"),
    }
    joined = first.join(donors_of, "uid", "left").join(frequencies_of, "uid", "left").select(
        *[changed.get(n, F.col(f"_first.{n}")).alias(n) for n in names])
    if staging:
        write_table(joined, staging)
        joined = documents.sparkSession.read.parquet(staging)
    return single.unionByName(joined)


def mutation_documents(rows: DataFrame, cohort: DataFrame, members: DataFrame, updated: Column,
                       build: str = "GRCh38", tool: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Staged in a folder of its own: the joins read the lines several times."""
    staging = f"{checkpoint_dir(rows.sparkSession)}/documents-{uuid.uuid4().hex}"
    return staged_documents(rows, cohort, members, updated, staging, build, tool, order)


def staged_documents(rows: DataFrame, cohort: DataFrame, members: DataFrame, updated: Column, staging: str,
                     build: str = "GRCh38", tool: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """The same documents with the line pass written to ``staging`` once. Annotation text stays in that narrow pass: it
    is in no exchange and no sort. Repeated keys and genes are resolved on the staged rows."""
    write_table(numbered_lines(line_documents(rows, cohort, updated, build, tool, order), order), f"{staging}/lines")
    lines = rows.sparkSession.read.parquet(f"{staging}/lines")
    return with_gene_knowledge(joined_lines(lines, order, f"{staging}/joined"), members)


# ---- flat state ---------------------------------------------------------------------------------

def flat_state(documents: DataFrame) -> dict[str, DataFrame]:
    """Documents -> the flat tables the merges work on."""
    frequency = lambda f: [F.col(f"{f}.{c}").alias(c.lower()) for c in (*COUNTS, "AF")]
    labs = documents.select("uid", F.explode("frequencies").alias("lab", "f")).where(
        ~F.col("lab").isin(*RESERVED)).withColumn("lab", lab_name(F.col("lab")))
    genes = documents.select("mutationId", F.inline("genes")).where(F.trim("ensemblId") != "")
    about = [f.name for f in documents.schema["genes"].dataType.elementType if f.name not in ("ensemblId", "alias")]
    aliases = documents.select(F.inline("newAliases"))
    return {
        "variants": documents.withColumn(
            "populations", F.map_filter("frequencies", lambda k, _: k.isin(*a.POPULATIONS))
        ).drop("donors", "specimenList", "frequencies", "newAliases"),
        "cohort": documents.select("uid", F.col("frequencies")["interne"].alias("f")).select("uid", *frequency("f")),
        "labs": labs.select("uid", "lab", *frequency("f")),
        "donors": documents.select("uid", F.inline("donors")).drop("idx"),
        "gene_variants": genes.select(F.col("ensemblId").alias("ensembl_id"), F.col("mutationId").alias("mutation_id"))
        .distinct(),
        "gene_aliases": aliases.select(F.col("ensemblId").alias("ensembl_id"), "alias").distinct(),
        "genes": genes.groupBy(F.col("ensemblId").alias("ensembl_id")).agg(F.min(F.struct(*about)).alias("_gene")).select(
            "ensembl_id", "_gene.*"),
    }


def merge_state(state: dict[str, DataFrame], batch: dict[str, DataFrame], fresh: DataFrame | None = None) -> dict[str, DataFrame]:
    """Upsert of one batch into the flat state (H1-H3). ``fresh`` are the batch's donors that are not stored, if they
    have been computed before; several tables need them."""
    if fresh is None:
        fresh = m.new_members(state["donors"], batch["donors"], "uid", "specimenId")
    touched = fresh.select("uid").distinct()
    absent = lambda name, key: state[name].unionByName(batch[name].join(state[name].select(key), key, "left_anti"))
    return {
        "variants": absent("variants", "uid"),
        "cohort": m.merge_counters(state["cohort"], batch["cohort"], touched, "uid"),
        "labs": m.merge_counters(state["labs"], batch["labs"], touched, "uid", ["lab"]),
        "donors": state["donors"].unionByName(fresh),
        "gene_variants": m.merge_members(state["gene_variants"], batch["gene_variants"], "ensembl_id", "mutation_id"),
        "gene_aliases": m.merge_members(state["gene_aliases"], batch["gene_aliases"], "ensembl_id", "alias"),
        "genes": absent("genes", "ensembl_id"),
    }


#: Tables of the state and the key that each is found by.
TABLES = {
    "variants": "uid", "cohort": "uid", "labs": "uid", "donors": "uid", "gene_variants": "ensembl_id",
    "gene_aliases": "ensembl_id", "genes": "ensembl_id",
}


def read_state(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a state that was written to its end; half a state is an error."""
    written = {r["name"] for r in spark.read.schema("name string").parquet(f"{folder}/{COMPLETE}").collect()}
    if not written.issuperset(TABLES):
        raise ValueError(f"{folder} lacks {sorted(set(TABLES) - written)}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES}


def run(rows: DataFrame, cohort: DataFrame, members: DataFrame, updated: Column, target: str,
        state: str | None = None, build: str = "GRCh38", tool: str | None = None, batch_name: str | None = None) -> None:
    """Whole job. The line pass is written once to the shared folder, so a lost executor repeats tasks of the
    current stage only and the extract is scanned once; then repeated keys and genes are joined and the state is
    merged. Each run stages in a folder of its own."""
    spark = rows.sparkSession
    staging = f"{checkpoint_dir(spark)}/{batch_name or 'batch'}-{uuid.uuid4().hex}"
    documents = staged_documents(rows, cohort, members, updated, staging, build, tool)
    write_table(documents, f"{staging}/documents")
    batch = flat_state(spark.read.parquet(f"{staging}/documents"))
    merged = batch if state is None else merge_state(read_state(spark, state), batch)
    write_merged(merged, target)
