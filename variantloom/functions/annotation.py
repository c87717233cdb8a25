"""Parsing of functional-annotation records inside one extract line.

Every expression works on arrays of the line's own row, so annotation text is never shuffled."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from variantloom.functions.fields import (
    as_set, double_or_null, frequency_struct, id_list, long_or_null, text_or_null, yes_flag,
)
from variantloom.functions.genotype import (
    FATHMM_CODES, LRT_CODES, POLYPHEN2_HVAR_CODES, SIFT_CODES, code_table, impact_score,
)

# Names of the 66 record fields, in file order.
RECORD_FIELDS = (
    "Allele", "Consequence", "IMPACT", "SYMBOL", "Gene", "Feature_type", "Feature", "BIOTYPE", "EXON", "INTRON",
    "HGVSc", "HGVSp", "cDNA_position", "CDS_position", "Protein_position", "Amino_acids", "Codons",
    "Existing_variation", "DISTANCE", "STRAND", "FLAGS", "PICK", "VARIANT_CLASS", "SYMBOL_SOURCE", "HGNC_ID",
    "CANONICAL", "RefSeq", "HGVS_OFFSET", "HGVSg", "CLIN_SIG", "SOMATIC", "PHENO", "PUBMED", "1000Gp3_AC",
    "1000Gp3_AF", "CADD_raw_rankscore", "DANN_rankscore", "Ensembl_geneid", "Ensembl_transcriptid", "ExAC_AC",
    "ExAC_AF", "FATHMM_rankscore", "FATHMM_pred", "GTEx_tissue", "Interpro_domain", "LRT_rankscore", "LRT_pred",
    "Polyphen2_HVAR_pred", "Polyphen2_HVAR_rankscore", "REVEL_rankscore", "SIFT_rankscore", "SIFT_pred", "UK10K_AC",
    "UK10K_AF", "clinvar_MedGen", "clinvar_OMIM", "clinvar_Orphanet", "clinvar_clnsig", "clinvar_id",
    "clinvar_trait", "gnomAD_exomes_AC", "gnomAD_exomes_AF", "gnomAD_genomes_AC", "gnomAD_genomes_AF",
    "phyloP17way_primate_rankscore", "rs_dbSNP151",
)
ARITY = len(RECORD_FIELDS)
_AT = {name: i for i, name in enumerate(RECORD_FIELDS)}

# Population name -> pair of record fields.
POPULATIONS = {
    "1000Gp3": ("1000Gp3_AC", "1000Gp3_AF"),
    "ExAc": ("ExAC_AC", "ExAC_AF"),
    "gnomAD_exomes": ("gnomAD_exomes_AC", "gnomAD_exomes_AF"),
    "gnomAD_genomes": ("gnomAD_genomes_AC", "gnomAD_genomes_AF"),
    "Uk10k": ("UK10K_AC", "UK10K_AF"),
}
# External id set name -> record field.
ID_SETS = {
    "dbsnp": "rs_dbSNP151", "clinvar": "clinvar_id", "omim": "clinvar_OMIM", "orphanet": "clinvar_Orphanet",
    "pubmed": "PUBMED", "clinvar_sig": "clinvar_clnsig", "clinvar_trait": "clinvar_trait", "types": "VARIANT_CLASS",
    "pheno": "PHENO",
}


def bound_once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is looked at. Nothing is copied, as a transform would."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, use)


def split_records(csq: Column) -> Column:
    """Comma list of records -> array of field arrays (trailing empty records dropped)."""
    # the trim looks at every character, and next to no line ends in a comma
    trimmed = F.when(csq.endswith(","), F.rtrim(csq, F.lit(","))).otherwise(csq)
    records = F.split(trimmed, ",")
    return F.transform(records, lambda r: F.split(r, r"\|", -1))


def is_well_formed(fields: Column) -> Column:
    return F.size(fields) == ARITY


def take_while_well_formed(records: Column) -> Column:
    """Records before the first malformed one; later records are lost with it."""
    first_bad = F.array_position(F.transform(records, is_well_formed), F.lit(False))
    return F.when(first_bad > 0, F.slice(records, F.lit(1), (first_bad - 1).cast("int"))).otherwise(records)


def only_well_formed(records: Column) -> Column:
    return F.filter(records, is_well_formed)


def amino_acid_change(amino_acids: Column, protein_pos: Column) -> Column:
    usable = (amino_acids != "") & ~amino_acids.startswith(".")
    return F.when(
        usable, F.concat(F.substring(amino_acids, 1, 1), protein_pos, F.substring(amino_acids, 3, 1 << 20))
    )


def coding_change(cds_pos: Column, ref: Column, alt: Column) -> Column:
    return F.when((cds_pos != "") & (cds_pos != "."), F.concat(cds_pos, ref, F.lit(">"), alt))


def consequence_set(consequence: Column) -> Column:
    return as_set(F.split(consequence, "&"))


_PREDICTION_LISTS = (
    "Ensembl_transcriptid", "FATHMM_rankscore", "FATHMM_pred", "SIFT_pred", "SIFT_rankscore", "Polyphen2_HVAR_pred",
    "Polyphen2_HVAR_rankscore",
)


def prediction_fields(fields: Column) -> Column:
    """What the predictions of a record's transcripts are made of: its ``&`` lists, and the values that hold for all."""

    def raw(name: str) -> Column:
        return F.get(fields, F.lit(_AT[name]))

    # each list is split once for the record, not once for each of its transcripts
    lists = F.struct(*[F.split(raw(n), "&").alias(n) for n in _PREDICTION_LISTS])
    whole = F.struct(
        code_table(LRT_CODES, raw("LRT_pred")).alias("LRT_pred"), double_or_null(raw("LRT_rankscore")).alias("LRT_score"),
        double_or_null(raw("REVEL_rankscore")).alias("REVEL_score"),
        double_or_null(raw("DANN_rankscore")).alias("DANN_score"),
        double_or_null(raw("CADD_raw_rankscore")).alias("CADD_score"),
    )
    return F.struct(lists.alias("lists"), whole.alias("whole"))


def transcript_predictions(source: Column) -> Column:
    """Per-transcript prediction structs of one record's ``prediction_fields``: ``&`` lists aligned by position.

    Score lists use position 0 when the record has a single SIFT score."""
    of, own = source["lists"], source["whole"]
    single_score = F.size(of["SIFT_rankscore"]) <= 1

    def one(_: Column, i: Column) -> Column:
        at = F.when(single_score, F.lit(0)).otherwise(i)
        return F.struct(
            double_or_null(F.get(of["FATHMM_rankscore"], at)).alias("FATHMM_score"),
            code_table(FATHMM_CODES, F.get(of["FATHMM_pred"], i)).alias("FATHMM"),
            code_table(SIFT_CODES, F.get(of["SIFT_pred"], i)).alias("SIFT"),
            double_or_null(F.get(of["SIFT_rankscore"], at)).alias("SIFT_score"),
            code_table(POLYPHEN2_HVAR_CODES, F.get(of["Polyphen2_HVAR_pred"], i)).alias("Polyphen2_HVAR_pred"),
            double_or_null(F.get(of["Polyphen2_HVAR_rankscore"], at)).alias("Polyphen2_HVAR_score"),
            *[own[n].alias(n) for n in ("LRT_pred", "LRT_score", "REVEL_score", "DANN_score", "CADD_score")],
        )

    return F.transform(of["Ensembl_transcriptid"], one)


def has_transcripts(fields: Column) -> Column:
    return F.trim(fields[_AT["Ensembl_transcriptid"]]) != ""


def first_with_transcripts(records: Column) -> Column:
    """Zero-based position of the record whose transcript ids fill the variant's prediction table (-1: none)."""
    return (F.array_position(F.transform(records, has_transcripts), F.lit(True)) - 1).cast("int")


def matched_predictions(records: Column, transcripts: Column, source: Column) -> Column:
    """Per record where its transcript stands in the prediction table, whose transcripts are given last one first. The table
    counts only from position ``source`` on."""
    # the last entry of a transcript counts
    return F.transform(records, lambda fields, i: F.when(
        (source >= 0) & (i >= source) & F.array_contains(transcripts, fields[_AT["Feature"]]),
        (F.size(transcripts) - F.array_position(transcripts, fields[_AT["Feature"]])).cast("int")))


def parse_records(records: Column, matches: Column, predictions: Column, ref: Column, alt: Column) -> Column:
    """Typed annotation structs; ``matches`` holds the place of each record's entry among the ``predictions``."""
    return F.transform(records, lambda fields, i: F.struct(
        *[v.alias(n) for n, v in record_members(fields, i, F.get(matches, i), predictions, ref, alt).items()]))


def record_members(fields: Column, i: Column, match: Column, predictions: Column, ref: Column, alt: Column) -> dict[str, Column]:
    """The members of the typed annotation of the record at ``i``."""

    def raw(name: str) -> Column:
        return fields[_AT[name]]

    entry = F.get(predictions, match)
    feature = raw("Feature")
    symbol = text_or_null(raw("SYMBOL"))
    return {
        "pos": i,
        "symbol": symbol,
        "gene_id": text_or_null(raw("Gene")),
        "aa_change": F.when(match.isNotNull(), text_or_null(
            amino_acid_change(raw("Amino_acids"), raw("Protein_position")))),
        "consequence": consequence_set(raw("Consequence")),
        "cdna_change": coding_change(raw("CDS_position"), ref, alt),
        "strand": long_or_null(raw("STRAND")),
        "impact": text_or_null(raw("IMPACT")),
        "biotype": text_or_null(raw("BIOTYPE")),
        "feature_type": text_or_null(raw("Feature_type")),
        "feature_id": text_or_null(feature),
        "exon": text_or_null(raw("EXON")),
        "pick": text_or_null(raw("PICK")),
        "canonical": yes_flag(raw("CANONICAL")),
        "refseq_id": text_or_null(raw("RefSeq")),
        "clinvar_omim": text_or_null(raw("clinvar_OMIM")),
        "clinvar_orphanet": text_or_null(raw("clinvar_Orphanet")),
        "phylop17way": double_or_null(raw("phyloP17way_primate_rankscore")),
        "predictions": F.when(entry["CADD_score"].isNotNull(), entry),
        "populations": F.struct(*[
            frequency_struct(raw(ac), raw(af)).alias(name) for name, (ac, af) in POPULATIONS.items()
        ]),
    }


def id_sets(records: Column) -> Column:
    """One sorted set per external source over all records of the line."""
    def collected(name: str, at: int) -> Column:
        # the two disease sources also treat "." as absent
        value = (lambda f: text_or_null(f[at])) if name in ("omim", "orphanet") else (lambda f: f[at])
        return as_set(F.flatten(F.transform(records, lambda f: id_list(value(f)))))

    return F.struct(*[collected(name, _AT[field]).alias(name) for name, field in ID_SETS.items()])


def top_impact(annotations: Column) -> Column:
    return F.coalesce(
        F.array_max(F.transform(annotations, lambda a: impact_score(a["impact"]))), F.lit(0)
    )


def last_populations(annotations: Column) -> Column:
    """Population frequencies of the last annotation that has any."""
    any_population = lambda a: F.coalesce(*[a["populations"][p]["AF"] for p in POPULATIONS]).isNotNull()
    return F.try_element_at(F.filter(annotations, any_population), F.lit(-1))["populations"]


def _group_key(a: Column) -> Column:
    """Absent text members of the key count as empty text."""
    return F.struct(
        F.coalesce(a["symbol"], F.lit("")).alias("symbol"),
        F.coalesce(a["aa_change"], F.lit("")).alias("aa_change"),
        a["consequence"].alias("consequence"),
        F.coalesce(a["cdna_change"], F.lit("")).alias("cdna_change"),
        F.coalesce(a["strand"].cast("string"), F.lit("")).alias("strand"),
    )


def _in_groups(records: Column, key, summary) -> Column:
    """One ``summary`` per key of the records, in the order in which keys appear first.

    The records' keys are made once and sorted once; groups are cut where the key changes. So a line's work grows with its
    records (and the logarithm of their number), not with groups times records."""

    def sort(of: Column) -> Column:
        places = F.array_sort(F.transform(of, lambda r, i: F.struct(key(r).alias("key"), i.alias("at"))))
        return bound_once(F.struct(of.alias("records"), places.alias("places")), cut)

    def cut(of: Column) -> Column:
        places = of["places"]
        differs = lambda i: F.get(places, i)["key"] != F.get(places, F.greatest(i - 1, F.lit(0)))["key"]
        starts = F.filter(F.transform(places, lambda _, i: i), lambda i: (i == 0) | differs(i))
        return bound_once(F.struct(of.alias("of"), starts.alias("starts")), groups)

    def groups(cut: Column) -> Column:
        records, places, starts = cut["of"]["records"], cut["of"]["places"], cut["starts"]
        runs = F.array_sort(F.transform(starts, lambda low, n: F.struct(
            F.get(places, low)["at"].alias("at"), low.alias("low"),
            (F.coalesce(F.get(starts, n + 1), F.size(places)) - low).alias("size"))))
        members = lambda run: F.transform(
            F.slice(places, run["low"] + 1, run["size"]), lambda place: F.get(records, place["at"]))
        return F.transform(runs, lambda run: bound_once(members(run), summary))

    return bound_once(records, sort)


def consequence_groups(annotations: Column) -> Column:
    """Annotations of the line grouped by (symbol, amino-acid change, consequence set, coding change, strand).

    The first annotation of a group supplies gene id, impact, scores, predictions and biotype."""
    return _in_groups(annotations, _group_key, _summary)


def _summary(members: Column) -> Column:
    first = members[0]
    return F.struct(
        first["pos"].alias("pos"),
        first["symbol"].alias("geneAffectedSymbol"),
        F.when(first["symbol"].isNotNull(), first["gene_id"]).alias("geneAffectedId"),
        first["aa_change"].alias("aaChange"),
        first["cdna_change"].alias("cdnaChange"),
        first["consequence"].alias("consequence"),
        first["impact"].alias("impact"),
        first["strand"].alias("strand"),
        first["biotype"].alias("biotype"),
        F.exists(members, lambda m: m["canonical"]).alias("canonical"),
        F.exists(members, lambda m: m["pick"].isNotNull()).alias("pick"),
        F.when(first["phylop17way"].isNotNull(), F.struct(first["phylop17way"].alias("PhyloP17Way")))
        .alias("conservationsScores"),
        first["predictions"].alias("predictions"),
        F.transform(members, lambda m: F.struct(
            m["feature_id"].alias("featureId"), m["feature_type"].alias("featureType"), m["exon"].alias("exon"),
            m["refseq_id"].alias("refSeqId"), m["canonical"].alias("canonical"), m["pick"].alias("pick"),
            m["clinvar_omim"].alias("clinvar_OMIM_id"), m["clinvar_orphanet"].alias("clinvar_Orphanet_id"),
        )).alias("transcripts"),
    )


def genes_of(annotations: Column) -> Column:
    """Distinct (gene id, symbol) of the line with the biotype seen first; records without a gene id have none."""
    fields = lambda a: F.struct(
        a["gene_id"].alias("ensemblId"), a["symbol"].alias("geneSymbol"), a["biotype"].alias("biotype"))
    named = F.transform(F.filter(annotations, lambda a: a["gene_id"].isNotNull()), fields)
    return _in_groups(named, lambda g: F.struct(g["ensemblId"], g["geneSymbol"]), lambda members: F.get(members, F.lit(0)))
