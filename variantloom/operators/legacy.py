"""Older 130-column extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.functions.fields import double_or_null, long_or_null
from variantloom.functions.keys import clean_alt, contig, legacy_mutation_id, sha1_hex


def _population_names(prefix: str, groups: Sequence[str], parts: Sequence[str]) -> tuple[str, ...]:
    """Column names of one population source: its totals, then the same parts per sub-population."""
    return tuple("_".join(filter(None, (prefix, group, part))) for group in groups for part in parts)


# Sources with their sub-populations ("" is the total) and parts, in column order.
SOURCES = {
    "ExAc": ("exAC", ("", "SAS", "ADJ", "AFR", "FIN", "AMR", "NFE", "EAS"), ("AC", "AF")),
    "1000Gp3": ("d1000Gp3", ("", "AMR", "EAS", "EUR", "AFR", "SAS"), ("AC", "AF")),
    "ESP6500": ("ESP6500", ("EA", "AA"), ("AC", "AF")),
    "gnomAD_exomes": ("gnomAD_exomes", ("", "AFR", "AMR", "ASJ", "EAS", "FIN", "NFE", "SAS"), ("AC", "AN", "AF")),
    "gnomAD_genomes": ("gnomAD_genomes", ("", "AFR", "AMR", "ASJ", "EAS", "FIN", "NFE"), ("AC", "AN", "AF")),
}
# Column names up to the population block.
SITE_COLUMNS = ("chrom", "position", "id", "reference", "alt", "af", "dp", "ac", "an", "qual", "unused")
ANNOTATION_COLUMNS = (
    "allele", "effet", "impact", "gene", "geneId", "featureType", "featureId", "biotype", "hgvsC", "hgvsP", "cdnaPos",
    "cdnaLen", "cdsPos", "cdsLen", "aaPos", "aaLen", "distance", "rank", "errors",
)
FLAG_COLUMNS = ("lof", "nmd", "snp", "mnp", "ins", "del", "mixed", "hom", "het")
TAIL_COLUMNS = ("clinvar_id", "clinvar_clnsig", "clinvar_trait", "clinvar_hgvs", "gq", "ac2", "gt", "ad")
PREDICTION_COLUMNS = {
    "FATHMM": "FATHMM_pred", "Polyphen2_HDIV": "Polyphen2_HDIV_pred", "Polyphen2_HVAR": "Polyphen2_HVAR_pred",
    "SIFT": "SIFT_pred",
}


def population_columns(source: str) -> tuple[str, ...]:
    return _population_names(*SOURCES[source])


FIRST_VALUE_COLUMNS = (
    *population_columns("ExAc"), "GERP___RS", "GERP___NR", *population_columns("1000Gp3"), "FATHMM_pred",
    "Polyphen2_HDIV_pred", "Polyphen2_HVAR_pred", *population_columns("ESP6500"), "SIFT_pred",
    *population_columns("gnomAD_exomes"), *population_columns("gnomAD_genomes"),
)
COLUMNS = (*SITE_COLUMNS, *ANNOTATION_COLUMNS, *FLAG_COLUMNS, *FIRST_VALUE_COLUMNS, *TAIL_COLUMNS)


def first_values(df: DataFrame, columns: Sequence[str] = FIRST_VALUE_COLUMNS) -> DataFrame:
    """First entry of each comma list."""
    return df.withColumns({c: F.trim(F.substring_index(F.col(c), ",", 1)) for c in columns})


def population(source: str, columns: Sequence[str] | None = None) -> Column:
    """Typed optional members of one source plus whether any is present."""
    columns = population_columns(source) if columns is None else columns
    prefix = SOURCES[source][0] + "_"
    typed = {
        c: (double_or_null(F.col(c)) if c.endswith("AF") else long_or_null(F.col(c))) for c in columns
    }
    present = F.coalesce(*[v.cast("string") for v in typed.values()]).isNotNull()
    return F.struct(*[v.alias(c.removeprefix(prefix)) for c, v in typed.items()], present.alias("available"))


def variant_type(snp: Column, mnp: Column, ins: Column, dele: Column, mixed: Column) -> Column:
    """The last true flag in the order SNP, MNP, INS, DEL, MIXED wins."""
    return (
        F.when(mixed, "MIXED").when(dele, "DEL").when(ins, "INS").when(mnp, "MNP").when(snp, "SNP")
    )


def optional(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def annotation_structs(columns: dict[str, Column]) -> Column:
    """Parallel comma lists -> one array of structs; positions and lengths are kept only where meaningful.

    ``columns`` maps each of ANNOTATION_COLUMNS to an array column."""
    n = F.size(columns["allele"])

    def one(i: Column) -> Column:
        text = lambda c: F.get(columns[c], i)
        filled = lambda c: optional(text(c))
        number = lambda c: filled(c).try_cast("int")
        above = lambda c, low: F.when(number(c) >= low, number(c))
        length = lambda c, gate, low: F.when(number(gate) >= low, number(c))
        return F.struct(
            text("allele").alias("allele"), text("effet").alias("effet"), text("impact").alias("impact"),
            filled("gene").alias("gene"), filled("geneId").alias("geneId"), text("featureType").alias("featureType"),
            text("featureId").alias("featureId"), filled("biotype").alias("biotype"), above("rank", 1).alias("rank"),
            filled("hgvsC").alias("hgvsC"), filled("hgvsP").alias("hgvsP"),
            above("cdnaPos", 1).alias("cdnaPos"), length("cdnaLen", "cdnaPos", 1).alias("cdnaLen"),
            above("cdsPos", 0).alias("cdsPos"), length("cdsLen", "cdsPos", 0).alias("cdsLen"),
            above("aaPos", 0).alias("aaPos"), length("aaLen", "aaPos", 0).alias("aaLen"),
            number("distance").alias("distance"), filled("errors").alias("errors"),
        )

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one))


def donor(**constants: Column) -> Column:
    """Donor struct: family, patient, study and strategy come from the job, depth and zygosity from the line."""
    zygosity = F.when(F.col("het"), "Het").when(F.col("hom"), "Hom")
    return F.struct(
        *[v.alias(k) for k, v in constants.items()],
        optional(F.col("dp")).try_cast("int").alias("depth"), F.trim("qual").try_cast("double").alias("quality"),
        zygosity.alias("zygosity"),
    )


def predictions() -> Column:
    values = {name: optional(F.col(c)) for name, c in PREDICTION_COLUMNS.items()}
    return F.struct(
        *[v.alias(k) for k, v in values.items()], F.coalesce(*values.values()).isNotNull().alias("available"))


def variant_documents(rows: DataFrame, **donor_constants: Column) -> DataFrame:
    """Whole line -> one nested variant row, in a single narrow pass."""
    truth = lambda c: F.coalesce(F.trim(c).try_cast("boolean"), F.lit(False)).alias(c)
    flags = {c: truth(c) for c in ("snp", "mnp", "ins", "del", "mixed", "hom", "het")}
    lists = {c: F.split(F.col(c), ",") for c in ANNOTATION_COLUMNS}
    alt = clean_alt(F.col("alt"))
    mutation = legacy_mutation_id(contig(F.col("chrom")), F.col("position"), F.trim("reference"), alt)
    typed = first_values(rows).withColumns({**flags, **lists})
    return typed.select(
        sha1_hex(mutation).alias("uid"), mutation.alias("mutation_id"), contig(F.col("chrom")).alias("chrom"),
        F.col("position").try_cast("bigint").alias("start"), F.trim("reference").alias("reference"), alt.alias("alt"),
        variant_type(*[F.col(c) for c in ("snp", "mnp", "ins", "del", "mixed")]).alias("type"),
        *[optional(F.col(c)).alias(c) for c in ("af", "ac", "an", *TAIL_COLUMNS)],
        optional(F.col("id")).alias("dbSNP_ID"), optional(F.col("lof")).alias("lossOfFunctionEffect"),
        optional(F.col("nmd")).alias("nonsenseMediatedDecayEffects"),
        *[double_or_null(F.col(c)).alias(c) for c in ("GERP___RS", "GERP___NR")],
        F.struct(*[population(s).alias(s) for s in SOURCES]).alias("frequencies"),
        predictions().alias("predictions"),
        annotation_structs({c: F.col(c) for c in ANNOTATION_COLUMNS}).alias("functionalAnnotations"),
        donor(**donor_constants).alias("donor"),
    )
