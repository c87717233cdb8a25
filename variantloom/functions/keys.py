"""Contig, allele and document-key expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NON_REF = ",<NON_REF>"


def contig(chrom: Column) -> Column:
    """Chromosome name without its three-character prefix."""
    return F.substring(chrom, 4, 1 << 20)


def is_primary_contig(chrom: Column) -> Column:
    return F.length(contig(chrom)) <= 2


def clean_alt(alt: Column) -> Column:
    return F.replace(alt, F.lit(NON_REF), F.lit(""))


def first_alt(alt: Column) -> Column:
    return F.substring_index(clean_alt(alt), ",", 1)


def dna_change(ref: Column, alt: Column) -> Column:
    return F.concat(ref, F.lit(">"), first_alt(alt))


def mutation_id(contig_name: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat(F.lit("chr"), contig_name, F.lit(":g."), pos.cast("string"), dna_change(ref, alt))


def md5_hex(text: Column) -> Column:
    return F.upper(F.md5(text))


def sha1_hex(text: Column) -> Column:
    return F.upper(F.sha1(text))


def sha256_hex(text: Column) -> Column:
    return F.upper(F.sha2(text, 256))


def variant_uid(mutation: Column, build: Column | str) -> Column:
    build = F.lit(build) if isinstance(build, str) else build
    return md5_hex(F.concat(mutation, F.lit("@"), build))


def legacy_mutation_id(contig_name: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """Older key form: the prefix sits in front of the reference allele."""
    return F.concat(contig_name, F.lit(":g."), pos.cast("string"), F.lit("chr"), dna_change(ref, alt))


def ranked_report_contig(chrom: Column) -> Column:
    """Phenotype-ranked reports number X as 23; other numbers stay."""
    return F.when(chrom == 23, "X").otherwise(chrom.cast("string"))
