"""Pedigree files, cohort property files, patient documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from variantloom import schemas
from variantloom.operators.clinical import patients_from_lists

# Property keys holding one entry per sample.
LISTED = (
    "specimen", "relation", "patientId", "familyId", "studyId", "gender", "organizationId", "laboName", "isProband",
    "isAffected", "practitionerId",
)
COUNTED = ("HpoQtyTerms", "hpoTermsPos", "linkQty", "linkPatient", "linkSpecimen")
SCALARS = ("sequencingStrategy", "assemblyVersion", "annotationTool")


def parse_pedigree(lines: DataFrame, value: str = "value") -> DataFrame:
    """Six named columns; any run of blanks or tabs separates, blank lines are skipped."""
    names = [field.split()[0] for field in schemas.PEDIGREE.split(",")]
    cells = lines.where(F.trim(value) != "").select(
        *[c for c in lines.columns if c != value], F.split(F.trim(value), r"\s+").alias("_cells"))
    return cells.select(
        *[c for c in lines.columns if c != value], *[F.get("_cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_pedigree(spark: SparkSession, path: str, stop_at_blank: bool = False) -> DataFrame:
    """``stop_at_blank`` ends each file at its first blank line."""
    if not stop_at_blank:
        return parse_pedigree(spark.read.text(path))
    rows = F.transform(F.split("value", "\n"), lambda row: F.regexp_replace(row, "\r$", ""))
    blank = F.array_position(rows, F.lit("")).cast("int")
    kept = F.when(blank > 0, F.slice(rows, F.lit(1), blank - 1)).otherwise(rows)
    return parse_pedigree(spark.read.text(path, wholetext=True).select(F.explode(kept).alias("value")))


def parse_properties(rows: DataFrame, owner: str = "owner", key: str = "key", value: str = "value") -> DataFrame:
    """Key/value rows -> one row per sample. Both spellings of the proband key are read."""
    named = rows.withColumn(key, F.when(F.col(key) == "isProban", "isProband").otherwise(F.col(key)))
    wide = named.groupBy(owner).pivot(key, [*LISTED, *COUNTED, *SCALARS]).agg(F.first(value))
    samples = patients_from_lists(
        wide, owner, LISTED, "HpoQtyTerms", "hpoTermsPos", "linkQty", "linkPatient", "linkSpecimen")
    typed = samples.withColumns({c: F.lower(F.trim(c)) == "true" for c in ("isProband", "isAffected")})
    return typed.join(wide.select(owner, *SCALARS), owner)


def read_properties(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(F.input_file_name().alias("owner"), F.trim("value").alias("_line"))
    entries = lines.where((F.col("_line") != "") & ~F.col("_line").startswith("#"))
    return parse_properties(entries.select(
        "owner", F.trim(F.substring_index("_line", "=", 1)).alias("key"),
        F.trim(F.expr("substr(_line, instr(_line, '=') + 1)")).alias("value")))


def read_patients(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return spark.read.schema(schemas.PATIENT_DOCUMENT).format(format).load(path)
