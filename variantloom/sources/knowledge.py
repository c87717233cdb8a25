"""Gene cross references, gene-set members, ranked reports, older wide extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from variantloom import schemas
from variantloom.operators.legacy import COLUMNS


def read_gene_info(spark: SparkSession, path: str) -> DataFrame:
    """Cross-reference file: header row, tab separated, the first six columns."""
    schema = ", ".join(f"{name} string" for name in schemas.GENE_INFO_HEAD)
    return spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=True, quote="")


def read_gene_members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GENE_MEMBERS).parquet(path)


def read_ranked_report(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(schemas.RANKED_REPORT).json(path, multiLine=multiline)


def parse_legacy_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """130 named text columns; the header row is dropped."""
    kept = lines.where(F.upper(F.substring_index(F.col(value), "\t", 1)) != "CHROM")
    cells = kept.select(*[c for c in lines.columns if c != value], F.split(F.col(value), "\t").alias("_cells"))
    return cells.select(
        *[c for c in lines.columns if c != value],
        *[F.coalesce(F.get("_cells", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(COLUMNS)])


def read_legacy_extract(spark: SparkSession, path: str) -> DataFrame:
    return parse_legacy_lines(spark.read.text(path))
