"""Multi-sample extract files (A1-A4, B1, B2)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from variantloom.functions.keys import clean_alt, contig, dna_change, is_primary_contig, mutation_id, variant_uid

# Extract column -> name used here. Columns are bound by name, so their order and extra
# columns do not matter.
COLUMN_NAMES = {
    "CHROM": "chrom", "POS": "pos", "REF": "ref", "ALT": "alt", "FILTER": "filter", "DP": "dp", "MQ": "mq", "QD": "qd",
    "GEN[*].GT": "gt", "GEN[*].AD": "ad", "GEN[*].GQ": "gq", "CSQ": "csq",
}
LISTS = ("gt", "ad", "gq")


def read_lines(spark: SparkSession, path: str, partitions: int | None = None, with_file: bool = False) -> DataFrame:
    """Text lines; splits follow ``spark.sql.files.maxPartitionBytes`` unless a number is asked for. ``with_file`` adds
    ``_file``, the file that a line comes from."""
    lines = spark.read.text(path)
    if with_file:
        lines = lines.select("value", _plain_path(F.col("_metadata.file_path")).alias("_file"))
    return lines.repartition(partitions) if partitions else lines


def _plain_path(path: Column) -> Column:
    """A file's path in one spelling: readers write a local one with one or with three slashes."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def _as_path(file: str) -> str:
    """A listed file, which is a URI, as a path to read: nothing in its name is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def is_header(value) -> F.Column:
    return F.upper(F.substring_index(value, "\t", 1)).isin("CHROM", "#CHROM")


def header_columns(lines: DataFrame, value: str = "value") -> list[str]:
    """Column names of the extract: the one header row without ``#``. Reads one row."""
    row = lines.where(F.upper(F.col(value)).startswith("CHROM\t")).select(value).first()
    if row is None:
        raise ValueError("extract without a CHROM header row")
    return row[0].split("\t")


def sample_list(header_rows: DataFrame, value: str = "value") -> DataFrame:
    """(idx, specimen) of the columns behind FORMAT in a sample header row; names get the prefix SP."""
    cells = F.split(F.col(value), "\t")
    start = F.array_position(F.transform(cells, F.upper), F.lit("FORMAT")).cast("int")
    others = [c for c in header_rows.columns if c != value]
    rows = header_rows.where(F.col(value).startswith("#")).select(
        *others,
        F.posexplode(F.slice(cells, start + 1, F.greatest(F.size(cells) - start, F.lit(0)))).alias("idx", "_name"))
    name = F.col("_name")
    return rows.select(
        *others, "idx", F.when(name.startswith("SP"), name).otherwise(F.concat(F.lit("SP"), name)).alias("specimen"))


def parse_lines(lines: DataFrame, columns: Sequence[str] | None = None, value: str = "value", primary_only: bool = True,
                places: str | None = None) -> DataFrame:
    """Typed extract rows. Header rows and, first of all, minor contigs are dropped before a line is split.

    ``columns`` are the header's names for all lines; or ``places`` is a column with the line's own struct of cell numbers."""
    first = F.substring_index(F.col(value), "\t", 1)
    kept = lines.where(~is_header(F.col(value)))
    if primary_only:
        kept = kept.where(is_primary_contig(first))
    at = {name: i for i, name in enumerate(columns or ())}
    others = [c for c in lines.columns if c not in (value, places)]
    cells = kept.select(*others, *([places] if places else []), F.split(F.col(value), "\t").alias("_cells"))

    def cell(source: str, name: str) -> Column:
        if places:
            return F.get("_cells", F.col(places)[name])
        return F.get("_cells", F.lit(at[source])) if source in at else F.lit(None).cast("string")

    typed = cells.select(
        *others,
        *[
            (F.split(cell(source, name), ",") if name in LISTS else cell(source, name)).alias(name)
            for source, name in COLUMN_NAMES.items()
        ],
    )
    return typed.withColumns({
        "contig": contig(F.col("chrom")), "pos": F.col("pos").try_cast("bigint"), "alt": clean_alt(F.col("alt")),
    })


def with_keys(rows: DataFrame, build: str) -> DataFrame:
    """Adds ``dna_change``, ``mutation_id`` and ``uid``."""
    key = mutation_id(F.col("contig"), F.col("pos"), F.col("ref"), F.col("alt"))
    return rows.withColumn("dna_change", dna_change(F.col("ref"), F.col("alt"))).withColumn(
        "mutation_id", key).withColumn("uid", variant_uid(F.col("mutation_id"), build))


#: Header rows of all files together, in bytes, up to which they are broadcast to the lines.
BROADCAST_BYTES = 32_000_000


def file_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The header of each file. It stands in front, so one short task a file reads it, not a pass over all lines."""
    files = sorted(spark.read.text(path).inputFiles())
    return {file: header_columns(spark.read.text(_as_path(file))) for file in files}


def with_places(lines: DataFrame, headers: dict[str, list[str]], file: str = "_file") -> DataFrame:
    """Adds ``_places``: where in a line of its file each column stands (null: the file has no such column)."""
    numbers = [(name, *(columns.index(c) if c in columns else None for c in COLUMN_NAMES)) for name, columns in headers.items()]
    names = list(COLUMN_NAMES.values())
    schema = "_name string, " + ", ".join(f"{n} int" for n in names)
    table = lines.sparkSession.createDataFrame(numbers, schema).select(_plain_path(F.col("_name")).alias(file), F.struct(*names).alias("_places"))
    small = sum(len(name) + 4 * len(names) for name in headers) <= BROADCAST_BYTES
    return lines.join(F.broadcast(table) if small else table, file).drop(file)


def read_extract(spark: SparkSession, path: str, build: str = "GRCh38", partitions: int | None = None,
                 primary_only: bool = True) -> DataFrame:
    """Keyed rows of one or many extract files. Each file's lines are bound by its own header."""
    headers = file_headers(spark, path)
    lines = read_lines(spark, path, partitions, with_file=len({tuple(h) for h in headers.values()}) > 1)
    if "_file" in lines.columns:
        rows = parse_lines(with_places(lines, headers), primary_only=primary_only, places="_places")
    else:
        rows = parse_lines(lines, next(iter(headers.values())), primary_only=primary_only)
    return with_keys(rows, build)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """(idx, specimen) of the sample columns, from the sample header rows in front of the files, which must agree."""
    found = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        row = spark.read.text(_as_path(file)).where(F.upper(F.col("value")).rlike("^#CHROM\t(.*\t)?FORMAT(\t|$)")).first()
        if row is not None:
            cells = row[0].split("\t")
            found.setdefault(tuple(cells[[c.upper() for c in cells].index("FORMAT"):]), (file, row[0]))
    if len(found) != 1:
        raise ValueError(f"{len(found)} different sample lists in {sorted(f for f, _ in found.values())}")
    (_, text), = found.values()
    return sample_list(spark.createDataFrame([(text,)], "value string"))
