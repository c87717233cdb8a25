"""Line dedup: lines that many sites share are boilerplate and stay only where they stand first.

One aggregation gives each line hash a HyperLogLog sketch of its sites and its first place. A sketch decides alone
where its estimate is far from the threshold; lines near it are counted exactly."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import stage

#: Sites on which a line must stand to be boilerplate.
SITES = 10
#: log2 of a sketch's registers: a standard error of 1.6 %.
SKETCH_BITS = 12
#: Lines whose estimate lies within threshold / BAND and threshold * BAND are counted exactly; that is over 20
#: standard errors on either side.
BAND = 1.5
_SPACE = " \t\n\x0b\x0c\r"


def line_hash(line: Column) -> tuple[Column, Column]:
    """128 bits of a line without the white space around it."""
    return F.xxhash64(line), F.xxhash64(F.lit(7), line)


def lines_of(docs: DataFrame, *columns: str) -> DataFrame:
    """One row per line that has a word: the given columns, ``_text`` (a hash of the whole text, which tells apart
    rows with one id), ``pos`` and the line's hash ``h1, h2``."""
    lines = docs.select(*columns, F.xxhash64("text").alias("_text"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = F.btrim("line", F.lit(_SPACE))
    h1, h2 = line_hash(key)
    return lines.filter(key != "").select(*columns, "_text", "pos", h1.alias("h1"), h2.alias("h2"))


def spread_lines(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """The hashes of lines on at least ``sites`` sites, with the place (id, position) where each stands first.

    Null sites count for nothing; null ids come after all others."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "pos")
    found = stage(
        lines_of(docs, "doc_id", site)
        .groupBy("h1", "h2")
        .agg(
            F.hll_sketch_agg(F.col(site).cast("string"), F.lit(SKETCH_BITS)).alias("sketch"),
            F.min(place).alias("first"),
        )
        .select("h1", "h2", "first", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("estimate"))
        .filter(F.col("estimate") >= sites / BAND),
        "line-spread",
    )
    near = found.filter(F.col("estimate") < sites * BAND)
    exact = (
        lines_of(docs, "doc_id", site)
        .join(near.select("h1", "h2"), ["h1", "h2"])
        .select("h1", "h2", site)
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(site).alias("n"))
        .filter(F.col("n") >= sites)
        .select("h1", "h2")
    )
    sure = found.filter(F.col("estimate") >= sites * BAND)
    return sure.select("h1", "h2", "first").unionByName(near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def removed_lines(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """Per document (``doc_id``, ``_text``) the positions of the lines that go."""
    spread = stage(spread_lines(docs, site, sites), "line-boilerplate")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))
    gone = lines_of(docs, "doc_id").join(spread, ["h1", "h2"]).filter(~first).select("doc_id", "_text", "pos")
    return gone.distinct().groupBy("doc_id", "_text").agg(F.collect_list("pos").alias("_gone"))


def without_boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """The documents with their own columns and all their rows, their texts without boilerplate lines, and
    ``n_lines`` (lines with a word) and ``n_removed``.

    A line is compared without the white space around it and kept or removed as it is. A document keeps its row even
    if no line of it stays. Null texts stay null and have no line; rows that repeat an id and a text are one
    document; columns of the names above are replaced. ``n_chars``, if there is one, follows the text."""
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    rest = [c for c in own if c != "text"]
    gone = removed_lines(docs, site, sites).select(F.col("doc_id").alias("id"), F.col("_text").alias("same"), F.col("_gone").alias("gone"))
    # the other columns travel in one struct, whatever their names
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), "text", F.xxhash64("text").alias("hash"))
    joined = wide.join(gone, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("same")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for text, drop in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                counts.append(sum(bool(x.strip(_SPACE)) for x in lines))
                removed.append(len(drop or ()))
                if drop:
                    out = set(drop)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in out)
                texts.append(text)
            arrays = [pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], ["row", "text", "n_lines", "n_removed"])

    joined = joined.select("row", "text", "gone")
    out = joined.mapInArrow(cut, f"row {joined.schema['row'].dataType.simpleString()}, text string, n_lines long, n_removed long")

    def column(name: str) -> Column:
        kept = F.col("row").getField(name) if name != "text" else F.col("text")
        if name == "n_chars":
            kept = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema[name].dataType)).otherwise(kept)
        return kept.alias(name)

    return out.select(*map(column, own), "n_lines", "n_removed")


def digest(docs: DataFrame) -> DataFrame:
    """What ``without_boilerplate`` did: one row per document with the crypto hash of the text that stays."""
    out = without_boilerplate(docs.select("doc_id", "text", "source"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = """
WITH cut AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
), placed AS (
  SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut WHERE text IS NOT NULL
), keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM placed
), worded AS (
  SELECT * FROM keyed WHERE trimmed <> ''
), spread AS (
  SELECT trimmed FROM worded GROUP BY trimmed HAVING count(DISTINCT source) >= 10
), judged AS (
  SELECT w.doc_id, w.pos,
    row_number() OVER (PARTITION BY w.trimmed ORDER BY w.doc_id, w.pos) > 1 AND s.trimmed IS NOT NULL AS gone
  FROM worded w LEFT JOIN spread s ON w.trimmed = s.trimmed
), kept AS (
  SELECT p.doc_id, count(j.pos) AS n_lines, count(*) FILTER (j.gone) AS n_removed,
    string_agg(p.line, chr(10) ORDER BY p.pos) FILTER (j.gone IS NOT TRUE) AS kept
  FROM placed p LEFT JOIN judged j ON p.doc_id = j.doc_id AND p.pos = j.pos GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
