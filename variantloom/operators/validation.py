"""Load validation and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def classify_load(extract: DataFrame, stored: DataFrame, key: str, discarded: Column) -> DataFrame:
    """Extract rows with ``status``: discarded, found or not_found."""
    known = stored.select(key).distinct().withColumn("_found", F.lit(True))
    kept = extract.withColumn("_discarded", discarded)
    # a discarded row keeps no join key, so discarded contigs do not pile up on any task
    joined = kept.withColumn(key, F.when(~F.col("_discarded"), F.col(key))).join(known, key, "left")
    return joined.withColumn(
        "status", F.when(F.col("_discarded"), "discarded").when(F.col("_found"), "found").otherwise("not_found")
    ).drop("_found", "_discarded")


def load_statistics(classified: DataFrame) -> DataFrame:
    """One row of counters and the verdict."""
    n = lambda s: F.count(F.when(F.col("status") == s, 1))
    counted = classified.agg(
        F.count(F.lit(1)).alias("processed"), n("found").alias("found"), n("not_found").alias("not_found"),
        n("discarded").alias("discarded"), n("error").alias("errors"))
    total = F.col("found") + F.col("not_found") + F.col("discarded") + F.col("errors")
    return counted.withColumn("total", total).withColumn(
        "verdict", F.when(F.col("not_found") == 0, "passed").otherwise("failed"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def key_collisions(df: DataFrame, key: str, identity: str) -> DataFrame:
    """Keys that stand for more than one identity. Distinct first, so a hot key collapses before the count."""
    return df.select(key, identity).distinct().groupBy(key).agg(
        F.count(F.lit(1)).alias("identities")).where("identities > 1")


def annotation_statistics(df: DataFrame, annotations: Column) -> DataFrame:
    n = F.size(annotations)
    return df.agg(
        F.count(F.lit(1)).alias("variants"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("annotations"),
        F.avg(n).alias("average"))


def observed_lines(rows: DataFrame, discarded: Column, unreadable: Column, records: Column) -> tuple[DataFrame, Observation]:
    """(lines with ``status``: discarded, error or null, the counters of all lines). The counters are gathered by the pass
    that writes or reads these lines; they are there once it has run."""
    seen = Observation("load")
    judged = rows.withColumn("status", F.when(discarded, "discarded").when(unreadable, "error"))
    n = lambda s: F.count(F.when(F.col("status") == s, 1))
    return judged.observe(
        seen, F.count(F.lit(1)).alias("processed"), n("discarded").alias("discarded"), n("error").alias("errors"),
        F.coalesce(F.sum(records), F.lit(0)).cast("bigint").alias("annotations")), seen


def key_summary(lines: DataFrame, key: str, identity: str) -> DataFrame:
    """One row per key: how many lines have it, and their least and greatest identity. Reduced before the exchange."""
    return lines.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min(identity).alias("identity"), F.max(identity).alias("_other"))


def against_state(summary: DataFrame, stored: DataFrame, key: str, identity: str | None = None) -> DataFrame:
    """The summary with ``found``, the stored identity and ``collides``: another identity has the same key, in the extract
    or in the state; case does not count."""
    known = stored.select(key, F.col(identity).alias("stored") if identity else F.lit(None).cast("string").alias("stored"),
                          F.lit(True).alias("_found"))
    joined = summary.join(known, key, "left")
    other = (F.lower("identity") != F.lower("_other")) | F.coalesce(F.lower("identity") != F.lower("stored"), F.lit(False))
    return joined.withColumn("found", F.coalesce("_found", F.lit(False))).withColumn("collides", other).drop("_found", "_other")
