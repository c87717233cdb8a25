"""The remaining whole jobs: ranked-report scores (I2), gene index (I3), load validation (I4), older extract."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.functions.keys import is_primary_contig
from variantloom.operators.grouping import last_by_key
from variantloom.operators import exomiser as ex, genes as gn, legacy as lg, merge as m, validation as va
from variantloom.plans import state_store
from variantloom.session import checkpoint_dir
from variantloom.sources import extract
from variantloom.sources.sinks import remove, write_merged, write_table


def score_job(report: DataFrame, state: dict[str, DataFrame], specimen: str, updated: Column, target: str,
              build: str = "GRCh38") -> None:
    """Scores of one proband's report go to its donors. Variants not stored yet become stubs, one per key, with the
    scored sample as their donor; they are part of the state, so that the next batch finds them."""
    sample = ex.specimen_id(F.lit(specimen))
    scores = ex.score_rows(ex.flatten_report(report), build, sample, updated).withColumns({
        "exomiserScore": F.col("exomiser_score").cast("double"), "lastUpdate": F.col("last_update"),
        "specimenId": F.col("specimen"), "mutationId": F.col("mutation_id")})
    donors, absent = m.merge_scores(
        state["donors"], state["variants"], scores, "uid", "specimenId", "exomiserScore", "lastUpdate")
    stubs = m.one_stub_per_key(absent.withColumn("_modes", F.to_json("transmission")), "uid", F.col("exomiserScore"), "specimenId", "_modes").drop("_modes")
    as_in = lambda name: stubs.select(*[c for c in state[name].columns if c in stubs.columns])
    grown = {
        "donors": donors.select(*state["donors"].columns).unionByName(as_in("donors"), allowMissingColumns=True),
        "variants": state["variants"].unionByName(as_in("variants"), allowMissingColumns=True),
    }
    write_merged({**state, **grown, "score_stubs": stubs}, target)


def gene_index_job(gene_info: DataFrame, members: DataFrame, target: str) -> None:
    write_table(gn.gene_index(gene_info, members), target)


def load_check(rows: DataFrame, stored: DataFrame | None = None, root: str | None = None) -> dict[str, DataFrame]:
    """Extract rows of all contigs, with keys, against the stored variants: a table, or the state at ``root``, of which only
    the ranges that the extract has keys of are read (E12, F13-F16).

    ``statistics`` is one row of counters and the verdict, ``duplicates`` the keys that several lines have,
    ``collisions`` the keys that stand for different variants. The extract is read once: the pass that writes its
    keys counts all lines and records before any is left out. A line whose position is no number is an error."""
    spark = rows.sparkSession
    work = f"{checkpoint_dir(spark)}/load-check-{uuid.uuid4().hex}"
    records = F.when(F.col("csq") != "", F.size(F.split("csq", ","))) if "csq" in rows.columns else F.lit(0)
    lines, seen = va.observed_lines(
        rows.select("chrom", "pos", "uid", "mutation_id", *[c for c in ("csq",) if c in rows.columns]),
        ~is_primary_contig(F.col("chrom")), F.col("pos").isNull(), records)
    write_table(lines.where(F.col("status").isNull()).select("uid", "mutation_id"), f"{work}/keys")
    counted = seen.get
    write_table(va.key_summary(spark.read.schema("uid string, mutation_id string").parquet(f"{work}/keys"), "uid", "mutation_id"), f"{work}/summary")
    remove(spark, f"{work}/keys")
    summary = spark.read.schema("uid string, n bigint, identity string, _other string").parquet(f"{work}/summary")
    if root is not None:
        state_store.finish(spark, root)
        ranges = state_store.range_of("uid", state_store.stored_digits(spark, root))
        ranges = [r[0] for r in summary.select(ranges).distinct().collect()]  # no more than there are ranges
        stored = state_store.read_ranges(spark, root, "variants", ranges)
    judged = va.against_state(summary, stored, "uid", "mutationId" if "mutationId" in stored.columns else None)
    n = lambda found: F.coalesce(F.sum(F.when(F.col("found") == found, F.col("n"))), F.lit(0)).cast("bigint")
    figures = {k: F.lit(int(counted[k])).cast("bigint").alias(k) for k in ("processed", "discarded", "errors", "annotations")}
    statistics = judged.agg(n(True).alias("found"), n(False).alias("not_found")).select(
        figures["processed"], "found", "not_found", figures["discarded"], figures["errors"], figures["annotations"])
    total = F.col("found") + F.col("not_found") + F.col("discarded") + F.col("errors")
    statistics = statistics.withColumns({
        "total": total, "verdict": F.when(F.col("not_found") == 0, "passed").otherwise("failed"),
        "average": F.when(F.col("processed") > 0, F.col("annotations") / F.col("processed")).otherwise(F.lit(0.0)),
    })
    return {
        "statistics": statistics, "duplicates": judged.where("n > 1").select("uid", "n"),
        "collisions": judged.where("collides").select("uid", "n", F.col("identity").alias("mutation_id"), "stored"),
    }


def validation_job(lines: DataFrame, stored: DataFrame, build: str = "GRCh38") -> DataFrame:
    """One row of load statistics for an extract against the stored variants."""
    columns = extract.header_columns(lines)
    rows = extract.with_keys(extract.parse_lines(lines, columns, primary_only=False), build)
    return load_check(rows, stored)["statistics"]


def legacy_job(rows: DataFrame, target: str, state: str | None = None, **donor: Column) -> None:
    """Older extract: variants once per key, donors appended per (key, donor). Of repeated lines the first by content
    counts, whatever the partitions; a variant that comes again is stored anew (H6)."""
    documents = lg.variant_documents(rows, **donor)
    columns = [c for c in documents.columns if c not in ("uid", "donor")]
    by_content = [F.to_json(F.struct(*columns, "donor"))]
    variants = last_by_key(documents, ["uid"], by_content).drop("donor")
    owned = documents.withColumn("donorId", F.col("donor.donorId"))
    donors = last_by_key(owned, ["uid", "donorId"], by_content).select("uid", "donor.*")
    if state is not None:
        spark = rows.sparkSession
        old_variants, old_donors = (spark.read.parquet(f"{state}/{n}") for n in ("variants", "donors"))
        variants = old_variants.join(variants.select("uid"), "uid", "left_anti").unionByName(variants)
        donors = m.append_missing(old_donors, donors, "uid", "donorId")
    write_merged({"variants": variants, "donors": donors}, target)
