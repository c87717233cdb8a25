"""Batch merges into keyed tables.

State is kept flat: one row per variant, per (variant, sample), per (variant, laboratory), per
(gene, variant). Those keys are unique, so no key is hot and every join and union spreads evenly; nested
documents are built from the merged tables afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from variantloom.operators.frequency import COUNTERS, allele_frequency, cohort_frequency
from variantloom.operators.grouping import first_by_content, last_by_key


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def new_members(state: DataFrame, batch: DataFrame, key: str | Sequence[str], specimen: str) -> DataFrame:
    """Batch donors whose sample is not stored yet at that variant; of repeated ones the first by content."""
    on = [*_keys(key), specimen]
    return first_by_content(batch.join(state.select(*on), on, "left_anti"), on)


def merge_donors(state: DataFrame, batch: DataFrame, key: str | Sequence[str], specimen: str) -> DataFrame:
    """Stored donors stay as they are; new ones are appended."""
    return state.unionByName(new_members(state, batch, key, specimen))


def touched_keys(state: DataFrame, batch: DataFrame, key: str | Sequence[str], specimen: str) -> DataFrame:
    """Keys at which the batch brings at least one new donor."""
    return new_members(state, batch, key, specimen).select(*_keys(key)).distinct()


def merge_counters(state: DataFrame, batch: DataFrame, touched: DataFrame, key: str | Sequence[str],
                   sub: Sequence[str] = ()) -> DataFrame:
    """Counters per key (and laboratory): absent key -> insert, touched key -> add the whole batch and
    recompute the frequency, anything else -> unchanged.

    With ``sub`` (the laboratory) a new sub-row of a stored key is inserted only if the key is touched."""
    key, sub = _keys(key), list(sub)
    on = key + sub
    old = state.select(*on, *[F.col(c).alias(f"_old_{c}") for c in (*COUNTERS, "af")], F.lit(True).alias("_stored"))
    new = batch.select(*on, *[F.col(c).alias(f"_new_{c}") for c in (*COUNTERS, "af")], F.lit(True).alias("_came"))
    flags = touched.select(*key, F.lit(True).alias("_touched"))
    joined = old.join(new, on, "full_outer").join(flags, key, "left")
    stored, came, hit = (F.coalesce(c, F.lit(False)) for c in ("_stored", "_came", "_touched"))
    if sub:
        known = state.select(*key).distinct().withColumn("_known", F.lit(True))
        joined = joined.join(known, key, "left")
        joined = joined.where(stored | hit | F.col("_known").isNull())
    merged = joined.select(
        *on,
        *[
            F.when(~stored, F.col(f"_new_{c}")).when(came & hit, F.col(f"_old_{c}") + F.col(f"_new_{c}"))
            .otherwise(F.col(f"_old_{c}")).alias(c)
            for c in COUNTERS
        ],
        F.when(~stored, F.col("_new_af")).when(~(came & hit), F.col("_old_af")).alias("_kept"),
    )
    return merged.select(
        *on, *COUNTERS, F.coalesce(F.col("_kept"), allele_frequency()).alias("af"))


def merge_calls_exactly(state: DataFrame, batch: DataFrame, key: str, specimen: str, gt: str = "gt") -> DataFrame:
    """Exact alternative to counter addition: a sample is counted once whatever the batches repeat."""
    on = [key, specimen]
    columns = [*on, gt]
    fresh = first_by_content(batch.select(*columns).join(state.select(*on), on, "left_anti"), on)
    return cohort_frequency(state.select(*columns).unionByName(fresh.select(*columns)), [key], gt)


def merge_members(state: DataFrame, batch: DataFrame, key: str, member: str) -> DataFrame:
    """Set union per key, one row per (key, member); null members are skipped."""
    rows = state.select(key, member).unionByName(batch.select(key, member))
    return rows.where(F.col(member).isNotNull()).distinct()


def merge_scores(donors: DataFrame, variants: DataFrame, scores: DataFrame, key: str, specimen: str,
                 score: str = "exomiser_score", updated: str = "last_update") -> tuple[DataFrame, DataFrame]:
    """Score merge: (donors with their score, score rows whose variant is not stored).

    A variant ranked under several genes counts with its best score."""
    best = scores.groupBy(key, specimen).agg(
        F.max(score).alias("_score"), F.max(updated).alias("_updated"))
    merged = donors.join(best, [key, specimen], "left")
    merged = merged.withColumns({
        score: F.coalesce(F.col("_score"), F.col(score)) if score in donors.columns else F.col("_score"),
        updated: F.coalesce(F.col("_updated"), F.col(updated)) if updated in donors.columns else F.col("_updated"),
    }).drop("_score", "_updated")
    return merged, scores.join(variants.select(key), key, "left_anti")


def one_stub_per_key(stubs: DataFrame, key: str, score: Column, *ties: str) -> DataFrame:
    """Of the scores whose variant is not stored, the best one per variant: the stub a document store would hold."""
    return last_by_key(stubs, [key], [score.desc(), *[F.col(t) for t in ties]])


def overwrite_by_key(state: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key, the latest version wins."""
    return last_by_key(state.unionByName(batch), [key], [F.col(version).desc()])


def append_missing(state: DataFrame, batch: DataFrame, key: str, member: str) -> DataFrame:
    """Older donor append: the first entry of a (key, patient) stays."""
    return merge_donors(state, batch, key, member)
