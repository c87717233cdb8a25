"""Sharding by rendezvous hashing: every record goes to the shard that scores highest for its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import running_total, stage

#: Parts in which a shard's records are numbered.
SLOT_BUCKETS = 1024


def scores(keys: Sequence[str | Column], weights: Sequence[float]) -> list[Column]:
    """For each shard, weight / -ln(u), where u is a hash of key and shard spread evenly over (0, 1).

    The highest score falls on a shard with a probability in proportion to its weight. A score depends on no
    other shard, so a shard that is added or grows only takes records, and one that goes only gives its own."""
    if not weights or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights are positive, or zero for a shard that takes nothing")

    def score(shard: int, weight: float) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard)), 11)
        return F.lit(float(weight)) / -F.log((draw + F.lit(0.5)) * F.lit(2.0**-53))

    return [score(i, w) for i, w in enumerate(weights)]


def highest(of: Sequence[Column]) -> Column:
    """The number of the highest score; of equal ones the first."""
    ranked = [F.struct(s.alias("score"), F.lit(-i).alias("rank")) for i, s in enumerate(of)]
    return (-F.array_max(F.array(*ranked))["rank"]).cast("int")


def shard_records(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], grown_weight: float | None = 1.0
) -> DataFrame:
    """Adds ``shard``, and ``grown_shard``: where the record goes once one more shard of ``grown_weight`` exists.

    Keeps all rows and columns (own columns of these names are replaced). Records with equal keys share a shard;
    a null key is a key like any other. An empty table stays empty."""
    of = scores(keys, [*weights, *([] if grown_weight is None else [grown_weight])])
    df = df.withColumn("shard", highest(of[: len(weights)]))
    return df if grown_weight is None else df.withColumn("grown_shard", highest(of))


def sharded_documents(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document with its size, crc, shard, slot and the shard it has after one more is added.

    Size is the text's UTF-8 length plus 8. A null text counts as empty: size 8, crc 0. Slots number a shard's
    records from 0 without gaps, in an order that only depends on the records."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = stage(shard_records(rows, ["doc_id"], [1.0] * shards), "shards")
    numbered = running_total(placed, ["shard"], F.lit(1), ["doc_id", "text_crc32", "size"], "slot", SLOT_BUCKETS)
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, keys: Sequence[str], weights: Sequence[float], path: str, files: int = 8) -> None:
    """Writes the records as Parquet, a folder ``shard=N`` each, in up to ``files`` files a shard."""
    placed = shard_records(df, keys, weights, None)
    part = F.pmod(F.xxhash64(*keys, F.lit(-1)), F.lit(files))
    placed.repartition(len(weights) * files, "shard", part).write.mode("overwrite").partitionBy("shard").parquet(path)
