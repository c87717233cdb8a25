"""Mixing sources to target weights: fixed-length blocks of words, drawn by shard and joined by index.

A source's documents, one after another, are one run of words, cut into blocks. The mix is a number of output
shards, each with its own counts of blocks per source. The k-th block that a source gives is found by a
pseudorandom permutation of its block numbers; after the last block, a second permutation starts."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import WORD, mixed, running_total, stage

BLOCK_WORDS = 256
#: Blocks of an output shard, on average.
SHARD_BLOCKS = 1024
#: Parts in which the words of a source are counted on.
BUCKETS = 256


@dataclass(frozen=True)
class Plan:
    """What the mix takes: one entry per source. It has a source's totals only, whatever the corpus."""

    sources: list[str | None]
    sizes: np.ndarray
    targets: np.ndarray
    slots: np.ndarray
    last_words: np.ndarray
    block_words: int
    shards: int
    seed: int

    @property
    def blocks(self) -> np.ndarray:
        return -(-self.sizes // self.block_words)


def fill_targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: float) -> np.ndarray:
    """Shares ``total`` by weight; what exceeds ``most`` times a size is shared anew among the others."""
    caps = most * sizes.astype(float)
    targets, free, left = np.zeros(len(sizes)), np.ones(len(sizes), bool), float(total)
    while free.any() and left > 0:
        share = np.where(free, left * weights / weights[free].sum(), 0.0)
        over = free & (share > caps)
        if not over.any():
            targets[free] = share[free]
            break
        targets[over] = caps[over]
        left -= caps[over].sum()
        free &= ~over
    return targets


def permuted(k: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """Maps 0..n-1 onto itself pseudorandomly: a Feistel network on the next even number of bits, walked
    until the value is below n. ``inverse`` goes the other way."""
    if n <= 1:
        return np.zeros_like(k)
    half = np.uint64(max(1, (int(n - 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)

    def network(x: np.ndarray) -> np.ndarray:
        a, b = x >> half, x & low
        for turn in reversed(range(4)) if inverse else range(4):
            salt = key * 8 + turn + 1
            a, b = (b ^ (mixed(a, salt) & low), a) if inverse else (b, a ^ (mixed(b, salt) & low))
        return (a << half) | b

    out = network(k.astype(np.uint64))
    while (far := out >= np.uint64(n)).any():
        out[far] = network(out[far])
    return out.astype(np.int64)


def make_plan(
    totals: Sequence[tuple[str | None, int]], cycle: Sequence[float], share: float, most: float,
    block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = 17,
) -> Plan:
    """Targets and numbers of blocks. Sources stand in code point order, null last, and take the weights in turn.

    A source gives whole blocks until it has reached its target; of the last one, only the words still missing."""
    totals = sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))
    sizes = np.array([n for _, n in totals], np.int64)
    weights = np.array([cycle[i % len(cycle)] for i in range(len(totals))], float)
    targets = fill_targets(sizes, weights, share * float(sizes.sum()), most)
    slots, last = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, (size, target) in enumerate(zip(sizes, targets, strict=True)):
        want = int(min(np.rint(target), np.floor(most * size)))
        if not want:
            continue
        n = -(-int(size) // block_words)
        short = n * block_words - int(size)
        rounds, left = divmod(want, int(size))
        count = rounds * n
        if left:
            key = _key(seed, i, rounds)
            at = int(permuted(np.array([n - 1]), n, key, inverse=True)[0])  # the place of the short block
            more = -(-left // block_words)
            more += more * block_words - (short if at < more else 0) < left
            count += more
            held = block_words - (short if at == more - 1 else 0)
            last[i] = held - (more * block_words - (short if at < more else 0) - left)
        slots[i] = count
    return Plan(
        [s for s, _ in totals], sizes, targets, slots, last, block_words,
        max(1, -(-int(slots.sum()) // shard_blocks)), seed,
    )


def _key(seed: int, source: int, turn: int) -> int:
    return (seed * 1_000_003 + source) * 1_000_003 + turn


def shard_counts(plan: Plan, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks each source gives to an output shard, and those it gave to the shards before.

    Multinomial: a range of shards is halved again and again and every source's count split binomially, with
    a generator seeded by the range. So each shard finds its counts alone, and all counts add up exactly."""
    low, high = 0, plan.shards
    counts, before = plan.slots.copy(), np.zeros_like(plan.slots)
    while high - low > 1:
        middle = (low + high) // 2
        left = np.random.default_rng([plan.seed, low, high]).binomial(counts, (middle - low) / (high - low))
        if shard < middle:
            high, counts = middle, left
        else:
            low, before, counts = middle, before + left, counts - left
    return counts, before


def slots(spark, plan: Plan) -> DataFrame:
    """The mix: one row per block used, ``shard, slot, source_index, turn, block, words`` (the words of it in use)."""
    blocks = plan.blocks

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                counts, before = shard_counts(plan, int(shard))
                source = np.repeat(np.arange(len(counts)), counts)
                k = np.concatenate([np.arange(b, b + c) for b, c in zip(before, counts, strict=True)] or [source])
                order = np.random.default_rng([plan.seed, 1, int(shard)]).permutation(len(source))
                source, k = source[order], k[order].astype(np.int64)
                turn, block = k // np.maximum(blocks[source], 1), np.zeros(len(k), np.int64)
                for s in np.unique(source):
                    for t in np.unique(turn[source == s]):
                        at = np.flatnonzero((source == s) & (turn == t))
                        block[at] = permuted(k[at] - t * blocks[s], int(blocks[s]), _key(plan.seed, int(s), int(t)))
                use = np.where((k == plan.slots[source] - 1) & (plan.last_words[source] > 0), plan.last_words[source], plan.block_words)
                yield pd.DataFrame({
                    "shard": np.int64(shard), "slot": np.arange(len(k)), "source_index": source.astype(np.int32),
                    "turn": turn.astype(np.int32), "block": block, "words": use.astype(np.int64),
                })

    parts = max(1, min(plan.shards, spark.sparkContext.defaultParallelism * 4 if plan.shards < 4096 else plan.shards // 64))
    schema = "shard long, slot long, source_index int, turn int, block long, words long"
    return spark.range(0, plan.shards, 1, parts).mapInPandas(draw, schema)


def source_runs(docs: DataFrame, *carry: Column) -> tuple[DataFrame, DataFrame, list[tuple[str | None, int]]]:
    """Every document with its number of words ``_size``, its source's number ``_index`` and where its words start in the
    source, ``_start``: once narrow, once with the columns to carry. And each source's total.

    Only sizes are staged; one entry per source goes to the driver."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    sizes = stage(docs.select("doc_id", "source", size.alias("_size")), "mix-sizes")
    totals = [(r["source"], r["n"]) for r in sizes.groupBy("source").agg(F.sum("_size").alias("n")).collect()]
    names = sorted((s for s, _ in totals), key=lambda s: (s is None, s or ""))
    index = docs.sparkSession.createDataFrame([(s, i) for i, s in enumerate(names)], "_name string, _index int")

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.join(index, rows["source"].eqNullSafe(index["_name"])).drop("_name", "source")

    order = ["doc_id", "_size"]
    narrow = numbered(sizes)
    runs = running_total(narrow, ["_index"], F.col("_size"), order, "_start", BUCKETS)
    if not carry:
        return runs, runs, totals
    wide = numbered(docs.select("doc_id", "source", size.alias("_size"), *carry))
    return runs, running_total(wide, ["_index"], F.col("_size"), order, "_start", BUCKETS, narrow), totals


def taken_parts(runs: DataFrame, plan: Plan) -> DataFrame:
    """The words of a document that each used block holds: ``_index, _start`` of the document, ``turn``, and the
    range ``first`` to ``end`` within the document. Joined by source and block number."""
    n = F.lit(plan.block_words)
    pieces = runs.filter("_size > 0").select(
        "_index", "_start", "_size",
        F.explode(F.sequence(F.floor(F.col("_start") / n), F.floor((F.col("_start") + F.col("_size") - 1) / n))).alias("block"),
    )
    mix = slots(runs.sparkSession, plan).select(F.col("source_index").alias("_index"), "block", "turn", "words")
    at = F.col("block") * n
    # the mix grows with the corpus, while the planner only sees the few shards it is drawn from
    joined = pieces.join(mix.hint("merge"), ["_index", "block"]).select(
        "_index", "_start", "turn", "block",
        F.greatest(F.lit(0), at - F.col("_start")).cast("long").alias("first"),
        F.least(F.col("_size"), at + F.col("words") - F.col("_start")).cast("long").alias("end"),
    )
    return joined.filter("end > first")


def mixed_sizes(docs: DataFrame, cycle: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, **plan) -> DataFrame:
    """One row per document: how many of its words the mix takes, repeats counted.

    A null or empty text has size 0 and nothing is taken of it. Null sources are one source, the last. Repeated rows
    are documents of their own. Reruns give the same counts."""
    runs, _, totals = source_runs(docs)
    plan = make_plan(totals, cycle, share, most, **plan)
    taken = taken_parts(runs, plan).groupBy("_index", "_start").agg(F.sum(F.col("end") - F.col("first")).alias("taken"))
    sizes = docs.sparkSession.createDataFrame(
        [(i, int(n), float(t)) for i, (n, t) in enumerate(zip(plan.sizes, plan.targets, strict=True))],
        "_index int, source_size long, target double",
    )
    # an empty document shares its start with the next one, so it takes no part in the join
    joined = runs.withColumn("_own", F.when(F.col("_size") > 0, F.col("_start"))).join(
        taken.withColumnRenamed("_start", "_own"), ["_index", "_own"], "left"
    ).join(sizes, "_index")
    return joined.select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, cycle: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, **plan) -> DataFrame:
    """The documents as the mix takes them, with their own columns: of each, the taken ranges of its text, the
    parts of a second use after those of the first, with a line break between parts that do not follow each other.

    A document of which nothing is taken is not in the mix; ``n_chars``, if there is one, follows the text."""
    rest = [c for c in docs.columns if c != "text"]
    runs, wide, totals = source_runs(docs, "text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"))
    plan = make_plan(totals, cycle, share, most, **plan)
    part = F.struct("turn", "first", "end")
    parts = taken_parts(runs, plan)
    parts = parts.groupBy("_index", "_start").agg(F.sort_array(F.collect_list(part)).alias("_parts"))
    word = re.compile(WORD)

    @F.pandas_udf("string")
    def cut(text: pd.Series, parts: pd.Series) -> pd.Series:
        def one(t: str, ranges) -> str:
            spans = [m.span() for m in word.finditer(t)]
            merged: list[list[int]] = []
            turn = None
            for r in ranges:
                if merged and turn == r["turn"] and merged[-1][1] == r["first"]:
                    merged[-1][1] = r["end"]
                else:
                    merged.append([r["first"], r["end"]])
                turn = r["turn"]
            return "\n".join(t[spans[a][0] : spans[b - 1][1]] for a, b in merged)

        return pd.Series([one(t, p) for t, p in zip(text, parts, strict=True)], dtype=object)

    out = wide.filter("_size > 0").join(parts, ["_index", "_start"]).select("_row", cut("text", "_parts").alias("text"))

    def column(name: str) -> Column:
        if name == "n_chars":
            return F.length("text").cast(docs.schema[name].dataType).alias(name)
        return (F.col("text") if name == "text" else F.col("_row").getField(name)).alias(name)

    return out.select(*map(column, docs.columns))
