"""Helpers the operators share: tables, staged tables, words, window hashes and running totals."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantloom.session import checkpoint_dir

#: A word: a run of characters that are neither a space nor one of the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters of text that one step of a Python task holds as words; one longer text is a step by itself.
STEP_CHARS = 2_000_000
_ODD = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Python workers serve many stages. With a fixed threshold, blocks of a batch's size go back to the system when they are
#: freed; by default the threshold follows the largest block and every worker keeps its peak.
_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def importable(spark: SparkSession) -> None:
    """Lets Python tasks import this library from where the driver has it, whatever the working folder is, and give
    memory back that they no longer use."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    for name, value in _MEMORY.items():
        environment.setdefault(name, value)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: computed once, and safe from lost executors.

    ``under`` is a work folder that is cleared once nothing in it is read any more."""
    spark = df.sparkSession
    path = work_folder(spark, name) if under is None else f"{under}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession, folder: str) -> None:
    """Removes a work folder, wherever the shared folder is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` parts at exactly the characters of ``WORD``."""
    return text.encode().split() if text else []


def steps(lengths: Sequence[int], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths add up to at most ``limit``, or that hold one row."""
    low = total = 0
    for i, n in enumerate(lengths):
        if i > low and total + n > limit:
            yield low, i
            low, total = i, 0
        total += n
    if low < len(lengths):
        yield low, len(lengths)


def hashed_words(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, one after another, and the number of words of each text."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    hashes = np.fromiter(
        map(xxhash.xxh3_64_intdigest, chain.from_iterable(texts)), np.uint64, int(counts.sum())
    )
    return hashes, counts


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all (the finalizer of splitmix64)."""
    x = x + np.uint64((salt * _ODD) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A hash of every ``width`` neighbours, by doubling: as many vector steps as the width has bits."""
    multiplier = (_ODD + 2 * 0x632BE59BD9B4E019 * salt) % 2**64 | 1
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    power, size, out, have = hashes, 1, None, 0
    while True:
        if width & size:
            factor = np.uint64(pow(multiplier, size, 2**64))
            if out is None:
                out = power
            else:
                n = len(hashes) - have - size + 1
                out = out[:n] * factor + power[have : have + n]
            have += size
        if have == width:
            return mixed(out, salt)
        factor = np.uint64(pow(multiplier, size, 2**64))
        power = power[:-size] * factor + power[size:]
        size *= 2


def window_starts(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a window of ``width`` words lies within one text, and the text of every word."""
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return np.flatnonzero(np.arange(len(owner)) + width <= ends[owner]), owner


def crc_fold(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``: the fold that keeps labels apart."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def running_total(
    df: DataFrame, groups: Sequence[str], value: Column, order: Sequence[str], out: str, buckets: int,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same group that come earlier.

    A group is dealt into ``buckets`` by a hash of its order columns and the buckets follow each other, so no
    task holds a whole group. ``df`` is read twice: stage it first, or give the same rows staged without their wide
    columns as ``narrow``. ``groups`` hold no nulls. Rows that agree in all order columns follow each other in any
    order."""

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets))).withColumn("_value", value)

    keys = [*groups, "_bucket"]
    sums, df = dealt(df if narrow is None else narrow), dealt(df)
    sums = sums.groupBy(*keys).agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(*keys, (F.sum("_sum").over(before) - F.col("_sum")).alias("_first"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_inside", F.sum("_value").over(inside) - F.col("_value"))
    return (
        df.join(sums, keys)
        .withColumn(out, (F.col("_first") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_value", "_first", "_inside")
    )
