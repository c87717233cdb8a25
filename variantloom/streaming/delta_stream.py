"""Call batches merged on read: a micro-batch appends rows of the keys it touches and rewrites nothing (H1, H2, H5).

The state at ``root`` is one ``base`` and the ``delta`` folders behind it, each named by its batch number. A delta holds the
new donors, and the whole counters of the keys whose counters change. Reading takes the base's counters where no delta has the
key, and the newest delta's elsewhere; donors are only ever appended. After some deltas a new base is written, and the
folders that it replaces are removed one compaction later, so that a reader that has just listed them can finish.

A batch reads the state as it was before its number, so a repeated one writes the same delta again. A folder counts once its
table of names, written last, is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from variantloom.functions.genotype import is_carrier
from variantloom.operators import merge as m
from variantloom.operators.frequency import cohort_frequency, lab_frequency
from variantloom.operators.grouping import first_by_content, last_by_key
from variantloom.sources.sinks import COMPLETE, exists, folders, remove, write_merged, write_table

#: Deltas behind a base before they are merged into the next one.
DELTAS = 8


def _folder(root: str, kind: str, number: int) -> str:
    return f"{root}/{kind}={number:012d}"


def _numbers(spark: SparkSession, root: str, kind: str) -> list[int]:
    """The numbers of all folders of one kind, finished or not."""
    prefix = f"{kind}="
    return sorted(int(name.removeprefix(prefix)) for name in folders(spark, root) if name.startswith(prefix))


def parts(spark: SparkSession, root: str, before: int | None = None) -> tuple[int | None, list[int]]:
    """(the newest finished base, the finished deltas behind it), of batches in front of ``before``."""
    done = lambda kind: [n for n in _numbers(spark, root, kind) if (before is None or n < before)
                         and exists(spark, f"{_folder(root, kind, n)}/{COMPLETE}")]
    base = max(done("base"), default=None)
    return base, [n for n in done("delta") if base is None or n > base]


def _keys(table: str, key: str) -> list[str]:
    return [key, "lab"] if table == "labs" else [key]


def read_table(spark: SparkSession, root: str, table: str, key: str, before: int | None = None, among: DataFrame | None = None
               ) -> DataFrame | None:
    """One table of the state; None if there is none. ``among`` keeps the rows of its keys."""
    base, deltas = parts(spark, root, before)

    def rows(kind: str, numbers: list[int]) -> DataFrame:
        # one scan of all folders of a kind, whose number is the partition column
        found = spark.read.option("basePath", root).parquet(*[f"{_folder(root, kind, n)}/{table}" for n in numbers])
        return found if among is None else found.join(among, key, "left_semi")

    old = None if base is None else rows("base", [base]).drop("base")
    if not deltas:
        return old
    new = rows("delta", deltas).withColumnRenamed("delta", "_number")
    if table == "donors":
        new = new.drop("_number")
    else:
        on = _keys(table, key)
        new = last_by_key(new, on, [F.col("_number").desc()]).drop("_number")
        old = None if old is None else old.join(new, on, "left_anti")
    return new if old is None else old.unionByName(new)


def read_state(spark: SparkSession, root: str, key: str = "site_id") -> dict[str, DataFrame]:
    tables = {name: read_table(spark, root, name, key) for name in _tables(spark, root)}
    return {name: df for name, df in tables.items() if df is not None}


def _tables(spark: SparkSession, root: str) -> list[str]:
    base, deltas = parts(spark, root)
    if base is None and not deltas:
        raise ValueError(f"no state at {root}")
    newest = _folder(root, "delta", deltas[-1]) if deltas else _folder(root, "base", base)
    return [r["name"] for r in spark.read.schema("name string").parquet(f"{newest}/{COMPLETE}").collect()]


def compact(spark: SparkSession, root: str, number: int, key: str = "site_id") -> None:
    """A base that holds all batches up to ``number``. Folders in front of the base before it are removed."""
    kept, _ = parts(spark, root, number)
    names = _tables(spark, root)
    write_merged({name: read_table(spark, root, name, key, number + 1) for name in names}, _folder(root, "base", number))
    for kind in ("base", "delta"):
        for old in _numbers(spark, root, kind):
            if kept is not None and (old < kept or kind == "delta" and old == kept):
                remove(spark, _folder(root, kind, old))


def merge_calls_batch(root: str, key: str = "site_id", specimen: str = "specimen", gt: str = "gt",
                      laboratories: DataFrame | None = None, deltas: int = DELTAS) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one batch of calls into the state at ``root``.

    ``laboratories`` (``specimen, lab``) adds counters per key and laboratory. ``key`` may be a variant or a gene."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if any(n >= number and exists(spark, f"{_folder(root, 'base', n)}/{COMPLETE}") for n in _numbers(spark, root, "base")):
            return  # a base holds this batch already
        calls = first_by_content(batch, [key, specimen]).persist()
        keys = calls.select(key).distinct()
        stored = lambda table: read_table(spark, root, table, key, number, keys)
        donors, old = calls.where(is_carrier(F.col(gt))).select(key, specimen, gt), stored("donors")
        target = _folder(root, "delta", number)
        write_table(donors if old is None else m.new_members(old, donors, key, specimen), f"{target}/donors")
        touched = spark.read.schema(donors.schema).parquet(f"{target}/donors").select(key).distinct()
        changed = {"cohort": cohort_frequency(calls, [key], gt)}
        if laboratories is not None:
            changed["labs"] = lab_frequency(calls, laboratories, [key], specimen, gt=gt)
        for table, rows in changed.items():
            old = stored(table)
            if old is not None:
                # what is stored of a key without a new donor stays as it is and is not written again
                same = old.select(key).distinct().join(touched, key, "left_anti")
                merged = m.merge_counters(old, rows, touched, key, _keys(table, key)[1:])
                changed[table] = merged.join(same, key, "left_anti")
        write_merged(changed, target, ["donors"])
        calls.unpersist()
        if len(parts(spark, root)[1]) >= deltas:
            compact(spark, root, number, key)

    return merge


def start(spark: SparkSession, source: str, schema: str, root: str, files_per_batch: int | None = None,
          key: str = "site_id", laboratories: DataFrame | None = None, deltas: int = DELTAS) -> StreamingQuery:
    """Reads what has come to ``source`` since the last start, in micro-batches."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    merge = merge_calls_batch(root, key, laboratories=laboratories, deltas=deltas)
    return reader.load(source).writeStream.foreachBatch(merge).option(
        "checkpointLocation", f"{root}/_stream").trigger(availableNow=True).start()
