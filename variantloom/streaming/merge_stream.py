"""Call batches arriving as files, merged by ``foreachBatch``.

Every micro-batch writes a new state folder named by its number and reads the one before it, so a repeated
micro-batch writes the same folder again and no batch is counted twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from variantloom.functions.genotype import is_carrier
from variantloom.operators import merge as m
from variantloom.operators.frequency import cohort_frequency
from variantloom.operators.grouping import first_by_content
from variantloom.sources.sinks import write_merged


def state_folder(root: str, number: int) -> str:
    return f"{root}/batch={number:012d}"


def merge_calls_batch(root: str, key: str = "site_id", specimen: str = "specimen", gt: str = "gt"
                      ) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: counters and donors of one batch of calls into the state at ``root``."""

    def merge(batch: DataFrame, number: int) -> None:
        calls = first_by_content(batch, [key, specimen])
        counters = cohort_frequency(calls, [key], gt)
        donors = calls.where(is_carrier(F.col(gt))).select(key, specimen, gt)
        tables = {"cohort": counters, "donors": donors}
        if number > 0:
            old = {n: batch.sparkSession.read.parquet(f"{state_folder(root, number - 1)}/{n}") for n in tables}
            touched = m.touched_keys(old["donors"], donors, key, specimen)
            tables = {
                "cohort": m.merge_counters(old["cohort"], counters, touched, key),
                "donors": m.merge_donors(old["donors"], donors, key, specimen),
            }
        write_merged(tables, state_folder(root, number))

    return merge


def start(spark: SparkSession, source: str, schema: str, root: str, files_per_batch: int | None = None
          ) -> StreamingQuery:
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(source).writeStream.foreachBatch(merge_calls_batch(root))
        .option("checkpointLocation", f"{root}/_stream").trigger(availableNow=True).start()
    )
