"""Batches merged on read: the same state as merging whole, bounded folders, repeated and broken batches."""

import os

import pytest
from pyspark.sql import functions as F

from variantloom.operators import merge as m
from variantloom.operators.frequency import cohort_frequency, lab_frequency
from variantloom.sources.sinks import COMPLETE, remove
from variantloom.streaming import delta_stream

from test_merge import SCHEMA, as_dict, batches, brute


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Many small jobs: one partition each is enough."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def cohort(spark, root):
    return as_dict(delta_stream.read_state(spark, root)["cohort"])


def names(root):
    return sorted(n for n in os.listdir(root) if "=" in n)


def test_same_state_as_the_rule(spark, tmp_path):
    root, parts = str(tmp_path / "state"), batches()
    merge = delta_stream.merge_calls_batch(root, deltas=3)
    for i, rows in enumerate(parts):
        merge(frame(spark, rows), i)
        counts, stored = brute(parts[: i + 1])
        assert cohort(spark, root) == counts
        merge(frame(spark, rows), i)  # a repeated micro-batch changes nothing
        assert cohort(spark, root) == counts
    donors = delta_stream.read_state(spark, root)["donors"]
    assert sorted((r["site_id"], r["specimen"]) for r in donors.collect()) == sorted((s, p) for s, ps in stored.items() for p in ps)


def test_a_batch_writes_its_keys_only(spark, tmp_path):
    root, parts = str(tmp_path / "state"), batches()
    merge = delta_stream.merge_calls_batch(root)
    merge(frame(spark, parts[0]), 0)
    merge(frame(spark, [(3, 900, "0/1"), (4, 7, "0/0")]), 1)
    last = delta_stream._folder(root, "delta", 1)
    assert [r["site_id"] for r in spark.read.parquet(f"{last}/cohort").collect()] == [3]
    assert spark.read.parquet(f"{last}/donors").count() == 1
    assert cohort(spark, root) == brute([parts[0], [(3, 900, "0/1"), (4, 7, "0/0")]])[0]


def test_folders_stay_bounded_over_20_batches(spark, tmp_path):
    root = str(tmp_path / "state")
    parts = [[(i % 3, i, "0/1"), (i % 3, i + 100, "0/0"), (50 + i, 1, "1/1")] for i in range(20)]
    merge, most = delta_stream.merge_calls_batch(root, deltas=4), 0
    for i, rows in enumerate(parts):
        merge(frame(spark, rows), i)
        most = max(most, len(names(root)))
    assert most <= 2 + 3 * 4 and len([n for n in names(root) if n.startswith("base")]) == 2
    assert cohort(spark, root) == brute(parts)[0]


def test_broken_batch_and_broken_compaction(spark, tmp_path):
    root, parts = str(tmp_path / "state"), batches()
    merge = delta_stream.merge_calls_batch(root, deltas=2)
    merge(frame(spark, parts[0]), 0)
    merge(frame(spark, parts[2]), 1)
    counts = brute([parts[0], parts[2]])[0]
    remove(spark, f"{delta_stream._folder(root, 'base', 1)}/{COMPLETE}")  # the base was not finished
    assert cohort(spark, root) == counts
    merge(frame(spark, parts[2]), 1)
    assert cohort(spark, root) == counts
    merge(frame(spark, parts[3]), 2)
    remove(spark, f"{delta_stream._folder(root, 'delta', 2)}/{COMPLETE}")  # this delta was not finished
    assert cohort(spark, root) == counts
    merge(frame(spark, parts[3]), 2)
    assert cohort(spark, root) == brute([parts[0], parts[2], parts[3]])[0]


def test_laboratories_as_in_the_batch_merge(spark, tmp_path):
    root, parts = str(tmp_path / "state"), batches()
    patients = spark.range(200).select(F.col("id").cast("int").alias("specimen"), F.concat(F.lit("L"), F.col("id") % 3).alias("lab"))
    merge, whole = delta_stream.merge_calls_batch(root, laboratories=patients, deltas=2), None
    for i, rows in enumerate(parts):
        calls = frame(spark, rows)
        merge(calls, i)
        labs, donors = lab_frequency(calls, patients, ["site_id"]), calls.where("gt IN ('0/1', '1/1')")
        if whole is None:
            whole = labs, donors
        else:
            touched = m.touched_keys(whole[1], donors, "site_id", "specimen")
            whole = m.merge_counters(whole[0], labs, touched, "site_id", ["lab"]), m.merge_donors(whole[1], donors, "site_id", "specimen")
    got = delta_stream.read_state(spark, root)["labs"]
    assert sorted(map(tuple, got.select(*whole[0].columns).collect())) == sorted(map(tuple, whole[0].collect()))


def test_empty_batch_and_no_state(spark, tmp_path):
    root = str(tmp_path / "state")
    try:
        delta_stream.read_state(spark, root)
    except ValueError as missing:
        assert root in str(missing)
    else:
        raise AssertionError("no state was read")
    merge = delta_stream.merge_calls_batch(root)
    merge(spark.createDataFrame([], SCHEMA), 0)
    merge(frame(spark, [(1, 1, "0/1"), (1, 1, "0/1")]), 1)
    merge(spark.createDataFrame([], SCHEMA), 2)
    assert cohort(spark, root) == brute([[(1, 1, "0/1")]])[0]
