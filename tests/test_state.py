"""The partitioned state: files in, two batches, documents out."""

import os

import pytest
from pyspark.sql import functions as F

from variantloom.operators.grouping import first_by_content, member_rank, nest_members
from variantloom.plans import mutation_etl, state_store
from variantloom.sources.sinks import document_member, open_members

from test_extract import FIRST, SECOND, line, parsed, sheet

TODAY = "2020-03-24"


def files_of(root, name):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{root}/{name}") for f in fs if f.endswith(".parquet")}


def rows_of(spark, positions):
    rows, _ = parsed(spark, *[line("0/1,0/0,1/1", "5,5,5,5,5,5", FIRST if p % 2 else SECOND, pos=str(p)) for p in positions])
    return rows


def members(spark):
    return spark.createDataFrame([("ENSG1", "symbol:NEW1"), ("ENSG1", "geneid:1"), ("ENSG2", "symbol:B")], "ensembl_id string, member string")


def test_batches_touch_their_ranges_only(spark, tmp_path):
    root, today = str(tmp_path / "state"), F.lit(TODAY).cast("date")
    state_store.update(rows_of(spark, range(1, 30)), sheet(spark), members(spark), today, root, digits=1)
    before = {name: files_of(root, name) for name in mutation_etl.TABLES}
    other = sheet(spark).withColumn("specimen", F.concat(F.lit("N"), "specimen"))
    again = rows_of(spark, [3])
    state_store.update(again, other, members(spark), today, root, digits=1)
    key = again.select(state_store.range_of("uid", 1)).first()[0]
    for name in ("variants", "cohort", "donors", "labs"):
        after = files_of(root, name)
        kept = {f: t for f, t in before[name].items() if f"{state_store.RANGE}={key}" not in f}
        assert kept and kept == {f: t for f, t in after.items() if f"{state_store.RANGE}={key}" not in f}
        assert set(before[name]) != set(after)
    plan = state_store.read_ranges(spark, root, "donors", [key])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and state_store.RANGE in plan.split("PartitionFilters: [")[1].split("]")[0]
    # the same as merging whole states
    whole = None
    for rows, samples in ((rows_of(spark, range(1, 30)), sheet(spark)), (again, other)):
        batch = mutation_etl.flat_state(mutation_etl.mutation_documents(rows, samples, members(spark), today))
        whole = batch if whole is None else mutation_etl.merge_state(whole, batch)
    state = state_store.read_state(spark, root)
    for name, df in whole.items():
        columns = [c for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
        assert sorted(map(str, state[name].select(*columns).collect())) == sorted(map(str, df.select(*columns).collect())), name
    # nested: the variant of both batches has the donors of both, counters of both
    found = state_store.mutation_documents(state).where(F.col("start") == 3).first()
    assert found["page"] == 0 and len(found["donors"]) == 4 and found["frequencies"]["interne"]["AN"] == 12
    assert sorted(found["specimenList"]) == found["specimenList"]
    pages = state_store.mutation_documents(state, 3).groupBy("uid").agg(F.max("page").alias("last"), F.count("mutationId").alias("heads"))
    assert sorted((r["last"], r["heads"]) for r in pages.collect()) == [(0, 1)] * 28 + [(1, 1)]
    genes = state_store.gene_documents(state, 10).orderBy("ensembl_id", "page").collect()
    assert sum(len(r["variants"]) for r in genes) == state["gene_variants"].count() and max(len(r["variants"]) for r in genes) <= 10


def small(spark, positions, specimen):
    """Flat tables of one batch with one carrier a variant."""
    key = F.upper(F.md5(F.col("pos").cast("string")))
    rows = spark.createDataFrame([(p,) for p in positions], "pos long").withColumn("uid", key)
    counts = [F.lit(v).cast("bigint").alias(c) for c, v in (("ac", 1), ("an", 2), ("hc", 0), ("pn", 1))] + [F.lit(0.5).alias("af")]
    gene = F.lit("ENSG1").alias("ensembl_id")
    return {
        "variants": rows.select("uid", F.concat(F.lit("chr1:g."), "pos").alias("mutationId")), "cohort": rows.select("uid", *counts),
        "labs": rows.select("uid", F.lit("L").alias("lab"), *counts), "donors": rows.select("uid", F.lit(specimen).alias("specimenId")),
        "gene_variants": rows.select(gene, F.concat(F.lit("chr1:g."), "pos").alias("mutation_id")),
        "gene_aliases": rows.limit(1).select(gene, F.lit("A").alias("alias")), "genes": rows.limit(1).select(gene, F.lit("G").alias("symbol")),
    }


def test_a_broken_run_is_finished_by_the_next(spark, tmp_path):
    root = str(tmp_path / "state")
    state_store.upsert(spark, root, small(spark, [1, 2], "S1"), digits=1)
    more = small(spark, [2, 5], "S2")
    state_store.prepare(spark, root, more, digits=1)  # ends before anything is put in place
    assert state_store.read_state(spark, root)["variants"].count() == 3
    state_store.upsert(spark, root, more, digits=1)  # a repeated batch changes nothing
    state = state_store.read_state(spark, root)
    assert state["variants"].count() == 3 and state["donors"].count() == 4 and state["genes"].count() == 1
    assert sorted(r["an"] for r in state["cohort"].collect()) == [2, 2, 4]


def test_published_documents(spark, tmp_path):
    root, out = str(tmp_path / "state"), str(tmp_path / "out")
    state_store.publish(spark, root, out, state_store.upsert(spark, root, small(spark, range(30), "S1"), digits=1), 7)
    before = files_of(out, "mutations")
    touched = state_store.upsert(spark, root, small(spark, [3], "S'2"), digits=1)
    for _ in range(2):  # again is the same
        state_store.publish(spark, root, out, touched, 7)
    assert len(touched["uid"]) == 1
    others = {f: t for f, t in before.items() if touched["uid"][0] not in f}
    assert others and others.items() <= files_of(out, "mutations").items() and set(before) != set(files_of(out, "mutations"))
    stored = spark.read.parquet(f"{out}/mutations")
    an = document_member("document", "bigint", "frequencies", "interne", "AN").alias("an")
    second = document_member("document", "string", "donors", 1, "specimenId").alias("second")
    found = stored.select("uid", an, second)
    assert sorted((r["an"], r["second"] or "") for r in found.collect()) == [(2, "")] * 29 + [(4, "S1" if "S1" > "S'2" else "S'2")]
    # the scan takes out the two paths, and not whole documents
    read = found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "document:struct<0:bigint,1:string>" in read
    assert {r["key"] for r in open_members(stored, "document", "frequencies", ["uid"]).collect()} == {"interne", "L"}
    assert stored.select(document_member("document", "bigint", "frequencies", "no 'such' key").alias("x")).where("x IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        document_member("document", "bigint", "a'b\"c")
    genes = spark.read.parquet(f"{out}/genes").select("page", F.size(document_member("document", "array<string>", "variants")).alias("n")).collect()
    assert sorted(tuple(r) for r in genes) == [(0, 7), (1, 7), (2, 7), (3, 7), (4, 2)]
    with pytest.raises(ValueError):
        state_store.publish(spark, str(tmp_path / "none"), out)


def test_laboratories_named_like_the_cohort_stay(spark):
    labs = sheet(spark).withColumn("lab", F.when(F.col("idx") == 0, "interne").when(F.col("idx") == 1, "ExAC").otherwise("lab:x"))
    state = mutation_etl.flat_state(mutation_etl.mutation_documents(
        rows_of(spark, [1]), labs, members(spark), F.lit(TODAY).cast("date")))
    assert {(r["lab"], r["an"]) for r in state["labs"].collect()} == {("interne", 2), ("ExAC", 2), ("lab:x", 2)}
    assert state["cohort"].first()["an"] == 6


def test_a_gene_with_half_of_all_rows(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("gene"),
        F.concat(F.lit("chr1:g."), "id").alias("mutation"))
    ranked = member_rank(rows, ["gene"], "mutation", "place").groupBy("gene").agg(
        F.count("*").alias("n"), F.countDistinct("place").alias("d"), F.max("place").alias("most")).collect()
    assert all(r["n"] == r["d"] == r["most"] + 1 for r in ranked)
    pages = nest_members(rows, ["gene"], "mutation", [], "variants", 700)
    sizes = [r["n"] for r in pages.where("gene = 'hot'").select(F.size("variants").alias("n")).collect()]
    assert sum(sizes) == 10_000 and sorted(sizes) == [200] + [700] * 14


def test_first_by_content(spark):
    rows = spark.createDataFrame([("a", 2, {"x": 1}), ("a", 1, {"x": 2}), ("a", 1, {"x": 1}), ("b", None, None)], "k string, v int, m map<string,int>")
    assert {(r["k"], r["v"], str(r["m"])) for r in first_by_content(rows, ["k"]).collect()} == {("a", 1, "{'x': 1}"), ("b", None, "None")}
