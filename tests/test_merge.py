"""Merges against brute force on small state: replay, overlap, new batch; skewed keys; streaming."""

import random

from pyspark.sql import functions as F

from variantloom.operators import calls as c, frequency as fr, merge as m
from variantloom.operators.exomiser import flatten_report
from variantloom.operators.grouping import nest, running_total_before
from variantloom.operators.validation import classify_load, load_statistics
from variantloom.schemas import RANKED_REPORT
from variantloom.streaming import merge_stream

SCHEMA = "site_id long, specimen long, gt string"


def brute(batches):
    """Sequential rule: the first batch of a site is stored, a later one counts fully if it brings a new carrier."""
    counts, stored = {}, {}
    for batch in batches:
        for site in {s for s, _, _ in batch}:
            rows = {sp: gt for s, sp, gt in batch if s == site}
            alleles = [x for gt in rows.values() for x in (gt[0], gt[2]) if "." not in gt]
            new = (alleles.count("1"), len(alleles), sum(gt == "1/1" for gt in rows.values()),
                   sum(gt in ("0/1", "1/1") for gt in rows.values()))
            carriers = {sp for sp, gt in rows.items() if gt in ("0/1", "1/1")}
            if site not in counts:
                counts[site], stored[site] = new, carriers
            elif carriers - stored[site]:
                counts[site] = tuple(a + b for a, b in zip(counts[site], new))
                stored[site] |= carriers
    return counts, stored


def batches(seed=3):
    rng = random.Random(seed)
    draw = lambda keys: sorted({(s, p): rng.choice(["0/0", "0/1", "1/1", "./."]) for s, p in keys}.items())
    # site 0 holds about half of all rows
    keys = lambda lo, hi: [(0, p) for p in range(lo, hi)] + [(s, p) for s in range(1, 8) for p in range(lo, hi, 7)]
    flat = lambda rows: [(s, p, gt) for (s, p), gt in rows]
    first = flat(draw(keys(0, 40)))
    return [first, first, flat(draw(keys(30, 60))), flat(draw([(9, 1), (9, 2)]))]


def merged(spark, parts):
    state = None
    for rows in parts:
        df = spark.createDataFrame(rows, SCHEMA)
        new = {"cohort": fr.cohort_frequency(df, ["site_id"]), "donors": df.where("gt IN ('0/1', '1/1')")}
        if state is not None:
            touched = m.touched_keys(state["donors"], new["donors"], "site_id", "specimen")
            new = {"cohort": m.merge_counters(state["cohort"], new["cohort"], touched, "site_id"),
                   "donors": m.merge_donors(state["donors"], new["donors"], "site_id", "specimen")}
        state = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in new.items()}
    return state


def as_dict(cohort):
    return {r["site_id"]: (r["ac"], r["an"], r["hc"], r["pn"]) for r in cohort.collect()}


def test_sequential_merges(spark):
    parts = batches()
    counts, stored = brute(parts)
    state = merged(spark, parts)
    assert as_dict(state["cohort"]) == counts
    donors = {}
    for r in state["donors"].collect():
        donors.setdefault(r["site_id"], set()).add(r["specimen"])
    assert donors == {s: d for s, d in stored.items() if d}


def test_exact_merge_counts_a_sample_once(spark):
    one, _, three, _ = batches()
    state, batch = (spark.createDataFrame(x, SCHEMA) for x in (one, three))
    union = {(s, p): gt for s, p, gt in three} | {(s, p): gt for s, p, gt in one}
    expected, _ = brute([[(s, p, gt) for (s, p), gt in union.items()]])
    assert as_dict(m.merge_calls_exactly(state, batch, "site_id", "specimen")) == expected


def test_lab_rows_follow_the_flag(spark):
    schema = "uid string, lab string, ac long, an long, hc long, pn long, af double"
    old = spark.createDataFrame([("a", "L1", 1, 2, 0, 1, 0.5), ("b", "L1", 1, 4, 0, 1, 0.25)], schema)
    new = spark.createDataFrame([("a", "L1", 1, 2, 0, 1, 0.5), ("a", "L2", 2, 2, 1, 1, 1.0), ("b", "L2", 0, 2, 0, 0, 0.0),
                                 ("c", "L2", 1, 2, 0, 1, 0.5)], schema)
    touched = spark.createDataFrame([("a",)], "uid string")
    got = {(r["uid"], r["lab"]): (r["ac"], r["an"], r["af"]) for r in m.merge_counters(old, new, touched, "uid", ["lab"]).collect()}
    assert got == {("a", "L1"): (2, 4, 0.5), ("a", "L2"): (2, 2, 1.0), ("b", "L1"): (1, 4, 0.25), ("c", "L2"): (1, 2, 0.5)}


def test_scores(spark):
    donors = spark.createDataFrame([("u1", "S1"), ("u1", "S2")], "uid string, specimen string")
    variants = donors.select("uid").distinct()
    scores = spark.createDataFrame(
        [("u1", "S1", 0.2, "2020-01-01"), ("u1", "S1", 0.7, "2020-01-01"), ("u2", "S1", 0.9, "2020-01-01")],
        "uid string, specimen string, exomiser_score double, last_update string")
    merged_donors, stubs = m.merge_scores(donors, variants, scores, "uid", "specimen")
    assert {r["specimen"]: r["exomiser_score"] for r in merged_donors.collect()} == {"S1": 0.7, "S2": None}
    assert [r["uid"] for r in stubs.collect()] == ["u2"]


def test_report_genes_without_variants_are_dropped(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('[{"geneSymbol":"A","combinedScore":0.123456,"geneIdentifier":{"geneId":"E1"},"variantEvaluations":'
                    '[{"chromosome":23,"position":5,"ref":"A","alt":"G","compatibleInheritanceModes":["AD"]}]},'
                    '{"geneSymbol":"B","variantEvaluations":[]}]')
    report = spark.read.schema(RANKED_REPORT).json(str(path), multiLine=True)
    rows = flatten_report(report).collect()
    assert [(r["geneSymbol"], r["chrom"], round(r["combinedScore"], 5)) for r in rows] == [("A", 23, 0.12346)]


def test_chunked_running_total_and_pages(spark):
    """One key with most rows: ranges and pages of it are worked on separately, results stay whole."""
    rng = random.Random(1)
    rows = [(1, i, rng.choice(["./.", "0/1"])) for i in rng.sample(range(20_000), 5_000)] + [(2, 5, "0/1"), (3, -4, "0/1")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["site_id"], r["specimen"]): r["ad_start"] for r in c.depth_pointer(df, ["site_id"], "specimen", "gt", chunk=64).collect()}
    expected = {}
    for site in (1, 2, 3):
        total = 0
        for s, p, gt in sorted(x for x in rows if x[0] == site):
            expected[s, p] = total
            total += 1 if gt == "./." else 2
    assert got == expected
    pages = nest(df.where("site_id = 1"), ["site_id"], "specimen", ["gt"], "calls", page_size=500).collect()
    assert max(len(p["calls"]) for p in pages) <= 500
    assert sorted(x["specimen"] for p in pages for x in p["calls"]) == sorted(p for s, p, _ in rows if s == 1)
    empty = running_total_before(df.where("false"), ["site_id"], "specimen", F.lit(1), "t")
    assert empty.count() == 0


def test_load_statistics(spark):
    extract = spark.createDataFrame([("a", "chr1"), ("b", "chr1"), ("c", "chrUn_1")], "uid string, chrom string")
    stored = spark.createDataFrame([("a",), ("c",)], "uid string")
    row = load_statistics(classify_load(extract, stored, "uid", F.length("chrom") > 5)).first()
    assert (row["processed"], row["found"], row["not_found"], row["discarded"], row["verdict"]) == (3, 1, 1, 1, "failed")


def test_streamed_batches_give_the_same_state(spark, tmp_path):
    parts = batches()
    source, root = tmp_path / "in", tmp_path / "state"
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
    merge = merge_stream.merge_calls_batch(str(root))
    for i in range(len(parts)):
        merge(spark.read.parquet(str(tmp_path / f"w{i}")), i)
    merge(spark.read.parquet(str(tmp_path / "w3")), 3)  # a repeated micro-batch changes nothing
    counts, _ = brute(parts)
    assert as_dict(spark.read.parquet(f"{merge_stream.state_folder(str(root), 3)}/cohort")) == counts
    source.mkdir()
    spark.createDataFrame(parts[0], SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
    query = merge_stream.start(spark, str(source), SCHEMA, str(tmp_path / "streamed"), 1)
    query.awaitTermination(120)
    assert as_dict(spark.read.parquet(f"{merge_stream.state_folder(str(tmp_path / 'streamed'), 0)}/cohort")) == brute(parts[:1])[0]
