"""The smaller jobs and the sinks, end to end on tiny inputs."""

from pyspark.sql import functions as F

from variantloom.operators.legacy import COLUMNS
from variantloom.plans import other_jobs
from variantloom.schemas import RANKED_REPORT
from variantloom.sources import knowledge, sinks


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "1"), ("a", 2, "1"), ("b", 1, "X")], "uid string, batch int, chrom string")
    path = str(tmp_path / "t")
    sinks.write_overwriting(rows, path, "uid", "batch", ["chrom"])
    stored = sinks.read_table(spark, path)
    assert {(r["uid"], r["batch"], str(r["chrom"])) for r in stored.collect()} == {("a", 2, "1"), ("b", 1, "X")}


def test_column_list():
    assert len(COLUMNS) == 130 and len({c.lower() for c in COLUMNS}) == 130
    assert (COLUMNS[39], COLUMNS[57], COLUMNS[76], COLUMNS[101], COLUMNS[129]) == (
        "exAC_AC", "d1000Gp3_AC", "SIFT_pred", "gnomAD_genomes_AC", "ad")


def test_score_job(spark, tmp_path):
    uid = spark.range(1).select(F.upper(F.md5(F.lit("chrX:g.5A>G@GRCh38")))).first()[0]
    donors = spark.createDataFrame(
        [(uid, "SP1", None, None), (uid, "SP2", None, None)],
        "uid string, specimenId string, exomiserScore double, lastUpdate date")
    report = spark.read.schema(RANKED_REPORT).json(spark.sparkContext.parallelize([
        '{"geneSymbol":"A","combinedScore":0.5,"variantEvaluations":[{"chromosome":23,"position":5,"ref":"A","alt":"G"},'
        '{"chromosome":1,"position":6,"ref":"A","alt":"G"}]}']))
    target = str(tmp_path / "scores")
    state = {"donors": donors, "variants": donors.select("uid").distinct()}
    other_jobs.score_job(report, state, "1", F.lit("2020-05-01").cast("date"), target)
    got = {r["specimenId"]: r["exomiserScore"] for r in spark.read.parquet(f"{target}/donors").collect()}
    assert got == {"SP1": 0.5, "SP2": None}
    assert [r["mutation_id"] for r in spark.read.parquet(f"{target}/score_stubs").collect()] == ["chr1:g.6A>G"]
    # the stub is part of the state: a second run finds it and makes no other
    grown = {n: spark.read.parquet(f"{target}/{n}") for n in ("donors", "variants")}
    assert grown["variants"].count() == 2 and grown["donors"].count() == 3
    again = str(tmp_path / "again")
    other_jobs.score_job(report, grown, "1", F.lit("2020-05-02").cast("date"), again)
    assert spark.read.parquet(f"{again}/score_stubs").count() == 0
    assert spark.read.parquet(f"{again}/variants").count() == 2


def test_gene_index_job(spark, tmp_path):
    path = tmp_path / "genes.tsv"
    path.write_text("#tax\tid\tsym\ttag\tsyn\txrefs\tmore\n9606\t1\tA\t-\t-\tMIM:1|Ensembl:ENSG1|Ensembl:ENSG2\tx\n")
    members = spark.createDataFrame(
        [("ENSG1", "geneid:1"), ("ENSG1", "symbol:A"), ("ENSG2", "symbol:B")], "ensembl_id string, member string")
    other_jobs.gene_index_job(knowledge.read_gene_info(spark, str(path)), members, str(tmp_path / "index"))
    rows = spark.read.parquet(str(tmp_path / "index")).collect()
    assert [(r["ensembl_id"], r["symbol"], r["alias"]) for r in rows] == [("ENSG1", "A", [])]


def test_validation_job(spark):
    lines = spark.createDataFrame(
        [("CHROM\tPOS\tREF\tALT",), ("chr1\t69511\tA\tG",), ("chr1\t7\tA\tG",), ("chrUn_KI\t1\tA\tG",)], "value string")
    stored = spark.createDataFrame([("24CFF52FA825D6CD7DABCD955F42DF1C",)], "uid string")
    row = other_jobs.validation_job(lines, stored).first()
    assert (row["processed"], row["found"], row["not_found"], row["discarded"]) == (3, 1, 1, 1)


def test_legacy_job(spark, tmp_path):
    values = {"chrom": "chr1", "position": "5", "reference": "A", "alt": "G", "qual": "1.5", "allele": "G", "snp": "true"}
    text = "\t".join(values.get(c, "") for c in COLUMNS)
    rows = knowledge.parse_legacy_lines(spark.createDataFrame([("CHROM\tx",), (text,)], "value string"))
    first, second = str(tmp_path / "l1"), str(tmp_path / "l2")
    other_jobs.legacy_job(rows, first, donorId=F.lit("P1"), familyId=F.lit("F1"))
    other_jobs.legacy_job(rows, second, first, donorId=F.lit("P2"), familyId=F.lit("F1"))
    assert spark.read.parquet(f"{second}/variants").count() == 1
    assert {r["donorId"] for r in spark.read.parquet(f"{second}/donors").collect()} == {"P1", "P2"}
