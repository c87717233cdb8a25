"""Composed cohorts, extracts of several files, the load check, and the whole job from files."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from variantloom.operators import clinical
from variantloom.plans import other_jobs, queries_cohort, state_store
from variantloom.plans.bridge import Inputs
from variantloom.schemas import PEDIGREE
from variantloom.sources import extract

from test_extract import FIRST, HEADER, line

SAMPLES = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t00011\t00061\tSP00036\t00099"


def patient(specimen, key, **more):
    request = {"specimen": [{"id": specimen}], "code": {"text": "WXS"}, "ci_ref": "c1", "requester_org_name": "Lab", "requester_org_alias": "L1"}
    return {"id": key, "familyId": "X", "isProband": False, "serviceRequests": [request], "clinicalImpressions": [],
            "generalPractitioner": [{"id": "R1"}], "practitioners": [{"id": "D1", "role_id": "r1", "role_org_id": "O1"}], **more}


def written(tmp_path):
    """Two extracts with their columns in different order, a pedigree, patient documents and properties."""
    folder = tmp_path / "extracts"
    folder.mkdir()
    rows = [line("0/1,0/0,1/1,0/1", "5,5,5,5,5,5,5,5", FIRST, pos=str(p)) for p in (1, 2, 3)]
    other = [0, 9, 8, 7, 6, 5, 4, 3, 2, 1, 13, 12, 11, 10]
    turned = lambda text: "\t".join(text.split("\t")[i] for i in other)
    (folder / "a.txt").write_text("\n".join([SAMPLES, "\t".join(HEADER), *rows[:2]]) + "\n")
    (folder / "b c.txt").write_text("\n".join([SAMPLES, turned("\t".join(HEADER)), turned(rows[2])]) + "\n")
    (tmp_path / "f.ped").write_text("FA1\tsp00011\tSP00061\tSP00036\t1\t2\n\nFA1 SP00061 0 0 1 1\nFA1  SP00036 0 0 2 1\n")
    people = [patient("SP00011", "PA1", isProband=True, link=[{"id": "PA2", "relationship": "FTH"}]), patient("SP00061", "PA2")]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, people)))
    (tmp_path / "c.properties").write_text("\n".join([
        "specimen=SP00036", "relation=", "patientId=PA3", "familyId=FA1", "studyId=ET1", "gender=female", "organizationId=O2",
        "laboName=L2", "isProband=false", "isAffected=false", "practitionerId=D2", "HpoQtyTerms=0", "hpoTermsPos=.", "linkQty=0",
        "linkPatient=.", "linkSpecimen=.", "sequencingStrategy=WXS"]))
    return folder


def test_each_file_is_bound_by_its_header(spark, tmp_path):
    rows = extract.read_extract(spark, str(written(tmp_path)))
    got = {(r["pos"], r["ref"], r["alt"], tuple(r["gt"]), tuple(r["ad"]), r["csq"] == FIRST) for r in rows.collect()}
    assert got == {(p, "A", "G", ("0/1", "0/0", "1/1", "0/1"), ("5",) * 8, True) for p in (1, 2, 3)}
    assert [r["specimen"] for r in extract.read_samples(spark, str(tmp_path / "extracts")).orderBy("idx").collect()] == [
        "SP00011", "SP00061", "SP00036", "SP00099"]
    (tmp_path / "extracts" / "d.txt").write_text(SAMPLES + "\tSP5\n" + "\t".join(HEADER) + "\n")
    with pytest.raises(ValueError, match="sample lists"):
        extract.read_samples(spark, str(tmp_path / "extracts"))


def test_the_job_takes_files(spark, tmp_path):
    folder = written(tmp_path)
    members = spark.createDataFrame([("ENSG1", "symbol:NEW1")], "ensembl_id string, member string")
    root = str(tmp_path / "state")
    rejects = state_store.update_from_files(
        spark, str(folder), str(tmp_path / "f.ped"), members, F.lit("2020-03-24").cast("date"), root,
        str(tmp_path / "p.json"), str(tmp_path / "c.properties"), digits=1)
    assert [tuple(r) for r in rejects.collect()] == [(3, "SP00099", "no patient")]
    assert [tuple(r) for r in spark.read.parquet(f"{root}/rejects").collect()] == [(3, "SP00099", "no patient")]
    state = state_store.read_state(spark, root)
    donors = {(r["specimenId"], r["relation"], r["patientId"], r["practitionerId"], r["organizationId"], r["genotypeFamily"])
              for r in state["donors"].collect()}
    assert donors == {("SP00011", "Proband", "PA1", "D1", "O1", "FTH:0/0,MTH:1/1"), ("SP00036", "MTH", "PA3", "D2", "O2", None)}
    assert {(r["lab"], r["an"]) for r in state["labs"].collect()} == {("L1", 4), ("L2", 2)}
    assert {r["an"] for r in state["cohort"].collect()} == {6}
    # the check of the same files against the state: all found, nothing repeated
    found = other_jobs.load_check(extract.read_extract(spark, str(folder), primary_only=False), root=root)
    row = found["statistics"].first()
    assert (row["processed"], row["found"], row["not_found"], row["errors"], row["annotations"], row["verdict"]) == (3, 3, 0, 0, 3, "passed")
    assert found["duplicates"].count() == found["collisions"].count() == 0


def test_samples_are_rejected_with_a_reason(spark):
    samples = spark.createDataFrame([(0, "SP1"), (1, "sp1"), (2, "SP2"), (3, "SP3"), (4, "SP4")], "idx int, specimen string")
    ped = spark.createDataFrame(
        [("F", "SP1", "SP4", "0", "1", "2"), ("F", "sp1", "SP4", "0", "1", "1"), ("F", "SP3", "0", "0", "1", "1"), ("F", "SP4", None, None, "1", "1")], PEDIGREE)
    names = "specimen patientId studyId practitionerId organizationId laboName relation".split()
    given = spark.createDataFrame([(s, f"P{s}", "E", "R", "O", "L", None) for s in ("SP1", "SP2", "SP4")], ", ".join(f"{n} string" for n in names))
    sheet, rejects = clinical.composed_sheet(samples, ped, properties=given.withColumn("hpo_terms", F.array().cast("array<string>")))
    assert {tuple(r) for r in rejects.collect()} == {(1, "sp1", "listed again"), (2, "SP2", "no pedigree"), (3, "SP3", "no patient")}
    assert {(r["idx"], r["relation"], r["phenotype"]) for r in sheet.collect()} == {(0, None, "2"), (4, "FTH", "1")}
    with pytest.raises(ValueError):
        clinical.composed_sheet(samples, ped)


def test_load_check_counts_in_the_pass_that_reads(spark):
    head = ["CHROM", "POS", "REF", "ALT", "CSQ"]
    lines = spark.createDataFrame([("\t".join(x),) for x in (
        head, ["chr1", "69511", "A", "G", "a,b"], ["chr1", "69511", "A", "G", "c"], ["chr1", "x", "A", "G", ""],
        ["chrUn_KI", "1", "A", "G", "d,e,f"], ["chr2", "5", "A", "G", "g"])], "value string")
    rows = extract.with_keys(extract.parse_lines(lines, head, primary_only=False), "GRCh38")
    stored = spark.createDataFrame([("24CFF52FA825D6CD7DABCD955F42DF1C", "CHR1:g.69511A>T")], "uid string, mutationId string")
    found = other_jobs.load_check(rows, stored)
    row = found["statistics"].first().asDict()
    assert row == {"processed": 5, "found": 2, "not_found": 1, "discarded": 1, "errors": 1, "annotations": 7, "total": 5,
                   "verdict": "failed", "average": 1.4}
    assert [(r["uid"][:4], r["n"]) for r in found["duplicates"].collect()] == [("24CF", 2)]
    assert [(r["mutation_id"], r["stored"]) for r in found["collisions"].collect()] == [("chr1:g.69511A>G", "CHR1:g.69511A>T")]


DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@needs_data
def test_extract_files_are_small_beside_their_text(spark):
    t = Inputs(spark, DATA)
    files = glob.glob(f"{queries_cohort.written_extracts(t).removeprefix('file:')}/*.csv*")
    text = t.lines().agg(F.sum(F.length("value"))).first()[0]
    assert len(extract.file_headers(spark, os.path.dirname(files[0]))) >= 1
    assert sum(map(os.path.getsize, files)) < text / 4


@needs_data
def test_no_line_is_joined_before_the_load_check(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(other_jobs, "load_check", lambda rows, stored: seen.append(rows) or {})
    queries_cohort._checked(Inputs(spark, DATA))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
