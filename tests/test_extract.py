"""Extract lines: binding by name, depths, annotations, donors, whole documents."""

from pyspark.sql import functions as F

from variantloom.functions import annotation as a
from variantloom.operators.calls import long_calls, with_calls
from variantloom.plans import mutation_etl
from variantloom.sources import cohort, extract

# two extra columns (DN, DQ) in between: columns are bound by name
HEADER = ["CHROM", "POS", "REF", "ALT", "FILTER", "DP", "MQ", "QD", "GEN[*].GT", "GEN[*].AD", "GEN[*].DN", "GEN[*].GQ",
          "GEN[*].DQ", "CSQ"]


def record(**fields):
    return "|".join(fields.get(name.replace("1000", "k1000"), "") for name in a.RECORD_FIELDS)


def line(gt, ad, csq, chrom="chr1", pos="69511", ref="A", alt="G,<NON_REF>", qd="3.79"):
    return "\t".join([chrom, pos, ref, alt, "PASS", "131", "25.79", qd, gt, ad, ".,.,.", "117,0,267", ".,.,.", csq])


MISSENSE = dict(
    Consequence="splice_region_variant&missense_variant", IMPACT="MODERATE", SYMBOL="OR4F5", Gene="ENSG1",
    Feature_type="Transcript", BIOTYPE="protein_coding", CDS_position="421", Protein_position="141", Amino_acids="T/A",
    STRAND="1", VARIANT_CLASS="SNV")
FIRST = record(**MISSENSE, Feature="ENST1", PICK="1", CANONICAL="YES")
SECOND = record(
    **{**MISSENSE, "Consequence": "missense_variant&splice_region_variant"}, Feature="ENST2",
    Ensembl_transcriptid="ENST2&ENST1", FATHMM_pred=".&T", SIFT_pred="D&T", SIFT_rankscore="0.2&0.4",
    CADD_raw_rankscore="0.02205", DANN_rankscore="0.03553", gnomAD_exomes_AC="151263", gnomAD_exomes_AF="9.496911e-01",
    rs_dbSNP151="rs2691305&_rs7", clinvar_id="12", clinvar_trait="_x&y")
THIRD = record(**MISSENSE, Feature="ENST1")


def parsed(spark, *texts):
    head = ["#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t00011\t00061\tSP00036", "\t".join(HEADER)]
    lines = spark.createDataFrame([(t,) for t in [*head, *texts]], "value string")
    return extract.with_keys(extract.parse_lines(lines, extract.header_columns(lines)), "GRCh38"), lines


def sheet(spark):
    return spark.createDataFrame(
        [(0, "SP00011", "PA1", "FA1", "Proband", "1", "2", "L1"), (1, "SP00061", "PA2", "FA1", "FTH", "1", "1", "L1"),
         (2, "SP00036", "PA3", "FA1", "MTH", "2", "1", "L2")],
        "idx int, specimen string, patient_id string, family_id string, relation string, sex string, phenotype string, lab string")


def test_header_contig_and_keys(spark):
    rows, lines = parsed(
        spark, line("1/1,./.,1/1", "0,40,0,0,0,90", FIRST), line("1/1,./.,1/1", "0,40,0,0,0,90", FIRST, chrom="chrUn_KI1"))
    got = rows.collect()
    assert len(got) == 1
    assert got[0]["mutation_id"] == "chr1:g.69511A>G" and got[0]["alt"] == "G"
    assert got[0]["uid"] == "24CFF52FA825D6CD7DABCD955F42DF1C"
    samples = extract.sample_list(lines).orderBy("idx").collect()
    assert [r["specimen"] for r in samples] == ["SP00011", "SP00061", "SP00036"]


def test_short_depth_list(spark):
    rows, _ = parsed(spark, line("1/1,./.,0/1", "1,40,7,5,90", FIRST), line("./.,0/1,1/1", "0,0,1,2,3,4", FIRST, pos="2"))
    calls = long_calls(with_calls(rows), ["pos"]).orderBy("pos", "idx").collect()
    depths = [(r["pos"], r["ad_ref"], r["ad_alt"]) for r in calls]
    assert depths == [(2, 0, 0), (2, 1, 2), (2, 3, 4), (69511, 1, 40), (69511, 7, 7), (69511, 5, 90)]
    assert calls[0]["ad_freq"] == 0.0 and calls[1]["ad_freq"] == 2 / 3


def annotations(spark, csq, **options):
    rows, _ = parsed(spark, line("1/1,./.,1/1", "0,40,0,0,0,90", csq))
    return mutation_etl.with_annotations(rows, **options)


def test_predictions_start_at_their_record(spark):
    got = annotations(spark, ",".join([FIRST, SECOND, THIRD])).first()["annotations"]
    # the table comes from the second record, so the first does not see it
    assert got[0]["aa_change"] is None and got[0]["predictions"] is None
    assert got[1]["aa_change"] == "T141A" and got[1]["predictions"]["SIFT"] == "DAMAGING"
    assert got[1]["predictions"]["FATHMM"] is None
    assert got[2]["predictions"]["FATHMM"] == "TOLERATED" and got[2]["predictions"]["SIFT_score"] == 0.4
    assert got[2]["cdna_change"] == "421A>G" and got[2]["strand"] == 1


def test_take_while_and_skip(spark):
    csq = ",".join([FIRST, SECOND + "|x", THIRD])
    assert len(annotations(spark, csq).first()["annotations"]) == 1
    assert len(annotations(spark, csq, stop_at_malformed=False).first()["annotations"]) == 2
    assert annotations(spark, "").first()["annotations"] == []


def test_annotation_rows_equal_the_nested_form(spark):
    for csq in (",".join([FIRST, SECOND, THIRD]), ",".join([THIRD, THIRD + "|x", FIRST]) + ",,", SECOND + "|x", ""):
        lines = annotations(spark, csq)
        rows = mutation_etl.annotation_rows(lines, ["uid"])
        nested = lines.select("uid", F.inline("annotations"))
        assert rows.columns == nested.columns
        assert sorted(rows.collect(), key=lambda r: r["pos"]) == sorted(nested.collect(), key=lambda r: r["pos"])


def test_annotation_rows_make_only_what_is_read(spark):
    one = mutation_etl.annotation_rows(annotations(spark, FIRST), ["uid"]).select("uid", "consequence")
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert "gnomAD" not in plan and "FATHMM" not in plan and "_transcripts" not in plan


def test_consequence_groups_ignore_order_of_the_set(spark):
    rows = annotations(spark, ",".join([FIRST, SECOND, THIRD]))
    groups = rows.select(a.consequence_groups(F.col("annotations")).alias("g")).first()["g"]
    # the amino-acid change separates the first record from the other two
    assert [len(x["transcripts"]) for x in groups] == [1, 2]
    assert groups[0]["pick"] and groups[0]["canonical"] and not groups[1]["pick"]
    assert groups[1]["predictions"]["CADD_score"] == 0.02205


def test_documents_and_merge(spark, tmp_path):
    rows, _ = parsed(spark, line("0/1,0/0,0/0", "5,5,9,0,9,0", ",".join([FIRST, SECOND, THIRD])))
    members = spark.createDataFrame(
        [("ENSG1", "symbol:OFFICIAL"), ("ENSG1", "alias:A1"), ("ENSG1", "geneid:7"), ("ENSG1", "HP:1,term"),
         ("ENSG1", "op:123456name;AD,AR")], "ensembl_id string, member string")
    today = F.lit("2020-03-24").cast("date")
    document = mutation_etl.mutation_documents(rows, sheet(spark), members, today).first()
    assert document["specimenList"] == ["SP00011"] and document["impactScore"] == 3 and document["type"] == "SNV"
    donor = document["donors"][0]
    assert donor["genotypeFamily"] == "FTH:0/0,MTH:0/0" and donor["origin"] is None
    assert donor["transmission"] == ["AD", "DeNovo"] and donor["adFreq"] == 0.5
    interne = document["frequencies"]["interne"]
    assert (interne["AC"], interne["AN"], interne["HC"], interne["PN"]) == (1, 6, 0, 1)
    assert set(document["frequencies"]) == {"interne", "L1", "L2", "gnomAD_exomes"}
    assert document["frequencies"]["gnomAD_exomes"]["AC"] == 151263
    assert document["bdExt"]["dbSNP"] == ["rs2691305", "rs7"] and document["clinvar"]["clinvar_trait"] == ["x", "y"]
    gene = document["genes"][0]
    assert gene["geneSymbol"] == "OFFICIAL" and gene["alias"] == ["A1", "OR4F5"] and gene["hpo"] == ["term (HP:1)"]
    assert gene["omim"][0]["phenotypeMim"] == "123456" and gene["omim"][0]["inheritance"] == ["AD", "AR"]
    assert {c["geneAffectedSymbol"] for c in document["consequences"]} == {"OFFICIAL"}
    assert document["availableDbExt"] == {"dbSNP": True, "clinvar": True, "hpo": True}

    # whole job twice with the same batch: nothing changes
    first, second = str(tmp_path / "s1"), str(tmp_path / "s2")
    mutation_etl.run(rows, sheet(spark), members, today, first, batch_name="b1")
    mutation_etl.run(rows, sheet(spark), members, today, second, state=first, batch_name="b2")
    one, two = mutation_etl.read_state(spark, first), mutation_etl.read_state(spark, second)
    for name in one:
        assert one[name].count() == two[name].count(), name
    assert one["cohort"].collect() == two["cohort"].collect()
    assert two["gene_aliases"].collect()[0]["alias"] == "OR4F5"


def test_proband_last_is_alone(spark):
    rows, _ = parsed(spark, line("0/1,0/0,0/1", "5,5,9,0,4,6", FIRST))
    late = sheet(spark).withColumn("relation", F.when(F.col("idx") == 2, "Proband").otherwise("FTH"))
    got = mutation_etl.line_documents(rows, late, F.lit("2020-01-01").cast("date")).first()["donors"]
    proband = [d for d in got if d["relation"] == "Proband"][0]
    # judged alone: an unaffected single carrier fits the recessive rule only
    assert proband["genotypeFamily"] is None and proband["transmission"] == ["AR"]


def test_samples_without_patient_keep_columns(spark):
    """A sample that is not in the sheet leaves the others at their own column."""
    rows, _ = parsed(spark, line("0/0,1/1,0/1", "9,0,0,8,4,6", FIRST))
    known = sheet(spark).where("idx <> 0")
    document = mutation_etl.line_documents(rows, known, F.lit("2020-01-01").cast("date")).first()
    assert [(d["specimenId"], d["gt"], d["adAlt"]) for d in document["donors"]] == [("SP00061", "1/1", 8), ("SP00036", "0/1", 6)]
    assert document["frequencies"]["interne"]["AN"] == 4


def test_pedigree_files(spark, tmp_path):
    path = tmp_path / "a.ped"
    path.write_text("FA1 SP1  0       0       2       2\n\nFA2\tSP2\t0\t0\t1\tHP:0000268\n")
    rows = cohort.read_pedigree(spark, str(path)).orderBy("id").collect()
    assert [(r["family_id"], r["id"], r["sex"], r["phenotype"]) for r in rows] == [
        ("FA1", "SP1", "2", "2"), ("FA2", "SP2", "1", "HP:0000268")]
    assert cohort.read_pedigree(spark, str(path), stop_at_blank=True).count() == 1


def test_property_file(spark, tmp_path):
    path = tmp_path / "p.properties"
    entries = dict(
        specimen="SP1,SP2,SP3", relation="Proband,MTH,FTH", linkQty="2,0,0", linkPatient="P2,P3,.", linkSpecimen="SP2,SP3,.",
        patientId="P1,P2,P3", familyId="F,F,F", studyId="E,E,E", gender="f,f,m", organizationId="O,O,O", laboName="L,L,L",
        isProban="true,false,false", isAffected="true,false,true", practitionerId="R,R,R", sequencingStrategy="WXS",
        assemblyVersion="GRCh38", annotationTool="VEP 97", HpoQtyTerms="2,0,1", hpoTermsPos="HP:1,HP:2,HP:3,.")
    path.write_text("# comment\n" + "\n".join(f"{k}={v}" for k, v in entries.items()) + "\n")
    rows = cohort.read_properties(spark, str(path)).orderBy("pos").collect()
    assert [r["hpo_terms"] for r in rows] == [["HP:1", "HP:2"], [], ["HP:3"]]
    assert [r["isProband"] for r in rows] == [True, False, False]
    assert rows[0]["linked_specimens"] == ["SP2", "SP3"] and rows[0]["annotationTool"] == "VEP 97"


def test_samples_without_family_or_laboratory_stay(spark):
    rows, _ = parsed(spark, line("0/1,0/0,0/1", "5,5,9,0,9,9", FIRST))
    loose = sheet(spark).withColumns({
        "family_id": F.when(F.col("idx") != 2, F.col("family_id")), "lab": F.when(F.col("idx") != 1, F.col("lab"))})
    members = spark.createDataFrame([], "ensembl_id string, member string")
    document = mutation_etl.mutation_documents(rows, loose, members, F.lit("2020-03-24").cast("date")).first()
    assert [(d["specimenId"], d["familyId"]) for d in document["donors"]] == [("SP00011", "FA1"), ("SP00036", None)]
    counts = {k: (f["AC"], f["AN"], f["PN"]) for k, f in document["frequencies"].items()}
    assert counts == {"interne": (2, 6, 2), "L1": (1, 2, 1), "L2": (1, 2, 1)}


def test_lines_of_one_variant_are_joined(spark, tmp_path):
    """The key takes the first alternative allele only: both lines are one variant, and no carrier is lost."""
    rows, _ = parsed(
        spark, line("0/1,0/0,0/0", "5,5,9,0,9,0", FIRST), line("0/0,0/0,0/1", "9,0,9,0,5,5", FIRST, alt="G,TT,<NON_REF>"),
        line("0/1,0/0,0/0", "5,5,9,0,9,0", THIRD, alt="G,C"))
    assert {r["uid"] for r in rows.collect()} == {"24CFF52FA825D6CD7DABCD955F42DF1C"}
    members = spark.createDataFrame([], "ensembl_id string, member string")
    today = F.lit("2020-03-24").cast("date")
    document, = mutation_etl.mutation_documents(rows, sheet(spark), members, today).collect()
    assert sorted(d["specimenId"] for d in document["donors"]) == sorted(document["specimenList"]) == ["SP00011", "SP00036"]
    # a line without a new donor adds nothing
    assert (document["frequencies"]["interne"]["AC"], document["frequencies"]["interne"]["AN"]) == (2, 12)
    target = str(tmp_path / "state")
    mutation_etl.run(rows, sheet(spark), members, today, target)
    assert mutation_etl.read_state(spark, target)["donors"].count() == 2


def test_many_lines_of_one_variant(spark):
    """Joined as a fold over the lines in order would, but no window or task takes all lines of a variant."""
    import random

    rng = random.Random(4)
    gts = ["0/0", "0/1", "1/1", "./."]
    texts = [line(",".join(rng.choices(gts, [9, 1, 1, 1], k=3)), "5,5,5,5,5,5", rng.choice([FIRST, SECOND, THIRD]),
                  pos=str(pos), qd=str(rng.randrange(99))) for pos in (1, 2, 3, 4, 5, 6, 7, 8) for _ in range(1 if pos > 6 else 12)]
    texts += texts[:12]  # equal lines
    rows, _ = parsed(spark, *texts)
    twice = sheet(spark).withColumns({"specimen": F.when(F.col("idx") > 0, F.lit("SPX")).otherwise(F.col("specimen"))})
    for samples in (sheet(spark), twice):
        today = F.lit("2020-03-24").cast("date")
        lines = mutation_etl.numbered_lines(mutation_etl.line_documents(rows, samples, today)).localCheckpoint()
        joined = mutation_etl.joined_lines(lines)
        assert "Window" not in joined._jdf.queryExecution().optimizedPlan().toString()
        got = {r["uid"]: r.asDict(True) for r in joined.collect()}
        expected = {}
        for new in sorted((r.asDict(True) for r in lines.collect()), key=lambda r: r["_line"]["_content"]):
            new.pop("_line")
            old = expected.setdefault(new["uid"], new)
            fresh = [d for d in new["donors"] if d["specimenId"] not in old["specimenList"]]
            if old is new or not fresh:
                continue
            old["donors"] = old["donors"] + fresh
            old["specimenList"] = [d["specimenId"] for d in old["donors"]]
            for name, more in new["frequencies"].items():
                have = old["frequencies"].setdefault(name, more)
                if have is not more and name not in a.POPULATIONS:
                    for c in mutation_etl.COUNTS:
                        have[c] += more[c]
                    have["AF"] = have["AC"] / have["AN"] if have["AN"] else 0.0
        assert len(got) == 8 and got == expected


def test_half_a_state_is_an_error(spark, tmp_path):
    import pytest

    spark.range(1).write.parquet(str(tmp_path / "variants"))
    with pytest.raises(Exception):
        mutation_etl.read_state(spark, str(tmp_path))
