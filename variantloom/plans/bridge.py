"""Genomic inputs derived from generic order tables, so that every operator runs over whole given tables.

The view texts are portable SQL; Spark runs them here, a checking engine can inline them. Each input row
comes from one table row or from one grouped key; nothing is sampled and nothing is fixed in size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from variantloom.functions.annotation import RECORD_FIELDS
from variantloom.operators.legacy import COLUMNS as LEGACY_COLUMNS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
BUILD = "GRCh38"
SAMPLES = 5
RECORDS = 3


def _text(expression: str) -> str:
    return f"cast({expression} AS string)"


def _case(value: str, options: list[str], default: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options))
    return f"CASE {value} {whens} ELSE {default} END"


def _chrom(key: str) -> str:
    return (
        f"concat('chr', CASE WHEN {key} % 25 < 22 THEN {_text(f'{key} % 25 + 1')} WHEN {key} % 25 = 22 THEN 'X' "
        f"WHEN {key} % 25 = 23 THEN 'Y' ELSE 'Un_KI270442v1' END)"
    )


def _gene(key: str) -> str:
    return f"concat('ENSG', lpad({_text(key)}, 11, '0'))"


VIEWS = {
    # variant sites
    "gx_sites": f"""
SELECT p_partkey AS site_id, {_chrom('p_partkey')} AS chrom, 1000 + p_partkey * 37 AS pos,
       substr('ACGT', cast(p_size % 4 + 1 AS int), 1) AS ref,
       concat(substr('CGTA', cast(p_size % 4 + 1 AS int), 1),
              CASE WHEN p_size % 5 = 0 THEN ',<NON_REF>' ELSE '' END) AS alt
FROM {{part}}""",
    # one genotype call per (site, sample); the greatest genotype is taken as a number, which aggregates by hash
    "gx_calls": """
SELECT l_partkey AS site_id, l_suppkey AS specimen,
       CASE max(CASE concat(l_returnflag, l_linestatus) WHEN 'RF' THEN 4 WHEN 'RO' THEN 3 WHEN 'AF' THEN 3
           WHEN 'AO' THEN 2 WHEN 'NF' THEN 1 ELSE 5 END)
           WHEN 1 THEN './.' WHEN 2 THEN '0/0' WHEN 3 THEN '0/1' WHEN 4 THEN '1/1' ELSE '1|0' END AS gt,
       cast(sum(l_linenumber) AS bigint) AS ad_ref, cast(sum(l_quantity) AS bigint) AS ad_alt
FROM {lineitem} GROUP BY l_partkey, l_suppkey""",
    # pedigree: trios of three consecutive keys
    "gx_ped": """
SELECT s_suppkey AS specimen, cast(floor(s_suppkey / 3) AS bigint) AS family_id, s_suppkey % 3 AS member,
       CASE s_suppkey % 3 WHEN 0 THEN 'Proband' WHEN 1 THEN 'FTH' ELSE 'MTH' END AS relation,
       CASE s_suppkey % 3 WHEN 1 THEN '1' WHEN 2 THEN '2'
            ELSE CASE cast(floor(s_suppkey / 3) AS bigint) % 5 WHEN 4 THEN '0' WHEN 1 THEN '1' WHEN 3 THEN '1'
                 ELSE '2' END END AS sex,
       CASE s_suppkey % 3 WHEN 0 THEN '2'
            WHEN 1 THEN CASE WHEN cast(floor(s_suppkey / 3) AS bigint) % 4 IN (1, 3) THEN '2' ELSE '1' END
            ELSE CASE WHEN cast(floor(s_suppkey / 3) AS bigint) % 4 IN (2, 3) THEN 'HP:0000268' ELSE '1' END
            END AS phenotype
FROM {supplier}""",
    # patient attributes per sample
    "gx_patients": """
SELECT s_suppkey AS specimen, concat('PA', lpad(cast(s_suppkey AS string), 9, '0')) AS patient_id,
       concat('LAB', cast(s_nationkey % 4 AS string)) AS lab, concat('ET', cast(s_nationkey AS string)) AS study_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'WXS' ELSE 'WGS' END AS strategy,
       concat('HP:', lpad(cast(s_suppkey AS string), 9, '0')) AS hpo_a,
       concat('HP:', lpad(cast(s_suppkey + 2 AS string), 9, '0')) AS hpo_b
FROM {supplier}""",
    # one functional annotation per order line; (ord_a .. ord_d) is its order within the site
    "gx_ann": f"""
SELECT l_partkey AS site_id, l_orderkey AS ord_a, l_linenumber AS ord_b, l_suppkey AS ord_c, l_extendedprice AS ord_d,
       CASE l_linenumber % 4 WHEN 0 THEN 'missense_variant' WHEN 1 THEN 'splice_region_variant&intron_variant'
            WHEN 2 THEN 'intron_variant&splice_region_variant' ELSE 'synonymous_variant' END AS consequence,
       CASE l_linenumber WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MODERATE' WHEN 3 THEN 'LOW' WHEN 4 THEN 'MODIFIER'
            WHEN 5 THEN 'high' ELSE '' END AS impact,
       CASE WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN '' ELSE concat('SYM', {_text('l_suppkey')}) END AS symbol,
       {_gene('l_suppkey')} AS gene_id,
       CASE WHEN l_suppkey % 2 = 0 THEN '1' ELSE '-1' END AS strand,
       CASE WHEN l_linenumber = 1 THEN '1' ELSE '' END AS pick,
       CASE WHEN l_linenumber = 2 THEN 'YES' ELSE '' END AS canonical,
       CASE WHEN l_linenumber = 7 THEN '.' ELSE {_text('l_linenumber')} END AS pop_ac,
       CASE WHEN l_linenumber = 6 THEN '' ELSE concat('0.', {_text('l_linenumber')}) END AS pop_af,
       concat('rs', {_text('l_suppkey')}, CASE WHEN l_linenumber = 3 THEN '&_rs7' ELSE '' END) AS dbsnp,
       CASE l_linenumber % 3 WHEN 0 THEN 'SNV' WHEN 1 THEN 'insertion' ELSE '' END AS variant_class,
       CASE WHEN l_linenumber = 4 AND l_returnflag = 'N' THEN 1 ELSE 0 END AS malformed
FROM {{lineitem}}""",
    # gene rows and their knowledge-set members, one gene per supplier
    "gx_genes": f"""
SELECT s_suppkey AS gene_no, {_gene('s_suppkey')} AS ensembl_id,
       CASE WHEN s_suppkey % 3 = 0 THEN concat('OFF', {_text('s_suppkey')}) ELSE concat('sym', {_text('s_suppkey')})
       END AS official, s_name AS alias, s_nationkey AS nation
FROM {{supplier}}""",
    # two overlapping batches of calls
    "gx_batches": """
SELECT 1 AS batch, site_id, specimen, gt, ad_ref, ad_alt FROM {gx_calls} WHERE specimen % 2 = 0 OR specimen % 3 = 0
UNION ALL
SELECT 2 AS batch, site_id, specimen, gt, ad_ref, ad_alt FROM {gx_calls} WHERE specimen % 2 = 1""",
    # sample columns of the extract lines: a trio, then a family whose proband comes last
    "gx_sheet": """
SELECT r_regionkey AS idx, concat('SP', lpad(cast(r_regionkey AS string), 5, '0')) AS specimen,
       concat('FA', cast(floor(r_regionkey / 3) AS bigint)) AS family_id,
       concat('PA', lpad(cast(r_regionkey AS string), 5, '0')) AS patient_id, r_name AS study_id,
       CASE r_regionkey % 3 WHEN 0 THEN CASE WHEN r_regionkey = 3 THEN 'MTH' ELSE 'Proband' END
            WHEN 1 THEN CASE WHEN r_regionkey = 4 THEN 'Proband' ELSE 'FTH' END ELSE 'MTH' END AS relation,
       CASE r_regionkey WHEN 0 THEN '1' WHEN 1 THEN '1' ELSE '2' END AS sex,
       CASE r_regionkey WHEN 0 THEN '2' WHEN 2 THEN 'HP:0000268' WHEN 4 THEN '2' ELSE '1' END AS phenotype,
       concat('LAB', cast(r_regionkey % 2 AS string)) AS lab
FROM {region}""",
}
VIEWS["gx_members"] = f"""
SELECT ensembl_id, {{{{unnest}}}}concat('symbol:', official), concat('alias:', alias),
       concat('HP:', lpad({_text('gene_no')}, 9, '0'), ',term ', {_text('gene_no')}),
       concat('HP:', lpad({_text('gene_no + 1')}, 9, '0'), ',term ', {_text('gene_no + 1')}),
       concat('Orph:', {_text('gene_no')}, ',panel ', {_text('nation')}, ';did:', {_text('100 + gene_no')}),
       concat('op:', lpad({_text('gene_no % 1000000')}, 6, '0'), 'phenotype ', alias,
              CASE WHEN gene_no % 2 = 0 THEN ';AD,AR' ELSE '' END),
       CASE WHEN gene_no % 5 <> 0 THEN concat('geneid:', {_text('gene_no')})
            ELSE concat('Rad:', {_text('gene_no')}) END,
       concat('map_location:', {_text('nation')}, 'q1'), concat('omim:', {_text('200000 + gene_no')}),
       concat('hgnc:HGNC:', {_text('gene_no')}), concat('name:gene ', {_text('gene_no')}){{{{end}}}} AS member
FROM {{gx_genes}}"""


def _sample_columns() -> str:
    """Genotype, depth and quality of each sample of an extract line."""
    genotypes = ["'0/0'", "'0/1'", "'1/1'", "'./.'", "'1|0'"]
    columns = []
    for i in range(SAMPLES):
        code = f"(l_partkey + {i} * l_suppkey + {i * i} * l_linenumber) % 6"
        columns += [
            f"{_case(code, genotypes, chr(39) + '0|1' + chr(39))} AS g{i}",
            f"(l_partkey + {i}) % 40 AS r{i}", f"(l_suppkey * {i + 1}) % 50 AS a{i}",
            f"CASE WHEN (l_orderkey + {i}) % 9 = 0 THEN '.' ELSE {_text(f'(l_orderkey + {i}) % 99')} END AS q{i}",
        ]
    return ",\n       ".join(columns)


FILLED: set[int] = set()


def _record_text(j: int) -> str:
    """SQL text of one record: filled fields with the separators between them."""
    pieces, gap = [], ""
    for i in range(len(RECORD_FIELDS)):
        gap += "|" if i else ""
        if i in FILLED:
            pieces += [f"'{gap}'", f"f{j}_{i}"] if gap else [f"f{j}_{i}"]
            gap = ""
    tail = f"CASE WHEN bad{j} = 1 THEN '{gap}|x' ELSE '{gap}' END"
    return f"concat({', '.join([*pieces, tail])})"


def _record_columns() -> str:
    """The annotation fields of each record of an extract line; fields not named are empty."""
    columns = []
    for j in range(RECORDS):
        has_ids = f"{j} = 1 - (l_linenumber + 1) % 2" if j < 2 else "1 = 1"
        fields = {
            "Consequence": _case(f"(l_linenumber + {j}) % 4", [
                "'missense_variant'", "'splice_region_variant&intron_variant'",
                "'intron_variant&splice_region_variant'"], "'synonymous_variant'"),
            "IMPACT": _case(f"(l_linenumber + {2 * j}) % 6", ["'HIGH'", "'MODERATE'", "'LOW'", "'MODIFIER'", "'high'"], "''"),
            "SYMBOL": f"CASE WHEN l_linenumber = 5 AND {j} = 2 THEN '' ELSE concat('SYM', {_text(f'l_suppkey + {j // 2}')}) END",
            "Gene": f"CASE WHEN l_linenumber = 7 AND {j} = 1 THEN '' ELSE {_gene(f'l_suppkey + {j // 2}')} END",
            "Feature_type": "'Transcript'",
            "Feature": f"concat('ENST', {_text(f'l_partkey * 3 + {j}')})",
            "BIOTYPE": "'protein_coding'" if j % 2 == 0 else "'lncRNA'",
            "EXON": f"concat('1/', {_text('l_linenumber')})",
            "CDS_position": f"CASE WHEN l_linenumber = 7 THEN '' ELSE {_text('cast(l_quantity AS int)')} END",
            "Protein_position": _text("l_orderkey % 1000"),
            "Amino_acids": _case(f"(l_linenumber + {j}) % 3", ["'T/A'", "'S'"], "'.'"),
            "STRAND": "CASE WHEN l_linenumber = 6 THEN '' WHEN l_suppkey % 2 = 0 THEN '1' ELSE '-1' END",
            "PICK": "'1'" if j == 0 else "''",
            "VARIANT_CLASS": f"CASE l_linenumber % 3 WHEN 0 THEN 'SNV' WHEN 1 THEN 'insertion' ELSE '{('SNV', 'deletion', '')[j]}' END",
            "CANONICAL": f"CASE WHEN l_linenumber % 2 = 0 AND {j} = 1 THEN 'YES' ELSE '' END",
            "RefSeq": f"concat('NM_', {_text('l_partkey')})" if j == 0 else "''",
            "PUBMED": "CASE WHEN l_linenumber = 2 THEN '123&_456' ELSE '' END",
            "1000Gp3_AC": f"CASE WHEN l_linenumber = 7 THEN '.' ELSE {_text(f'l_linenumber + {j}')} END",
            "1000Gp3_AF": f"CASE WHEN (l_linenumber + {j}) % 3 = 0 THEN '' ELSE concat('0.', {_text(f'l_linenumber + {j}')}) END",
            "CADD_raw_rankscore": f"CASE WHEN l_linenumber = 3 THEN '.' ELSE concat('0.', {_text('l_suppkey % 100')}) END",
            "DANN_rankscore": "'0.5'",
            "Ensembl_transcriptid": f"CASE WHEN {has_ids} THEN concat('ENST', {_text('l_partkey * 3')}, '&ENST', {_text('l_partkey * 3 + 1')}) ELSE '' END",
            "FATHMM_rankscore": "'0.1&0.2'", "FATHMM_pred": "'D&T'", "LRT_rankscore": "'0.44'", "LRT_pred": "'N'",
            "Polyphen2_HVAR_pred": "'B&P'", "Polyphen2_HVAR_rankscore": "'0.6&0.7'", "REVEL_rankscore": "'.'",
            "SIFT_rankscore": "CASE WHEN l_linenumber % 3 = 0 THEN '0.3' ELSE '0.3&0.4' END", "SIFT_pred": "'T&.'",
            "clinvar_OMIM": "CASE WHEN l_linenumber = 4 THEN '600001&_600002' ELSE '' END",
            "clinvar_Orphanet": f"CASE WHEN l_linenumber = 4 THEN '{('.', 'ORPHA7', 'ORPHA8')[j]}' ELSE '' END",
            "clinvar_clnsig": "CASE WHEN l_linenumber = 4 THEN 'Benign&_risk_factor' ELSE '' END",
            "clinvar_id": f"CASE WHEN l_linenumber = 4 THEN {_text('l_orderkey % 1000')} ELSE '' END",
            "clinvar_trait": "CASE WHEN l_linenumber = 4 THEN '_trait_a&trait_b' ELSE '' END",
            "gnomAD_exomes_AC": f"CASE WHEN l_linenumber = 1 THEN '1.5E1' ELSE {_text('l_suppkey')} END",
            "gnomAD_exomes_AF": f"CASE WHEN l_linenumber = 2 AND {j} = 1 THEN '2.5e-3' ELSE '' END",
            "phyloP17way_primate_rankscore": f"CASE WHEN l_linenumber = 1 THEN '' ELSE concat('0.', {_text('l_partkey % 1000')}) END",
            "rs_dbSNP151": f"concat('rs', {_text('l_partkey')}, CASE WHEN l_linenumber = 3 THEN '&_rs7' ELSE '' END)",
        }
        columns += [f"{fields[name]} AS f{j}_{i}" for i, name in enumerate(RECORD_FIELDS) if name in fields]
        FILLED.update(i for i, name in enumerate(RECORD_FIELDS) if name in fields)
        bad = {1: "l_linenumber = 6 AND l_returnflag = 'A'", 2: "l_linenumber = 4 AND l_returnflag = 'N'"}.get(j, "1 = 0")
        columns.append(f"CASE WHEN {bad} THEN 1 ELSE 0 END AS bad{j}")
    return ",\n       ".join(columns)


# one extract line per order line: site columns, samples, annotation fields
VIEWS["gx_line"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_extendedprice,
       {_chrom('l_suppkey')} AS chrom, l_orderkey * 10 + l_linenumber AS pos,
       substr('ACGT', cast(l_partkey % 4 + 1 AS int), 1) AS ref,
       concat(substr('CGTA', cast(l_partkey % 4 + 1 AS int), 1),
              CASE WHEN l_partkey % 7 = 0 THEN ',TT' ELSE '' END,
              CASE WHEN l_partkey % 5 = 0 THEN ',<NON_REF>' ELSE '' END) AS alt,
       CASE WHEN l_linestatus = 'O' THEN 'PASS' ELSE 'LowDepth' END AS filter,
       CASE WHEN l_linenumber = 7 THEN '.' ELSE concat({_text('cast(l_quantity AS int)')}, '.5') END AS qd,
       {_sample_columns()},
       {_record_columns()}
FROM {{lineitem}}"""

_SHORT = "(l_linenumber % 2 = 1 AND (" + " OR ".join(f"g{i} = './.'" for i in range(SAMPLES)) + "))"

# older wide extract: filled columns by name, the other columns are empty
LEGACY_FIELDS = {
    "chrom": _chrom("l_suppkey"), "position": _text("l_orderkey * 10 + l_linenumber"),
    "id": f"CASE WHEN l_linenumber = 1 THEN concat(' rs', {_text('l_partkey')}) ELSE '' END",
    "reference": "substr('ACGT', cast(l_partkey % 4 + 1 AS int), 1)",
    "alt": "concat(substr('CGTA', cast(l_partkey % 4 + 1 AS int), 1), CASE WHEN l_partkey % 5 = 0 THEN ',<NON_REF>' ELSE '' END)",
    "dp": f"CASE WHEN l_linenumber = 7 THEN '' ELSE {_text('cast(l_quantity AS int)')} END",
    "qual": f"concat({_text('l_linenumber')}, '.5')", "allele": "'G,T'",
    "effet": f"concat('e', {_text('l_linenumber')}, ',e0')", "impact": "'HIGH,LOW'",
    "gene": f"concat('SYM', {_text('l_suppkey')}, ', ')", "geneId": f"concat(' ,ENSG', {_text('l_suppkey')})",
    "featureType": "'transcript,transcript'", "featureId": f"concat('NM_', {_text('l_partkey')}, ',NM_0')",
    "biotype": "'coding, '", "hgvsC": "'c.1A>G,'", "hgvsP": "',p.Ser1'",
    "cdnaPos": f"concat({_text('l_linenumber - 1')}, ',5')", "cdnaLen": "'100,200'", "cdsPos": "'0,-1'", "cdsLen": "'30,40'",
    "aaPos": "',5'", "aaLen": "'7,8'", "distance": f"concat({_text('l_linenumber')}, ',')", "rank": "'1,0'",
    "errors": "' ,W1'", "lof": "CASE WHEN l_linenumber = 2 THEN 'LOF' ELSE '' END",
    "snp": "CASE WHEN l_linenumber % 2 = 1 THEN 'true' ELSE 'false' END",
    "mnp": "CASE WHEN l_linenumber = 3 THEN 'true' ELSE 'false' END",
    "ins": "CASE WHEN l_linenumber = 4 THEN 'true' ELSE 'false' END",
    "del": "CASE WHEN l_linenumber IN (4, 5) THEN 'true' ELSE 'false' END",
    "mixed": "CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END",
    "hom": "CASE WHEN l_returnflag = 'A' THEN 'true' ELSE 'false' END",
    "het": "CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END",
    "exAC_AC": f"CASE WHEN l_linenumber = 1 THEN '' ELSE concat({_text('l_suppkey')}, ',9') END",
    "exAC_AF": f"CASE WHEN l_linenumber <= 2 THEN '' ELSE concat('0.', {_text('l_suppkey')}, ',0.9') END",
    "GERP___RS": f"concat('1.', {_text('l_linenumber')})",
    "d1000Gp3_AFR_AF": "CASE WHEN l_linenumber = 5 THEN '0.25' ELSE '' END",
    "SIFT_pred": "CASE WHEN l_linenumber = 6 THEN 'D,T' ELSE '' END",
    "gnomAD_exomes_AN": f"CASE WHEN l_linenumber = 4 THEN {_text('l_partkey')} ELSE '' END",
    "gq": _text("l_orderkey % 99"), "ac2": _text("l_suppkey % 3"), "gt": "'0/1'",
}
VIEWS["gx_legacy"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag,\n       "
    + ",\n       ".join(f"{v} AS v_{k}" for k, v in LEGACY_FIELDS.items()) + "\nFROM {lineitem}"
)
EXTRACT_HEADER = (
    "CHROM", "POS", "REF", "ALT", "FILTER", "DP", "MQ", "QD", "GEN[*].GT", "GEN[*].AD", "GEN[*].AF", "GEN[*].DP",
    "GEN[*].FT", "GEN[*].GQ", "GEN[*].SB", "CSQ",
)


def _outside_codegen(cells: str) -> str:
    """One text line as a one-element array. The lambda keeps this large text out of whole-stage code, whose
    single method would be too long for the JVM to compile."""
    return f"transform(array(concat_ws('\t', {cells})), line -> line)"


class Inputs:
    """The given tables and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def spread(self, name: str, *keys: str) -> DataFrame:
        """A table whose rows each become a wide text line: its narrow rows are dealt out first, at every size."""
        return self.table(name).repartition(*keys)

    def view(self, name: str) -> DataFrame:
        text = _engine_text(VIEWS[name], "explode(array(", "))")
        wide = name in ("gx_line", "gx_legacy")
        needed = {
            n: self.spread(n, "l_orderkey", "l_linenumber") if wide else self.table(n)
            for n in TABLES if f"{{{n}}}" in text
        }
        needed |= {n: self.view(n) for n in VIEWS if f"{{{n}}}" in text}
        return self.spark.sql(text, **needed)

    def lines(self, *carry: str) -> DataFrame:
        """Tab-separated extract lines with their order-line keys, and with other columns of their order lines."""
        samples = range(SAMPLES)
        depth = [
            f"CASE WHEN {_SHORT} AND g{i} = './.' THEN {_text(f'r{i}')} ELSE concat({_text(f'r{i}')}, ',', {_text(f'a{i}')}) END"
            for i in samples
        ]
        records = [_record_text(j) for j in range(RECORDS)]
        cells = {
            "CHROM": "chrom", "POS": _text("pos"), "REF": "ref", "ALT": "alt", "FILTER": "filter", "QD": "qd",
            "GEN[*].GT": f"concat_ws(',', {', '.join(f'g{i}' for i in samples)})",
            "GEN[*].AD": f"concat_ws(',', {', '.join(depth)})",
            "GEN[*].GQ": f"concat_ws(',', {', '.join(f'q{i}' for i in samples)})",
            "CSQ": f"concat_ws(',', {', '.join(records)})",
        }
        line = ", ".join(cells.get(name, "'.'") for name in EXTRACT_HEADER)
        # a generated column, so that filters on the text are not pushed into its assembly
        return self.view("gx_line").selectExpr(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", *carry,
            f"explode_outer({_outside_codegen(line)}) AS value")

    def legacy_lines(self) -> DataFrame:
        """Tab-separated lines of the older 130-column form with their order-line keys."""
        cells = ", ".join(f"v_{name}" if name in LEGACY_FIELDS else "''" for name in LEGACY_COLUMNS)
        return self.view("gx_legacy").selectExpr(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
            f"explode_outer({_outside_codegen(cells)}) AS value")

    def ranked_report(self) -> DataFrame:
        """Phenotype-ranked report rows: one gene with up to two variants per order line."""
        chromosome = F.col("l_suppkey") % 25
        evaluation = lambda shift, modes: F.struct(
            F.when(chromosome == 22, 23).otherwise(chromosome + 1).cast("bigint").alias("chromosome"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber") + shift).alias("position"),
            F.substring(F.lit("ACGT"), (F.col("l_partkey") % 4 + 1).cast("int"), F.lit(1)).alias("ref"),
            F.substring(F.lit("CGTA"), (F.col("l_partkey") % 4 + 1).cast("int"), F.lit(1)).alias("alt"),
            F.array(*[F.lit(m) for m in modes]).alias("compatibleInheritanceModes"))
        both = F.array(evaluation(0, ["AD", "AR"]), evaluation(5, ["XR"]))
        kept = F.when(F.col("l_linenumber") == 7, 0).when(F.col("l_linenumber") % 2 == 0, 1).otherwise(2)
        return self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.lit("SYM"), "l_suppkey").alias("geneSymbol"),
            F.struct(F.concat(F.lit("ENSG"), "l_suppkey").alias("geneId")).alias("geneIdentifier"),
            (F.col("l_discount") + F.col("l_linenumber") / 1000).alias("combinedScore"),
            F.slice(both, F.lit(1), kept).alias("variantEvaluations"))

    def patient_documents(self) -> DataFrame:
        """One nested patient document per customer."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
        code = lambda step: F.struct(
            cat("HP:", F.lpad((key + step).cast("string"), 9, "0")).alias("code"),
            cat("term ", key + step).alias("display"))
        request = lambda letter, strategy, alias: F.struct(
            F.array(F.struct(cat("SP", key, letter).alias("id"))).alias("specimen"),
            F.struct(F.lit(strategy).alias("text")).alias("code"), cat("PR", nation).alias("requester_id"),
            cat("ci", key, letter).alias("ci_ref"), cat("OR", nation).alias("requester_org_id"),
            F.col("c_mktsegment").alias("requester_org_name"), alias.alias("requester_org_alias"))
        impression = lambda letter, observations: F.struct(
            cat("CI", key, letter).alias("id"), cat("AS", key % 17).alias("assessor_id"),
            cat("OR", key % 7).alias("assessor_org_id"), cat("ROLE", key % 11).alias("assessor_role_id"),
            observations.alias("observations"))
        observation = lambda observed, *codes: F.struct(observed.alias("observed"), F.array(*codes).alias("phenotype"))
        impressions = F.array(
            impression("A", F.array(observation(F.lit("POS"), code(0), code(1)), observation(F.lit("NEG"), code(2)))),
            impression("B", F.array(observation(F.when(key % 2 == 0, "POS").otherwise("NEG"), code(3)))),
        )
        links = F.array(
            F.struct(cat("PA", key + 1).alias("id"), F.lit("FTH").alias("relationship")),
            F.struct(cat("PA", key + 2).alias("id"), F.lit("MTH").alias("relationship")))
        return self.table("customer").select(
            cat("PA", key).alias("id"), cat("FA", F.floor(key / 3)).alias("familyId"), (key % 3 == 0).alias("isProband"),
            ((key % 3 == 0) | (key % 4 == 1)).alias("status"),
            F.when(key % 2 == 0, "female").otherwise("male").alias("gender"),
            F.array(F.struct(cat("ET", nation).alias("id"))).alias("studies"),
            F.array(request("A", "WXS", F.substring("c_mktsegment", 1, 3)), request("B", "WGS", cat("L", nation % 4)))
            .alias("serviceRequests"),
            F.when(key % 5 == 0, F.slice(impressions, 1, 0)).otherwise(impressions).alias("clinicalImpressions"),
            F.array(F.struct(cat("ROLE", key % 11).alias("id"))).alias("generalPractitioner"),
            F.array(
                F.struct(F.lit("P0").alias("id"), F.lit("OTHER").alias("role_id"), F.lit("OR0").alias("role_org_id")),
                F.struct(cat("P", key % 11).alias("id"), cat("role", key % 11).alias("role_id"),
                         cat("OR", key % 13).alias("role_org_id")),
            ).alias("practitioners"),
            F.when(key % 3 == 0, links).otherwise(F.slice(links, 1, 0)).alias("link"),
        )


def _engine_text(text: str, opening: str, closing: str) -> str:
    return text.replace("{{unnest}}", opening).replace("{{end}}", closing)


def standalone_sql(body: str, *views: str) -> str:
    """``body`` with the views it names inlined as common table expressions, for a checking engine."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in VIEWS:
            if f"{{{other}}}" in VIEWS[name]:
                visit(other)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        visit(view)
    parts = []
    for name in ordered:
        text = _engine_text(VIEWS[name], "unnest([", "])")
        for other in (*TABLES, *VIEWS):
            text = text.replace(f"{{{other}}}", other)
        parts.append(f"{name} AS ({text.strip()})")
    head = "WITH " + ",\n".join(parts)
    if not parts:
        return body.strip()
    body = body.strip()
    return f"{head},\n{body[5:].strip()}" if body.upper().startswith("WITH ") else f"{head}\n{body}"
