"""Explicit schemas of inputs and documents, as DDL text."""

PEDIGREE = "family_id string, id string, paternal_id string, maternal_id string, sex string, phenotype string"

GENE_MEMBERS = "ensembl_id string, member string"

PATIENT_DOCUMENT = """
id string, familyId string, isProband boolean, status boolean, gender string,
studies array<struct<id: string>>,
serviceRequests array<struct<specimen: array<struct<id: string>>, code: struct<text: string>, requester_id: string,
  ci_ref: string, requester_org_id: string, requester_org_name: string, requester_org_alias: string>>,
clinicalImpressions array<struct<id: string, assessor_id: string, assessor_org_id: string, assessor_role_id: string,
  observations: array<struct<observed: string, phenotype: array<struct<code: string, display: string>>>>>>,
generalPractitioner array<struct<id: string>>,
practitioners array<struct<id: string, role_id: string, role_org_id: string>>,
link array<struct<id: string, relationship: string>>
"""

RANKED_REPORT = """
geneSymbol string, geneIdentifier struct<geneId: string>, combinedScore double,
variantEvaluations array<struct<chromosome: bigint, position: bigint, ref: string, alt: string,
  compatibleInheritanceModes: array<string>>>
"""

# Columns of the cross-reference file up to the one that is read.
GENE_INFO_HEAD = ("tax_id", "gene_id", "symbol", "locus_tag", "synonyms", "db_xrefs")
