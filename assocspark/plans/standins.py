"""Stand-in tables: association-shaped projections of the tables in the data folder.

The text runs unchanged in Spark SQL and in DuckDB, so a query and its check SQL start from
the same rows. Operators take DataFrames and column names and know nothing of these texts.
"""

from __future__ import annotations

import re

SOURCES = ("region", "nation", "lineitem", "orders", "part")

_REF = "CASE l_linenumber % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'T' END"
_ALT = "CASE l_linenumber % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'T' WHEN 2 THEN 'A' ELSE 'C' END"
_SITE = f"l_partkey % 24 + 1 AS chr, l_orderkey * 8 + l_linenumber AS pos, {_REF} AS ref"
_PEAK = (
    "'chr' || CAST({k} % 24 + 1 AS STRING) || '-' || CAST({k} * 250 AS STRING) || '-' || CAST({k} * 250 + 500 AS STRING)"
)

# Data set and data type of group key modulo 13; group 11 stands for a collection of many data sets.
_DATASETS = {
    0: "FinnGen_R14", 1: "FinnGen_R13_MVP_UKBB_labs", 2: "FinnGen_R13_UKBB", 3: "UKB_PPP", 4: "Open_Targets_26.06",
    5: "COVID19_HGI", 6: "PGC", 7: "PGC_SCZ_2022", 8: "GP2", 9: "IIBDGC", 10: "FinnGen_ATACseq", 12: "FinnGen_Olink",
}


def _dataset(key: str) -> str:
    cases = " ".join(f"WHEN {n} THEN '{name}'" for n, name in _DATASETS.items())
    return f"CASE ({key}) % 13 {cases} ELSE 'QTD' || lpad(CAST(({key}) AS STRING), 6, '0') END"


def _data_type(key: str) -> str:
    return (
        f"CASE ({key}) % 13 WHEN 3 THEN 'pQTL' WHEN 12 THEN 'pQTL' WHEN 10 THEN 'caQTL' WHEN 11 THEN 'eQTL' ELSE 'GWAS' END"
    )


# Groups have full keys, so their number grows with the data and their size does not.
_LINE = "l_partkey"
_SIDE1 = "o_custkey"
_SIDE2 = "(o_custkey + 24 * (o_orderkey % 13))"

# The dense stand-ins fold the keys to 312 groups and 500 places, so groups and overlaps grow with the data instead.
_DENSE_SITE = f"l_partkey % 24 + 1 AS chr, l_orderkey % 500 * 1000 + l_linenumber AS pos, {_REF} AS ref"
_DENSE_PEAK = (
    "'chr' || CAST(l_partkey % 24 + 1 AS STRING) || '-' || CAST(l_partkey % 500 * 1000 AS STRING) || '-' "
    "|| CAST(l_partkey % 500 * 1000 + 500 AS STRING)"
)


def _credible_sets(line: str, site: str, peak: str) -> str:
    return _sets_text(line, site, peak, f"{line} % 13", _dataset(line), _data_type(line), "lineitem")


def _sets_text(line: str, site: str, peak: str, group: str, dataset: str, data_type: str, source: str) -> str:
    return f"""
SELECT {dataset} AS dataset, {data_type} AS data_type,
  CASE WHEN {group} = 10 THEN {peak} ELSE 'G' || CAST({line} AS STRING) END AS trait,
  'T' || CAST(l_suppkey AS STRING) AS trait_original,
  CASE WHEN {group} IN (10, 11) THEN CASE l_linenumber % 3 WHEN 0 THEN 'l1.B' WHEN 1 THEN 'l1.CD4_T' ELSE 'l1.Mono' END END AS cell_type,
  {site}, {_ALT} AS alt,
  l_quantity AS mlog10p, l_discount - 5e-2 AS beta, CASE WHEN l_linenumber % 6 = 0 THEN NULL ELSE l_tax END AS se,
  CAST(l_orderkey * 7 % 1000 AS DOUBLE) / 1e3 AS pip,
  'CS' || CAST({line} AS STRING) AS cs_id, l_partkey % 40 + 1 AS cs_size,
  CAST(NULL AS DOUBLE) AS cs_min_r2,
  CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_discount * 1e1 END AS aaf,
  CASE l_orderkey % 5 WHEN 0 THEN 'missense_variant' WHEN 1 THEN 'frameshift_variant' WHEN 2 THEN 'stop_gained' WHEN 3 THEN 'intron_variant' END AS most_severe,
  CASE WHEN l_orderkey % 5 < 4 THEN 'G' || CAST({line} AS STRING) END AS gene_most_severe
FROM {source}"""


def _short_credible_sets(line: str, site: str, peak: str) -> str:
    """Spark's text of the same rows: the group is computed once a row, and its data set and type are looked up in lists.

    A chain of cases is copied into every filter on it. With the owners' filter the code of a row came to more than the 8,000 bytes of
    a method that the JVM compiles, so it was interpreted.
    """
    names, last = ", ".join(f"'{_DATASETS.get(n, '')}'" for n in range(13)), "CAST(line_group AS INT) + 1"
    types = ", ".join("'{}'".format({3: "pQTL", 12: "pQTL", 10: "caQTL", 11: "eQTL"}.get(n, "GWAS")) for n in range(13))
    dataset = f"CASE WHEN line_group >= 0 AND line_group <> 11 THEN element_at(array({names}), {last}) ELSE 'QTD' || lpad(CAST(({line}) AS STRING), 6, '0') END"
    data_type = f"CASE WHEN line_group >= 0 THEN element_at(array({types}), {last}) ELSE 'GWAS' END"
    return _sets_text(line, site, peak, "line_group", dataset, data_type, f"(SELECT *, {line} % 13 AS line_group FROM lineitem) AS grouped")


def _coloc_credsets(sets: str) -> str:
    return f"""
SELECT dataset, data_type, trait, trait_original, cell_type, chr, pos, ref, alt, mlog10p, beta, se, pip, cs_id
FROM {sets}"""


def _colocalization(side1: str, side2: str, start: str, length: str, hit2: str) -> str:
    return f"""
SELECT {_dataset(side1)} AS dataset1, {_dataset(side2)} AS dataset2,
  {_data_type(side1)} AS data_type1, {_data_type(side2)} AS data_type2,
  'G' || CAST({side1} AS STRING) AS trait1, o_orderpriority AS trait1_original, o_orderstatus AS trait2_original,
  CASE WHEN o_orderkey % 3 = 0 THEN 'l1.B' END AS cell_type1, CASE WHEN o_orderkey % 4 = 0 THEN 'l1.Mono' END AS cell_type2,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 'G' || CAST({side2} AS STRING) END AS trait2,
  'CS' || CAST({side1} AS STRING) AS cs1_id, 'CS' || CAST({side2} AS STRING) AS cs2_id,
  CAST(o_custkey % 24 + 1 AS STRING) || ':' || CAST({start} AS STRING) || ':A:G' AS hit1,
  CASE o_orderkey % 50 WHEN 0 THEN 'bad' WHEN 1 THEN '2:bad:A:G' ELSE CAST(o_custkey % 24 + 1 AS STRING) || ':' || CAST({hit2} AS STRING) || ':A:G' END AS hit2,
  o_totalprice / 1e6 AS hit1_beta, o_totalprice / 1e4 AS hit1_mlog10p, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice / 2e6 END AS hit2_beta,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice / 2e4 END AS hit2_mlog10p,
  o_custkey % 24 + 1 AS chr, {start} AS region_start_min, {start} + {length} AS region_end_max,
  CAST(o_orderkey % 10 AS DOUBLE) / 1e4 AS PP_H0_abf, CAST(o_orderkey % 11 AS DOUBLE) / 1e4 AS PP_H1_abf,
  CAST(o_orderkey % 12 AS DOUBLE) / 1e4 AS PP_H2_abf, CAST(o_orderkey % 14 AS DOUBLE) / 1e4 AS PP_H3_abf,
  CAST(o_orderkey * 13 % 1000 AS DOUBLE) / 1e3 AS PP_H4_abf,
  o_orderkey % 900 AS nsnps, o_orderkey % 1000 AS nsnps1, o_orderkey % 1100 AS nsnps2,
  CAST(o_custkey % 70 AS DOUBLE) / 1e1 AS cs1_log10bf, CAST(o_custkey % 80 AS DOUBLE) / 1e1 AS cs2_log10bf,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DOUBLE) / 1e2 END AS clpp,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS DOUBLE) / 5e1 END AS clpa,
  o_custkey % 40 + 1 AS cs1_size, o_custkey % 30 + 1 AS cs2_size, o_custkey % 20 AS cs_overlap, CASE WHEN o_custkey % 2 = 0 THEN '1,0' ELSE '1,1' END AS topInOverlap
FROM orders"""


def _open_chromatin(start: str, length: str) -> str:
    return f"""
SELECT CASE p_partkey % 28 WHEN 22 THEN 'chrX' WHEN 23 THEN 'Y' WHEN 24 THEN 'chrM' WHEN 25 THEN 'mt' WHEN 26 THEN 'GL000220.1' WHEN 27 THEN CAST(p_partkey % 29 AS STRING) ELSE 'chr' || CAST(p_partkey % 28 + 1 AS STRING) END AS chrom,
  {start} AS peak_start, {start} + {length} AS peak_end,
  CASE p_partkey % 6 WHEN 0 THEN 'marderstein_open_chromatin' WHEN 1 THEN 'li_brain_open_chromatin' WHEN 2 THEN 'catlas_open_chromatin' WHEN 3 THEN 'epimap_open_chromatin' WHEN 4 THEN 'calderon_open_chromatin' ELSE 'rosmap_open_chromatin' END AS dataset,
  CASE p_size % 3 WHEN 0 THEN 'brain' WHEN 1 THEN 'heart' ELSE 'immune' END AS tissue,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_retailprice END AS score,
  'peak' || CAST(p_partkey AS STRING) AS peak_id, CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'cell' || CAST(p_size % 7 AS STRING) END AS cell_type,
  CASE WHEN p_size % 2 = 0 THEN 'adult' ELSE 'fetal' END AS life_stage, CASE WHEN p_size % 3 = 0 THEN 'stimulated' END AS condition,
  'ATAC-seq' AS assay, CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'signal' END AS score_type, CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_partkey % 900 END AS n_cells,
  'CL:' || lpad(CAST(p_size AS STRING), 7, '0') AS cell_ontology_id, CASE WHEN p_size % 2 = 0 THEN 'UBERON:' || lpad(CAST(p_size AS STRING), 7, '0') END AS uberon_id,
  CASE WHEN p_size % 3 = 0 THEN 'G' || CAST(p_partkey AS STRING) END AS target_gene, CASE WHEN p_size % 3 = 0 THEN 'ENSG' || lpad(CAST(p_partkey AS STRING), 11, '0') END AS target_gene_id,
  'v1' AS version
FROM part"""


_SITES = "SELECT chr, pos, ref, CASE WHEN most_severe IS NULL THEN 'N' ELSE alt END AS alt FROM credible_sets"
_ANNOTATION = """CAST(chr AS STRING) || ':' || CAST(pos AS STRING) || ':' || ref || ':' || alt AS variant, chr, pos, ref, alt,
  CAST(pos % 40 AS DOUBLE) / 8e1 + 5e-1 AS INFO, CAST(pos % 100 AS DOUBLE) / 1e2 AS AF, pos % 3000 AS AC_Het, CASE WHEN pos % 9 = 0 THEN NULL ELSE pos % 300 END AS AC_Hom,
  CASE WHEN pos % 8 = 0 THEN NULL ELSE CAST(pos % 50 AS DOUBLE) / 1e1 END AS EXOME_enrichment_nfe, CASE WHEN pos % 5 = 0 THEN NULL ELSE CAST(pos % 60 AS DOUBLE) / 1e1 END AS GENOME_enrichment_nfe,
  pos % 100000 AS index, CASE pos % 4 WHEN 0 THEN 'missense_variant' WHEN 1 THEN 'intron_variant' ELSE 'stop_gained' END AS most_severe,
  'G' || CAST(pos % 312 AS STRING) AS gene_most_severe, 'rs' || CAST(pos AS STRING) AS rsid"""

_SETS = (_LINE, _SITE, _PEAK.format(k="l_partkey"))
_DENSE_SETS = (f"{_LINE} % 312", _DENSE_SITE, _DENSE_PEAK)

STANDINS: dict[str, str] = {
    "credible_sets": _credible_sets(*_SETS),
    "dense_credible_sets": _credible_sets(*_DENSE_SETS),
    "coloc_credsets": _coloc_credsets("credible_sets"),
    "dense_coloc_credsets": _coloc_credsets("dense_credible_sets"),
    "colocalization": _colocalization(
        _SIDE1, _SIDE2, "o_orderkey * 8", "500 + o_custkey % 50 * 200", f"{_SIDE2} * 250 + o_orderkey % 1000 * 400"
    ),
    "dense_colocalization": _colocalization(
        f"{_SIDE1} % 312", f"{_SIDE2} % 312", "o_orderkey % 500 * 1000", "5000", "o_orderkey * 3 % 500 * 1000"
    ),
    "exome_variant_results": f"""
SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'IBD_exome' ELSE 'genebass' END AS dataset, {_SITE}, {_ALT} AS alt,
  'G' || CAST({_LINE} AS STRING) AS gene,
  CASE l_linenumber % 3 WHEN 0 THEN 'pLoF' WHEN 1 THEN 'missense' ELSE 'synonymous' END AS annotation,
  l_quantity + 4 AS mlog10p, l_discount - 5e-2 AS beta, l_tax + 1e-2 AS se, l_tax AS af_overall,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_tax END AS af_cases, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_discount END AS af_controls,
  l_orderkey % 1000 AS ac, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_orderkey % 2000 END AS an,
  l_partkey % 5000 AS n_cases, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_partkey % 7000 END AS n_controls,
  'T' || CAST(l_suppkey % 50 AS STRING) AS trait, l_returnflag AS trait_original
FROM lineitem""",
    "gene_burden_results": """
SELECT CASE o_custkey % 4 WHEN 0 THEN 'genebass' WHEN 1 THEN 'BipEx2' WHEN 2 THEN 'IBD_exome' ELSE 'SCHEMA2' END AS dataset,
  'T' || CAST(o_custkey % 50 AS STRING) AS trait, 'G' || CAST(o_custkey AS STRING) AS gene,
  'ENSG' || lpad(CAST(o_custkey AS STRING), 11, '0') AS gene_id, o_custkey % 24 + 1 AS chr,
  o_custkey * 250 AS gene_start_pos, o_custkey * 250 + 900 AS gene_end_pos,
  CASE o_orderkey % 3 WHEN 0 THEN 'pLoF' WHEN 1 THEN 'missense' ELSE 'nonsynonymous' END AS annotation,
  o_totalprice / 5e4 AS mlog10p_burden, CASE WHEN o_orderkey % 9 = 0 THEN 0e0 ELSE 2e-1 END AS beta,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 1e-1 END AS se,
  o_orderkey % 90 AS total_variants, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 60 END AS total_variants_pheno,
  o_orderkey % 5000 AS n_cases, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderkey % 7000 END AS n_controls,
  o_orderpriority AS trait_original, CASE WHEN o_orderkey % 8 = 0 THEN '' WHEN o_orderkey % 8 = 1 THEN 'low count' END AS flags
FROM orders""",
    "asm_qtl": f"""
SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'deCODE_asmQTL_CpG' ELSE 'deCODE_asmQTL_MDS' END AS dataset, {_SITE},
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE {_ALT} END AS alt, 'rs' || CAST(l_orderkey AS STRING) AS rsid,
  l_discount - 5e-2 AS beta, l_tax + 1e-2 AS se, l_discount * 1e1 AS af, l_quantity AS mlog10p,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'intron_variant' END AS most_severe, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'G' || CAST({_LINE} AS STRING) END AS gene_most_severe,
  l_orderkey * 8 AS target_start, l_orderkey * 8 + 900 AS target_end, l_tax * 5e0 AS ref_methylrate, l_discount * 5e0 AS alt_methylrate,
  l_orderkey % 7000 AS n_haplotypes, CASE WHEN l_linenumber = 1 THEN 'primary' ELSE 'secondary' END AS variant_rank,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_orderkey % 30 END AS ld_count, CASE WHEN l_linenumber % 5 = 0 THEN 'INDEL' ELSE 'SNP' END AS vartype
FROM lineitem""",
    "open_chromatin_raw": _open_chromatin("p_partkey * 250", "200 + p_size % 10 * 150"),
    "dense_open_chromatin_raw": _open_chromatin("p_partkey % 500 * 1000", "500"),
    "variant_annotation": f"""
SELECT DISTINCT {_ANNOTATION}
FROM ({_SITES}) AS sites""",
    "variant_effect": """
SELECT chr, pos, ref, alt, variant, CASE WHEN pos % 2 = 0 THEN 'marderstein_chrombpnet' ELSE 'marderstein_flare' END AS dataset,
  CASE WHEN pos % 2 = 0 THEN 'chrombpnet' ELSE 'flare' END AS model, AF - 5e-1 AS score, AF > 8e-1 AS is_significant,
  rsid, CASE WHEN pos % 2 = 0 THEN 'cell' || CAST(pos % 7 AS STRING) END AS cell_type, CASE pos % 3 WHEN 0 THEN 'brain' WHEN 1 THEN 'heart' ELSE 'immune' END AS tissue,
  CASE WHEN pos % 2 = 0 THEN 'adult' ELSE 'fetal' END AS life_stage, 'logfc' AS score_type, CASE WHEN pos % 6 = 0 THEN NULL ELSE CAST(pos % 80 AS DOUBLE) / 1e1 END AS mlog10p,
  CASE WHEN AF > 5e-1 THEN 'up' WHEN AF < 5e-1 THEN 'down' END AS predicted_direction, AF AS quantile_rank, 'v2' AS version
FROM variant_annotation""",
    "mpra": " UNION ALL ".join(
        f"""
SELECT chr, pos, variant, ref, alt, '{line}' AS cell_line, CASE WHEN pos % 7 = 0 THEN NULL ELSE pos % 5 = 0 END AS emVar, AF - 5e-1 AS log2Skew, 'siraj_mpra' AS dataset,
  CASE WHEN pos % 2 = 0 THEN 'UKBB' ELSE 'BBJ' END AS cohort, pos % 3 = 0 AS active, {se} AS log2Skew_se, CASE WHEN pos % 7 = 0 THEN NULL ELSE CAST(pos % 90 AS DOUBLE) / 1e1 END AS log2Skew_mlog10p,
  AF * 2e0 AS log2FC, CAST(pos % 30 AS DOUBLE) / 1e1 AS log2FC_mlog10p, {rna} AS mean_RNA_ref, {rna} + 1e0 AS mean_RNA_alt
FROM variant_annotation"""
        for line, se, rna in (("meta", "1e-1", "CAST(NULL AS DOUBLE)"), ("K562", "CAST(NULL AS DOUBLE)", "AF * 9e1"), ("HEPG2", "CAST(NULL AS DOUBLE)", "AF * 8e1"))
    ),
    "hla_associations": """
SELECT CAST(6 AS BIGINT) AS chr, 30000000 + o_custkey % 3 * 1000000 AS pos,
  CASE o_custkey % 3 WHEN 0 THEN 'HLA-A' WHEN 1 THEN 'HLA-B' ELSE 'HLA-DQB1' END AS gene,
  CASE o_custkey % 3 WHEN 0 THEN 'A*' WHEN 1 THEN 'B*' ELSE 'DQB1*' END || lpad(CAST(o_custkey % 30 AS STRING), 2, '0') || ':01' AS allele,
  'PH' || CAST(o_orderkey % 200 AS STRING) AS phenotype,
  CASE WHEN o_totalprice > 4e5 THEN 0e0 ELSE 1e-9 END AS pval, o_totalprice / 1e3 AS mlogp,
  CAST(o_orderkey % 21 AS DOUBLE) / 1e1 - 1e0 AS beta, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 5e-2 END AS sebeta,
  CAST(o_custkey % 100 AS DOUBLE) / 1e2 AS af_alt, CAST(NULL AS DOUBLE) AS af_alt_cases, CAST(NULL AS DOUBLE) AS af_alt_controls,
  CAST(o_custkey % 10 AS DOUBLE) / 1e1 AS info, 'finngen_hla' AS dataset
FROM orders""",
    "peak_to_gene_raw": f"""
SELECT 'chr' || CASE WHEN p_partkey % 24 = 22 THEN 'X' WHEN p_partkey % 24 = 23 THEN 'Y' ELSE CAST(p_partkey % 24 + 1 AS STRING) END AS chrom,
  p_partkey * 250 AS peak_start, p_partkey * 250 + 500 AS peak_end, {_PEAK.format(k="p_partkey")} AS peak_id,
  'G' || CAST(p_partkey * 3 AS STRING) AS symbol, 'predicted.celltype.' || CASE p_size % 3 WHEN 0 THEN 'l1.B' WHEN 1 THEN 'l1.CD4_T' ELSE 'l1.Mono' END AS cell_type,
  'FinnGen_ATACseq' AS dataset, 'ENSG' || lpad(CAST(p_partkey * 3 AS STRING), 11, '0') AS gene_id,
  p_partkey % 9000 AS total_cell_num, p_partkey % 800 AS expr_cell_num, CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_partkey % 700 END AS open_cell_num,
  p_retailprice / 1e4 AS hurdle_zero_beta, p_retailprice / 1e5 AS hurdle_zero_se, p_retailprice / 1e3 AS hurdle_zero_z, p_retailprice / 5e2 AS hurdle_zero_nlog10p,
  p_retailprice / 2e4 AS hurdle_count_beta, p_retailprice / 2e5 AS hurdle_count_se, p_retailprice / 2e3 AS hurdle_count_z,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_retailprice / 4e2 END AS hurdle_count_nlog10p, p_retailprice * 2e0 AS hurdle_aic, p_retailprice * 3e0 AS hurdle_bic
FROM part""",
    "hgnc": """
SELECT 'HGNC:' || CAST(p_partkey AS STRING) AS hgnc_id, CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE 'G' || CAST(p_partkey AS STRING) END AS symbol,
  p_name AS name, 'ENSG' || lpad(CAST(p_partkey AS STRING), 11, '0') || '.' || CAST(p_size AS STRING) AS ensembl_gene_id,
  '"Alt' || CAST(p_partkey AS STRING) || '|B"' AS alias_symbol, p_type AS locus_type, CAST(p_partkey * 10 AS STRING) AS entrez_id
FROM part""",
    "gencode": """
SELECT CASE WHEN p_size > 7 THEN 'ENSG' ELSE 'ENSX' END || lpad(CAST(p_partkey AS STRING), 11, '0') || '.9' AS gene_id,
  CASE p_partkey % 24 WHEN 22 THEN 'chrX' WHEN 23 THEN 'chrY' ELSE 'chr' || CAST(p_partkey % 24 + 1 AS STRING) END AS chrom,
  CAST(p_partkey * 250 AS STRING) AS gene_start, CAST(p_partkey * 250 + p_size * p_size * 20 AS STRING) AS gene_end,
  CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS gene_strand
FROM part""",
    "gene_has_family": """
SELECT CAST(p_partkey + CASE WHEN p_brand = 'Brand#3' THEN 500000000 ELSE 0 END AS STRING) AS hgnc_id, CAST(p_partkey % 25 + 100 AS STRING) AS family_id FROM part""",
    "hierarchy_closure": """
SELECT CAST(n_regionkey + 10 AS STRING) AS parent_fam_id, CAST(n_nationkey + 100 AS STRING) AS child_fam_id, '1' AS distance FROM nation
UNION ALL SELECT '1', CAST(n_nationkey + 100 AS STRING), '2' FROM nation UNION ALL SELECT '1', CAST(r_regionkey + 10 AS STRING), '1' FROM region
UNION ALL SELECT CAST(n_nationkey + 100 AS STRING), CAST(n_nationkey + 100 AS STRING), '0' FROM nation""",
    "family": """
SELECT CAST(n_nationkey + CASE WHEN n_nationkey = 3 THEN 900 ELSE 100 END AS STRING) AS id, n_name AS name FROM nation
UNION ALL SELECT CAST(r_regionkey + 10 AS STRING), r_name FROM region UNION ALL SELECT '1', 'ROOT'""",
}

# Spark's texts of stand-ins that it makes with smaller shuffles or shorter code; the rows are the same. All annotation follows from the site.
SPARK_TEXTS: dict[str, str] = {
    "credible_sets": _short_credible_sets(*_SETS),
    "dense_credible_sets": _short_credible_sets(*_DENSE_SETS),
    "annotated_sites": _SITES,
    "variant_annotation": f"SELECT {_ANNOTATION} FROM (SELECT DISTINCT chr, pos, ref, alt FROM annotated_sites) AS sites",
}
_NAMES = "|".join((*SOURCES, *STANDINS, *SPARK_TEXTS))
_READ = re.compile(rf"\b(FROM|JOIN)\s+({_NAMES})\b")


def inputs_of(sql: str) -> list[str]:
    """Tables and stand-ins that a text reads."""
    return list(dict.fromkeys(m[1] for m in _READ.findall(sql)))


def as_template(sql: str) -> str:
    """The text with table names as ``{name}`` fields, so that no temp views are needed."""
    return _READ.sub(r"\1 {\2}", sql)
