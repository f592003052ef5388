"""Tables prepared by operators from the stand-ins, with the same preparation as check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from assocspark.functions import clean
from assocspark.operators import genes
from assocspark.plans.registry import Inputs, prepared


def chrom_sql(column: str) -> str:
    """Check SQL of the file rule for chromosome text. TRY_CAST reads more in DuckDB, so digits are asked for."""
    bare = f"regexp_replace({column}, '^chr', '', 'i')"
    return f"""(CASE WHEN upper({bare}) IN ('M', 'MT') THEN 25 WHEN upper({bare}) = 'Y' THEN 24 WHEN upper({bare}) = 'X' THEN 23
  WHEN regexp_full_match({bare}, '[+-]?[0-9]+') THEN CAST({bare} AS BIGINT) END)"""


def _coded(raw):
    return raw.select(clean.chromosome_code("chrom").alias("chr"), *[c for c in raw.columns if c != "chrom"])


@prepared(
    "open_chromatin",
    "open_chromatin_raw",
    f"SELECT {chrom_sql('chrom')} AS chr, * EXCLUDE (chrom) FROM open_chromatin_raw",
)
def open_chromatin(t: Inputs):
    return _coded(t("open_chromatin_raw"))


@prepared(
    "dense_open_chromatin",
    "dense_open_chromatin_raw",
    f"SELECT {chrom_sql('chrom')} AS chr, * EXCLUDE (chrom) FROM dense_open_chromatin_raw",
)
def dense_open_chromatin(t: Inputs):
    return _coded(t("dense_open_chromatin_raw"))


@prepared(
    "peak_to_gene",
    "peak_to_gene_raw",
    f"""SELECT {chrom_sql('chrom')} AS chr, * EXCLUDE (chrom) REPLACE (substr(cell_type, 20) AS cell_type) FROM peak_to_gene_raw""",
)
def peak_to_gene(t: Inputs):
    raw = t("peak_to_gene_raw")
    return raw.select(
        clean.chromosome_code("chrom").alias("chr"),
        *[clean.strip_cell_type(c).alias(c) if c == "cell_type" else c for c in raw.columns if c != "chrom"],
    )


@prepared(
    "lineage_pairs",
    "gene_has_family hierarchy_closure family",
    """SELECT p.gene_key, p.family_id, f.name AS family_name FROM (
    SELECT 'HGNC:' || hgnc_id AS gene_key, CAST(family_id AS BIGINT) AS family_id FROM gene_has_family
    UNION
    SELECT 'HGNC:' || g.hgnc_id, CAST(h.parent_fam_id AS BIGINT) FROM gene_has_family g
    JOIN hierarchy_closure h ON h.child_fam_id = g.family_id AND h.parent_fam_id <> h.child_fam_id) p
  JOIN family f ON CAST(f.id AS BIGINT) = p.family_id""",
)
def lineage_pairs(t: Inputs):
    return genes.lineage_members(t("gene_has_family"), t("hierarchy_closure"), t("family")).distinct()


# The arrays of the gene table are compared as text, "[1, 2]" and "['a', 'b']".
@prepared(
    "gene_annotations",
    "hgnc gencode lineage_pairs",
    """SELECT h.hgnc_id, h.symbol, h.name, CAST(NULL AS VARCHAR) AS prev_symbols, replace(h.alias_symbol, '"', '') AS alias_symbols,
    split_part(h.ensembl_gene_id, '.', 1) AS ensembl_gene_id, h.entrez_id AS ncbi_gene_id,
    CAST(CASE replace(g.chrom, 'chr', '') WHEN 'X' THEN '23' WHEN 'Y' THEN '24' ELSE replace(g.chrom, 'chr', '') END AS BIGINT) AS chr,
    CAST(g.gene_start AS BIGINT) AS gene_start, CAST(g.gene_end AS BIGINT) AS gene_end, g.gene_strand AS strand, h.locus_type,
    coalesce(l.ids, '[]') AS gene_group_ids, coalesce(l.names, '[]') AS gene_group_names,
    '44' AS gencode_version, '2024-01-15' AS hgnc_version, '2024-02-20' AS download_date
  FROM hgnc h
  LEFT JOIN gencode g ON split_part(g.gene_id, '.', 1) = split_part(h.ensembl_gene_id, '.', 1)
  LEFT JOIN (SELECT gene_key, '[' || string_agg(CAST(family_id AS VARCHAR), ', ' ORDER BY family_id) || ']' AS ids,
      '[' || string_agg('''' || family_name || '''', ', ' ORDER BY family_id) || ']' AS names
    FROM lineage_pairs GROUP BY gene_key) l ON l.gene_key = h.hgnc_id
  WHERE h.symbol IS NOT NULL""",
)
def gene_annotations(t: Inputs):
    return genes.build_genes(
        t("hgnc"), t("gencode"), t("gene_has_family"), t("hierarchy_closure"), t("family"),
        gencode_version="44", hgnc_version="2024-01-15", download_date="2024-02-20",
    )


@prepared("genes_placed", "gene_annotations", "SELECT symbol, chr, gene_start, gene_end FROM gene_annotations")
def genes_placed(t: Inputs):
    return t("gene_annotations").select("symbol", F.col("chr"), "gene_start", "gene_end")
