"""Joins, interval joins and the gene build."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assocspark.operators import genes, intervals, joins, results
from assocspark.plans.registry import Inputs, query
from assocspark.sources import tables

_WINDOW = 100_000


@query(
    "caqtl_to_gene",
    "credible_sets peak_to_gene",
    """SELECT l.symbol, cs.trait AS peak_id, cs.cell_type, cs.dataset, cs.cs_id, cs.chr, cs.pos, cs.ref, cs.alt, cs.pip
FROM credible_sets cs JOIN peak_to_gene l ON l.peak_id = cs.trait AND l.cell_type = cs.cell_type
WHERE cs.data_type = 'caQTL'""",
)
def caqtl_to_gene(t: Inputs):
    return joins.caqtl_to_gene(t("credible_sets"), t("peak_to_gene"))


@query(
    "caqtl_to_gene_any_cell",
    "credible_sets peak_to_gene",
    """SELECT l.symbol, l.cell_type AS link_cell_type, cs.trait AS peak_id, cs.cell_type, cs.dataset, cs.cs_id, cs.chr, cs.pos,
  cs.ref, cs.alt, cs.pip FROM credible_sets cs JOIN peak_to_gene l ON l.peak_id = cs.trait WHERE cs.data_type = 'caQTL'""",
)
def caqtl_to_gene_any_cell(t: Inputs):
    return joins.caqtl_to_gene(t("credible_sets"), t("peak_to_gene"), same_cell_type=False)


@query(
    "caqtl_of_genes",
    "credible_sets peak_to_gene",
    """SELECT l.symbol, cs.trait AS peak_id, cs.cell_type, cs.dataset, cs.cs_id, cs.chr, cs.pos, cs.ref, cs.alt, cs.pip
FROM credible_sets cs JOIN peak_to_gene l ON l.peak_id = cs.trait AND l.cell_type = cs.cell_type AND l.chr = cs.chr
WHERE cs.data_type = 'caQTL' AND l.symbol IN ('G30', 'G69', 'G108')""",
)
def caqtl_of_genes(t: Inputs):
    links = t("peak_to_gene").filter(F.col("symbol").isin("G30", "G69", "G108"))
    return joins.caqtl_to_gene(t("credible_sets"), links, same_chr=True)


_LEADS = """(SELECT *, CASE WHEN hit2 LIKE '%:%' THEN TRY_CAST(split_part(hit2, ':', 2) AS BIGINT) END AS hit2_pos,
  CASE WHEN hit2 LIKE '%:%' THEN CAST(split_part(hit2, ':', 1) AS BIGINT) END AS hit2_chr FROM colocalization WHERE data_type2 = 'pQTL')"""
_COLOC = """SELECT c.dataset1, c.dataset2, c.trait1, a.symbol, c.hit1, c.hit2, c.hit2_pos, c.PP_H4_abf, a.gene_start, a.gene_end"""
_NEAR = f"c.hit2_pos BETWEEN a.gene_start - {_WINDOW} AND a.gene_end + {_WINDOW}"


@query(
    "cis_coloc",
    "colocalization genes_placed",
    f"{_COLOC} FROM {_LEADS} c JOIN genes_placed a ON c.trait2 = a.symbol WHERE {_NEAR}",
)
def cis_coloc(t: Inputs):
    return joins.cis_colocalization(t("colocalization"), t("genes_placed"), _WINDOW)


@query(
    "cis_coloc_same_chr",
    "colocalization genes_placed",
    f"{_COLOC} FROM {_LEADS} c JOIN genes_placed a ON c.trait2 = a.symbol WHERE c.hit2_chr = a.chr AND {_NEAR}",
)
def cis_coloc_same_chr(t: Inputs):
    return joins.cis_colocalization(t("colocalization"), t("genes_placed"), _WINDOW, match_chr=True)


@query(
    "trans_coloc",
    "colocalization genes_placed",
    f"{_COLOC} FROM {_LEADS} c JOIN genes_placed a ON c.trait2 = a.symbol WHERE NOT ({_NEAR})",
)
def trans_coloc(t: Inputs):
    return joins.trans_colocalization(t("colocalization"), t("genes_placed"), _WINDOW)


@query(
    "trans_coloc_other_chr",
    "colocalization genes_placed",
    f"""{_COLOC} FROM {_LEADS} c JOIN genes_placed a ON c.trait2 = a.symbol WHERE (c.hit2_chr <> a.chr OR NOT ({_NEAR}))
  AND c.hit2_pos IS NOT NULL AND a.gene_start IS NOT NULL AND a.gene_end IS NOT NULL""",
)
def trans_coloc_other_chr(t: Inputs):
    return joins.trans_colocalization(t("colocalization"), t("genes_placed"), _WINDOW, match_chr=True)


_MEMBER = """SELECT c.dataset1, c.cs1_id, c.dataset2, c.cs2_id, c.PP_H4_abf, v.chr, v.pos, v.ref, v.alt, v.pip, {side} AS side
FROM {kind}colocalization c JOIN {kind}coloc_credsets v ON v.dataset = c.dataset{side} AND v.cs_id = c.cs{side}_id"""


def _members_sql(kind: str = "") -> str:
    return " UNION ALL ".join(_MEMBER.format(side=side, kind=kind) for side in (1, 2))


@query("coloc_members", "dense_colocalization dense_coloc_credsets", _members_sql("dense_"))
def coloc_members(t: Inputs):
    """Few sets with very many members and pairs, so the result grows with the square of the input."""
    return joins.colocalized_members(t("dense_colocalization"), t("dense_coloc_credsets"))


def _bucketed(t: Inputs, table: str, keys: list[str], buckets: int, placed: bool = False):
    """A stand-in as a bucketed table; its catalog entry goes again, its files are read."""
    name = f"bucketed_{uuid.uuid4().hex}"
    tables.write_bucketed(t(table), table, name, t.scratch(), keys, buckets, placed)
    stored = t.spark.table(name)
    t.spark.sql(f"DROP TABLE {name}")
    return stored


@query("bucketed_members", "colocalization coloc_credsets", _members_sql())
def bucketed_members(t: Inputs):
    """The members, the larger side, are stored by set and not shuffled for the join."""
    buckets = tables.bucket_count(t("coloc_credsets").count())
    stored = _bucketed(t, "coloc_credsets", ["dataset", "cs_id"], buckets)
    return joins.colocalized_members(t("colocalization"), stored, spread=True)


@query(
    "bucketed_annotation",
    "credible_sets variant_annotation",
    """SELECT c.dataset, c.cs_id, c.chr, c.pos, c.ref, c.alt, c.pip, a.rsid, a.AF
FROM credible_sets c JOIN variant_annotation a ON (a.chr, a.pos, a.ref, a.alt) = (c.chr, c.pos, c.ref, c.alt)""",
)
def bucketed_annotation(t: Inputs):
    """Both sides are stored by site, so nothing is shuffled.

    The annotated sites are dealt to their buckets before they are made distinct and annotated, so that is the only shuffle of theirs.
    """
    site, buckets = list(joins.SITE), tables.bucket_count(t("credible_sets").count())
    variants = _bucketed(t, "credible_sets", site, buckets).select("dataset", "cs_id", *site, "pip")
    t.place("annotated_sites", site, buckets)
    return joins.annotate_variants(variants, _bucketed(t, "variant_annotation", site, buckets, placed=True), ["rsid", "AF"])


@query(
    "annotate_variants",
    "credible_sets variant_annotation",
    """SELECT c.dataset, c.cs_id, c.chr, c.pos, c.ref, c.alt, c.pip, a.rsid, a.AF
FROM credible_sets c JOIN variant_annotation a ON (a.chr, a.pos, a.ref, a.alt) = (c.chr, c.pos, c.ref, c.alt)""",
)
def annotate_variants(t: Inputs):
    variants = t("credible_sets").select("dataset", "cs_id", *joins.SITE, "pip")
    return joins.annotate_variants(variants, t("variant_annotation"), ["rsid", "AF"])


@query(
    "effects_of_variants",
    "variant_annotation variant_effect",
    """SELECT a.chr, a.variant, a.rsid, e.model, e.score, e.is_significant FROM variant_annotation a
JOIN variant_effect e ON e.chr = a.chr AND e.variant = a.variant""",
)
def effects_of_variants(t: Inputs):
    effects = t("variant_effect")
    variants = t("variant_annotation").select("chr", "variant", "rsid")
    return joins.annotate_variants(variants, effects, ["model", "score", "is_significant"], keys=("chr", "variant"))


@query(
    "variant_in_peak",
    "credible_sets open_chromatin",
    """SELECT v.chr, v.pos, v.ref, v.alt, v.dataset, v.cs_id, p.peak_start, p.peak_end, p.tissue
FROM credible_sets v JOIN open_chromatin p ON p.chr = v.chr AND v.pos > p.peak_start AND v.pos <= p.peak_end""",
)
def variant_in_peak(t: Inputs):
    variants = t("credible_sets").select("chr", "pos", "ref", "alt", "dataset", "cs_id")
    return intervals.variants_in_peaks(variants, t("open_chromatin").select("chr", "peak_start", "peak_end", "tissue"))


@query(
    "region_overlap",
    "dense_colocalization dense_open_chromatin",
    """SELECT c.chr, c.dataset1, c.dataset2, c.region_start_min, c.region_end_max, p.peak_start, p.peak_end, p.tissue
FROM dense_colocalization c JOIN dense_open_chromatin p
  ON p.chr = c.chr AND c.region_start_min - 1 < p.peak_end AND p.peak_start < c.region_end_max""",
)
def region_overlap(t: Inputs):
    """Regions and peaks share few places, so the result grows with the square of the input."""
    regions = t("dense_colocalization").select("chr", "dataset1", "dataset2", "region_start_min", "region_end_max")
    peaks = t("dense_open_chromatin").select("chr", "peak_start", "peak_end", "tissue")
    return intervals.overlapping(
        regions, peaks,
        F.col("region_start_min") - 1, F.col("region_end_max"), F.col("peak_start"), F.col("peak_end"),
    )


@query(
    "cis_credible_sets",
    "credible_sets genes_placed",
    """SELECT v.chr, v.pos, v.dataset, v.cs_id, v.pip, g.symbol, g.gene_start, g.gene_end FROM credible_sets v
JOIN genes_placed g ON g.chr = v.chr AND v.pos BETWEEN g.gene_start - 5000 AND g.gene_end + 5000""",
)
def cis_credible_sets(t: Inputs):
    variants = t("credible_sets").select("chr", "pos", "dataset", "cs_id", "pip")
    return intervals.variants_near_genes(variants, t("genes_placed"), 5_000)


@query(
    "variant_in_feature",
    "credible_sets open_chromatin genes_placed",
    """SELECT v.chr, v.pos, v.dataset, v.cs_id, 'peak' AS feature, p.peak_id AS name, p.peak_start AS feature_start, p.peak_end AS feature_end
FROM credible_sets v JOIN open_chromatin p ON p.chr = v.chr AND v.pos > p.peak_start AND v.pos <= p.peak_end
UNION ALL SELECT v.chr, v.pos, v.dataset, v.cs_id, 'gene', g.symbol, g.gene_start - 2001, g.gene_end + 2000
FROM credible_sets v JOIN genes_placed g ON g.chr = v.chr AND v.pos BETWEEN g.gene_start - 2000 AND g.gene_end + 2000""",
)
def variant_in_feature(t: Inputs):
    """Peaks of some hundred bases and genes of up to tens of thousands, in one join."""
    found = intervals.features(t("open_chromatin"), t("genes_placed"), 2_000)
    return intervals.variants_in_features(t("credible_sets").select("chr", "pos", "dataset", "cs_id"), found)


@query(
    "gene_coords",
    "hgnc gencode",
    """SELECT h.hgnc_id, split_part(h.ensembl_gene_id, '.', 1) AS ensembl_gene_id,
  CAST(CASE replace(g.chrom, 'chr', '') WHEN 'X' THEN '23' WHEN 'Y' THEN '24' ELSE replace(g.chrom, 'chr', '') END AS BIGINT) AS chr,
  CAST(g.gene_start AS BIGINT) AS gene_start, CAST(g.gene_end AS BIGINT) AS gene_end, g.gene_strand AS strand
FROM hgnc h LEFT JOIN gencode g ON split_part(g.gene_id, '.', 1) = split_part(h.ensembl_gene_id, '.', 1)""",
)
def gene_coords(t: Inputs):
    return genes.add_coordinates(t("hgnc").select("hgnc_id", "ensembl_gene_id"), t("gencode"))


@query(
    "closure_map",
    "hierarchy_closure gene_has_family",
    """SELECT CAST(h.child_fam_id AS BIGINT) AS child, CAST(h.parent_fam_id AS BIGINT) AS ancestor, count(g.hgnc_id) AS genes
FROM (SELECT DISTINCT child_fam_id, parent_fam_id FROM hierarchy_closure WHERE child_fam_id <> parent_fam_id) h
LEFT JOIN gene_has_family g ON g.family_id = h.child_fam_id GROUP BY ALL""",
)
def closure_map(t: Inputs):
    """Ancestors of each family, as pairs, with the genes they pass on."""
    per_family = genes.gene_families(t("gene_has_family")).groupBy("family_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = genes.family_ancestors(t("hierarchy_closure"))
    counted = pairs.join(per_family, F.col("child") == F.col("family_id"), "left")
    return counted.select("child", "ancestor", F.coalesce("n", F.lit(0)).alias("genes"))


@query(
    "gene_leaves",
    "gene_has_family",
    "SELECT DISTINCT 'HGNC:' || hgnc_id AS gene_key, CAST(family_id AS BIGINT) AS family_id FROM gene_has_family",
)
def gene_leaves(t: Inputs):
    return genes.gene_families(t("gene_has_family"))


@query(
    "gene_lineage",
    "lineage_pairs",
    """SELECT gene_key, '[' || string_agg(CAST(family_id AS VARCHAR), ', ' ORDER BY family_id) || ']' AS gene_group_ids,
  '[' || string_agg('''' || family_name || '''', ', ' ORDER BY family_id) || ']' AS gene_group_names
FROM lineage_pairs GROUP BY gene_key""",
)
def gene_lineage(t: Inputs):
    return results.stringify(genes.gene_lineage(t("gene_has_family"), t("hierarchy_closure"), t("family")))


@query("gene_build", "gene_annotations", "SELECT * FROM gene_annotations")
def gene_build(t: Inputs):
    return results.stringify(t("gene_annotations"))


@query(
    "lineage_check",
    "gene_annotations",
    """SELECT count(*) AS genes, count_if(gene_group_ids <> '[]') AS with_groups, count_if(gene_group_ids <> '[]') > 0 AS ok
FROM gene_annotations""",
)
def lineage_check(t: Inputs):
    return genes.lineage_present(t("gene_annotations"))
