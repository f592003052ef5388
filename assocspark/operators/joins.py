"""Equality joins between the result tables.

No side is broadcast by hint: Spark broadcasts a side whose measured size is below its
threshold, else it sorts and merges, and adaptive execution splits keys that hold very many
rows. Filters and columns are named before the join, so both reach the scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocspark.functions import clean
from assocspark.operators import cells

SITE = ("chr", "pos", "ref", "alt")


def caqtl_to_gene(
    credible_sets: DataFrame, links: DataFrame, same_cell_type: bool = True, same_chr: bool = False
) -> DataFrame:
    """Genes linked to the peaks of caQTL credible sets, in the same cell type or in any.

    With ``same_chr`` the variant must lie on the chromosome of the peak. For links of a few genes
    Spark then reads only their chromosomes of the credible sets.
    """
    peaks = credible_sets.filter(F.col("data_type") == "caQTL").select(
        F.col("trait").alias("peak_id"), "cell_type", "dataset", "cs_id", "chr", "pos", "ref", "alt", "pip"
    )
    shown = ["symbol", *peaks.columns] if same_cell_type else ["symbol", "link_cell_type", *peaks.columns]
    genes = links.select("peak_id", F.col("cell_type").alias("link_cell_type"), F.col("chr").alias("link_chr"), "symbol")
    pairs = peaks.join(genes, "peak_id")
    if same_cell_type:
        pairs = pairs.filter(F.col("cell_type") == F.col("link_cell_type"))
    if same_chr:
        pairs = pairs.filter(F.col("chr") == F.col("link_chr"))
    return pairs.select(*shown)


def _near_gene(window: int) -> Column:
    return F.col("hit2_pos").between(F.col("gene_start") - window, F.col("gene_end") + window)


def _qtl_with_gene(colocalization: DataFrame, genes: DataFrame, data_type: str) -> DataFrame:
    qtls = colocalization.filter(F.col("data_type2") == data_type).select(
        "dataset1", "dataset2", "trait1", "trait2", "hit1", "hit2", "PP_H4_abf",
        clean.variant_position("hit2").alias("hit2_pos"),
        clean.variant_chromosome("hit2").alias("hit2_chr"),
    )
    placed = genes.select("symbol", F.col("chr").alias("gene_chr"), "gene_start", "gene_end")
    return qtls.join(placed, F.col("trait2") == F.col("symbol"))


def cis_colocalization(
    colocalization: DataFrame, genes: DataFrame, window: int = 1_000_000, match_chr: bool = False, data_type: str = "pQTL"
) -> DataFrame:
    """Colocalizations whose QTL lead lies within ``window`` of the gene it is a QTL for.

    The plain form compares positions only, so a lead at a similar position of another
    chromosome counts; ``match_chr`` also asks for the same chromosome.
    """
    pairs = _qtl_with_gene(colocalization, genes, data_type).filter(_near_gene(window))
    if match_chr:
        pairs = pairs.filter(F.col("hit2_chr") == F.col("gene_chr"))
    return pairs.drop("trait2", "gene_chr", "hit2_chr")


def trans_colocalization(
    colocalization: DataFrame, genes: DataFrame, window: int = 1_000_000, match_chr: bool = False, data_type: str = "pQTL"
) -> DataFrame:
    """The other colocalizations. A lead without a readable position is neither cis nor trans."""
    pairs = _qtl_with_gene(colocalization, genes, data_type)
    placed = F.col("hit2_pos").isNotNull() & F.col("gene_start").isNotNull() & F.col("gene_end").isNotNull()
    far = ~_near_gene(window)
    if match_chr:
        far = far | (F.col("hit2_chr") != F.col("gene_chr"))
    return pairs.filter(placed & far).drop("trait2", "gene_chr", "hit2_chr")


def colocalized_members(
    colocalization: DataFrame, members: DataFrame, sides: tuple[int, ...] = (1, 2), spread: bool = False
) -> DataFrame:
    """Variants of the colocalized sets, with the side they are on.

    The sides of a pair become rows, so the members, the larger table, are shuffled once. Sets with very many members and pairs are
    dealt over tasks by their product; with ``spread`` the sets are taken to be small and are not counted.
    """
    either = F.array(
        *[
            F.struct(F.lit(i).alias("side"), F.col(f"dataset{i}").alias("dataset"), F.col(f"cs{i}_id").alias("cs_id"))
            for i in sides
        ]
    )
    pairs = colocalization.select("dataset1", "cs1_id", "dataset2", "cs2_id", "PP_H4_abf", F.inline(either))
    variants = members.select("dataset", "cs_id", *SITE, "pip")
    keys = ["dataset", "cs_id"]
    joined = pairs.join(variants, keys) if spread else cells.join(pairs, variants, keys)
    return joined.drop(*keys)


def annotate_variants(
    variants: DataFrame, annotations: DataFrame, columns: list[str], how: str = "inner", keys: tuple[str, ...] = SITE
) -> DataFrame:
    """Add annotation columns by site, or by ``keys=("chr", "variant")`` where both sides store the id.

    The keys spread well, and the chromosome among them prunes partitions of one side by a filter
    on the other.
    """
    return variants.join(annotations.select(*keys, *columns), list(keys), how)
