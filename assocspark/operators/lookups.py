"""Filters, rankings and lookups over single tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assocspark.functions import clean
from assocspark.functions.resources import Rule, resource_expr

# Consequences that change the protein, and the HLA quality limits.
CODING = ("missense_variant", "frameshift_variant", "stop_gained")
HLA_MIN_INFO = 0.5
HLA_SIGNIFICANT = 7.3


def top(df: DataFrame, by: str, n: int, *tie_keys: str) -> DataFrame:
    """The ``n`` largest rows; each task keeps ``n`` rows, there is no full sort."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie_keys).limit(n)


def coding_variants(credible_sets: DataFrame, min_pip: float = 0.5) -> DataFrame:
    return credible_sets.filter((F.col("pip") > min_pip) & F.col("most_severe").isin(*CODING))


def genes_with_many_coding(credible_sets: DataFrame, min_pip: float = 0.5, more_than: int = 2) -> DataFrame:
    """Genes with several likely causal coding variants, largest first."""
    counts = coding_variants(credible_sets, min_pip).groupBy("gene_most_severe").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > more_than).orderBy(F.col("n").desc(), "gene_most_severe")


def strong_colocalizations(colocalization: DataFrame, min_h4: float = 0.9) -> DataFrame:
    return colocalization.filter(F.col("PP_H4_abf") > min_h4)


def colocalizations_of(colocalization: DataFrame, trait: str) -> DataFrame:
    """Colocalizations with the trait on either side; an unknown second trait is no match."""
    return colocalization.filter((F.col("trait1") == trait) | F.col("trait2").eqNullSafe(trait))


def variants_in_list(df: DataFrame, variants: list[str]) -> DataFrame:
    """Rows of some variants, given as chromosome:position:ref:alt with X, Y and M as text or code.

    Rows are compared by their site, so an id is found however the ``variant`` column spells it. Chromosomes
    and positions reach the scan: the first prune partitions, the second go against file statistics.
    """
    sites = [_site(v) for v in variants]
    codes = [":".join(map(str, site)) for site in sites]
    listed = F.concat_ws(":", "chr", "pos", "ref", "alt").isin(codes)
    return df.filter(F.col("chr").isin(sorted({s[0] for s in sites})) & F.col("pos").isin(sorted({s[1] for s in sites})) & listed)


def _site(variant: str) -> tuple[int, int, str, str]:
    parts = variant.split(":")
    if len(parts) != 4 or not parts[1].isdecimal():
        raise ValueError(f"not a variant id: {variant!r}")
    chrom = parts[0].removeprefix("chr")
    code = clean.NAMED_CHROMOSOMES.get(chrom.upper(), int(chrom) if chrom.isdecimal() else None)
    if code is None:
        raise ValueError(f"not a chromosome: {variant!r}")
    return code, int(parts[1]), parts[2], parts[3]


def in_region(df: DataFrame, chrom: int, start: int, end: int, first: str, last: str | None = None) -> DataFrame:
    """Rows that touch the 1-based region ``start`` to ``end``, both included.

    ``first`` and ``last`` are 1-based columns of an interval, or ``first`` alone is a position. All
    parts reach the scan: the chromosome as a partition, the bounds as parquet statistics.
    """
    return df.filter((F.col("chr") == chrom) & (F.col(first) <= end) & (F.col(last or first) >= start))


def peaks_in_region(peaks: DataFrame, chrom: int, start: int, end: int) -> DataFrame:
    """Peaks that touch the region; their start is 0-based, so it must lie before ``end``."""
    return peaks.filter((F.col("chr") == chrom) & (F.col("peak_start") < end) & (F.col("peak_end") >= start))


def exome_of_gene(exome: DataFrame, gene: str) -> DataFrame:
    return exome.filter(F.col("gene") == gene).select(
        "chr", "pos", "ref", "alt", "annotation", "trait", "mlog10p", "beta"
    )


def significant_burden(burden: DataFrame, min_mlog10p: float = 5.0) -> DataFrame:
    return burden.filter(F.col("mlog10p_burden") > min_mlog10p).select(
        "gene", "trait", "annotation", "mlog10p_burden", "beta"
    )


def genes_in_group(genes: DataFrame, group_id: int) -> DataFrame:
    """Genes whose group or any ancestor group is ``group_id``."""
    return genes.filter(clean.in_array("gene_group_ids", group_id)).select("symbol", "chr", "gene_start", "gene_end")


def genes_outside_group(genes: DataFrame, group_name: str) -> DataFrame:
    return genes.filter(~clean.in_array("gene_group_names", group_name))


def traits_matching(df: DataFrame, text: str) -> DataFrame:
    """Trait codes whose code or original name holds ``text``, in any case."""
    wanted = text.lower()
    hit = F.lower("trait").contains(wanted) | F.lower("trait_original").contains(wanted)
    return df.filter(hit).select("trait", "trait_original").distinct()


def lead_variants(credible_sets: DataFrame, keys: tuple[str, ...] = ("dataset", "cs_id")) -> DataFrame:
    """The most likely causal variant of each credible set.

    Ties go to the stronger p-value, then to the first site. Spark limits each group to one row
    before the shuffle, so a set with very many rows costs no task more than its input.
    """
    best = Window.partitionBy(*keys).orderBy(
        F.col("pip").desc_nulls_last(), F.col("mlog10p").desc_nulls_last(), "chr", "pos", "ref", "alt"
    )
    return credible_sets.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def reliable_hla(hla: DataFrame, min_mlogp: float = HLA_SIGNIFICANT, min_info: float = HLA_MIN_INFO) -> DataFrame:
    """Well imputed, significant HLA results; ``pval`` reaches 0, so it is never used."""
    return hla.filter((F.col("mlogp") > min_mlogp) & (F.col("info") >= min_info))


def phenotypes_of_allele(hla: DataFrame, allele: str, **limits) -> DataFrame:
    return reliable_hla(hla, **limits).filter(F.col("allele") == allele).orderBy(F.col("mlogp").desc(), "phenotype")


def alleles_of_phenotype(hla: DataFrame, phenotype: str, **limits) -> DataFrame:
    return reliable_hla(hla, **limits).filter(F.col("phenotype") == phenotype).orderBy(F.col("mlogp").desc(), "allele")


def reporter_effects(mpra: DataFrame, cell_line: str) -> DataFrame:
    """Reporter rows of one context; rows across lines and per line are not comparable."""
    return mpra.filter(F.col("cell_line") == cell_line)


def filter_by_resource(df: DataFrame, rules: list[Rule], wanted: str) -> DataFrame:
    """Rows of one resource.

    The rules are applied to the distinct data set names, and the rows are kept by a semi join on
    ``dataset``. Nothing runs before the query does; where the names turn out to be few, Spark broadcasts
    them or filters the scan by them at run time.
    """
    names = df.select("dataset").distinct().filter(resource_expr(rules, "dataset") == wanted)
    return df.join(names, "dataset", "left_semi").select(*df.columns)
