"""The gene table: one row per gene, with coordinates and the full group lineage."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.functions import clean
from assocspark.sources.text import read_strings


def in_file_order(df: DataFrame) -> DataFrame:
    """Tag rows of a file scan with their order. Rows have none after a shuffle."""
    order = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return df.withColumn("_order", order)


def _last(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the last one in file order where the frame is tagged."""
    order = F.col("_order") if "_order" in df.columns else F.monotonically_increasing_id()
    values = [c for c in df.columns if c not in (key, "_order")]
    # The tag is set before the shuffle; max_by then reduces each input partition first.
    tagged = df.withColumn("_order", order)
    kept = tagged.groupBy(key).agg(F.max_by(F.struct(*values), "_order").alias("_row"))
    return kept.select(key, "_row.*")


def gene_coordinates(gencode: DataFrame) -> DataFrame:
    """Coordinates per unversioned gene id. Ids that differ in version only collapse to the last."""
    tags = ["_order"] if "_order" in gencode.columns else []
    placed = gencode.select(
        F.nullif(clean.strip_version("gene_id"), F.lit("")).alias("ensembl_key"),
        clean.chromosome_code_strict("chrom").alias("chr"),
        clean.to_integer("gene_start").alias("gene_start"),
        clean.to_integer("gene_end").alias("gene_end"),
        F.col("gene_strand").alias("strand"),
        *tags,
    )
    return _last(placed.filter(F.col("ensembl_key").isNotNull()), "ensembl_key")


def add_coordinates(genes: DataFrame, gencode: DataFrame) -> DataFrame:
    """Left join of coordinates by unversioned gene id; a gene without any keeps NULLs."""
    keyed = genes.withColumn("ensembl_gene_id", clean.strip_version("ensembl_gene_id"))
    coordinates = gene_coordinates(gencode)
    return keyed.join(coordinates, F.col("ensembl_gene_id") == F.col("ensembl_key"), "left").drop("ensembl_key")


def family_ancestors(closure: DataFrame) -> DataFrame:
    """Distinct (child, ancestor) pairs of the transitive closure, without self pairs."""
    pairs = closure.select(
        clean.to_integer("child_fam_id").alias("child"), clean.to_integer("parent_fam_id").alias("ancestor")
    )
    return pairs.filter(F.col("child") != F.col("ancestor")).distinct()


def _own_families(gene_has_family: DataFrame) -> DataFrame:
    pairs = gene_has_family.select(
        clean.canonical_gene_id("hgnc_id").alias("gene_key"), clean.to_integer("family_id").alias("family_id")
    )
    return pairs.filter(F.col("gene_key").isNotNull() & F.col("family_id").isNotNull())


def gene_families(gene_has_family: DataFrame) -> DataFrame:
    """Distinct (gene key, own family) pairs. Keys are canonical: the files spell ids differently."""
    return _own_families(gene_has_family).distinct()


def family_names(family: DataFrame) -> DataFrame:
    """Name per family id, the last one where an id repeats; a known id may have no name."""
    tags = ["_order"] if "_order" in family.columns else []
    named = family.select(clean.to_integer("id").alias("family_id"), F.col("name").alias("family_name"), *tags)
    return _last(named.filter(F.col("family_id").isNotNull()), "family_id")


def lineage_members(gene_has_family: DataFrame, closure: DataFrame, family: DataFrame) -> DataFrame:
    """(gene key, family id, family name) for a gene's families and all their ancestors, with repeats."""
    own = _own_families(gene_has_family)
    inherited = own.join(family_ancestors(closure), F.col("family_id") == F.col("child")).select(
        "gene_key", F.col("ancestor").alias("family_id")
    )
    return own.union(inherited).join(family_names(family), "family_id").select("gene_key", "family_id", "family_name")


def gene_lineage(gene_has_family: DataFrame, closure: DataFrame, family: DataFrame) -> DataFrame:
    """Aligned id and name arrays per gene, ascending by id. Ids without a family row are dropped.

    Repeats are dropped while collecting, before the shuffle, so an array never holds more than
    one entry per existing family.
    """
    entry = F.struct("family_id", "family_name")
    members = lineage_members(gene_has_family, closure, family)
    groups = members.groupBy("gene_key").agg(F.sort_array(F.collect_set(entry)).alias("_groups"))
    return groups.select(
        "gene_key",
        F.col("_groups.family_id").alias("gene_group_ids"),
        F.col("_groups.family_name").alias("gene_group_names"),
    )


def _or_empty(array: str, kind: str) -> Column:
    return F.coalesce(F.col(array), F.array().cast(kind)).alias(array)


def build_genes(
    hgnc: DataFrame,
    gencode: DataFrame,
    gene_has_family: DataFrame,
    closure: DataFrame,
    family: DataFrame,
    *,
    gencode_version: str,
    hgnc_version: str,
    download_date: str,
) -> DataFrame:
    """One row per gene with a symbol, in the layout of ``gene_annotations``.

    All inputs hold text columns as read. Only the join key is made canonical; ``hgnc_id`` is
    stored as it was read.
    """
    named = hgnc.filter(F.nullif("symbol", F.lit("")).isNotNull())
    for optional in ("prev_symbol", "alias_symbol", "entrez_id"):
        if optional not in named.columns:
            named = named.withColumn(optional, F.lit(None).cast("string"))
    lineage = gene_lineage(gene_has_family, closure, family)
    placed = add_coordinates(named, gencode).withColumn("_key", clean.canonical_gene_id("hgnc_id"))
    joined = placed.join(lineage, F.col("_key") == F.col("gene_key"), "left")
    return joined.select(
        "hgnc_id",
        "symbol",
        "name",
        clean.clean_pipe("prev_symbol").alias("prev_symbols"),
        clean.clean_pipe("alias_symbol").alias("alias_symbols"),
        "ensembl_gene_id",
        F.col("entrez_id").alias("ncbi_gene_id"),
        "chr",
        "gene_start",
        "gene_end",
        "strand",
        "locus_type",
        _or_empty("gene_group_ids", "array<bigint>"),
        _or_empty("gene_group_names", "array<string>"),
        F.lit(gencode_version).alias("gencode_version"),
        F.lit(hgnc_version).alias("hgnc_version"),
        F.lit(download_date).cast("date").alias("download_date"),
    )


def build_from_files(
    spark: SparkSession,
    hgnc: str,
    gencode: str,
    gene_has_family: str,
    closure: str,
    family: str,
    *,
    hgnc_version: str,
    gencode_version: str = "49",
    download_date: str | None = None,
) -> DataFrame:
    """The gene table from its source files: two TSV files, then three CSV files."""
    tsv = [read_strings(spark, path, "\t") for path in (hgnc, gencode)]
    csv = [read_strings(spark, path, ",") for path in (gene_has_family, closure, family)]
    return build_genes(
        tsv[0],
        in_file_order(tsv[1]),
        csv[0],
        csv[1],
        in_file_order(csv[2]),
        gencode_version=gencode_version,
        hgnc_version=hgnc_version,
        download_date=download_date or datetime.date.today().isoformat(),
    )


def lineage_present(genes: DataFrame) -> DataFrame:
    """Check after a rebuild: how many genes have groups, and whether any has."""
    grouped = F.count_if(F.size("gene_group_ids") > 0)
    return genes.agg(F.count(F.lit(1)).alias("genes"), grouped.alias("with_groups"), (grouped > 0).alias("ok"))
