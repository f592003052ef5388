"""One view per table: all stored columns, then the derived ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assocspark.functions import clean
from assocspark.functions.resources import CONSTANT_RESOURCES, resource
from assocspark.schemas import TABLES

# Derived columns of each view, in view order.
DERIVED = {
    "credible_sets": ("variant", "maf", "resource"),
    "colocalization": ("resource1", "resource2"),
    "coloc_credsets": ("variant", "resource"),
    "exome_variant_results": ("variant", "resource"),
    "gene_burden_results": ("resource",),
    "asm_qtl": ("variant", "maf", "resource"),
    "gene_annotations": ("resource",),
    "open_chromatin": ("resource",),
    "variant_effect": ("resource",),
    "mpra": ("resource",),
    "variant_annotation": ("resource",),
    "peak_to_gene": ("resource",),
    "hla_associations": ("resource",),
}

# The column with the allele frequency that ``maf`` is derived from.
FREQUENCY = {"credible_sets": "aaf", "asm_qtl": "af"}


def derived_names(table: str) -> list[str]:
    return list(DERIVED[table])


def derived_from(table: str) -> dict[str, list[str]]:
    """Stored columns behind each derived column; it is NULL exactly where one of them is."""
    sources = {}
    for name in DERIVED[table]:
        if name == "variant":
            sources[name] = ["chr", "pos", "ref", "alt"]
        elif name == "maf":
            sources[name] = [FREQUENCY[table]]
        else:
            sources[name] = [] if table in CONSTANT_RESOURCES else [name.replace("resource", "dataset")]
    return sources


def derive(table: str, df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Add derived columns, all or the named ones."""
    sources = derived_from(table)

    def column(name: str):
        if name == "variant":
            return clean.variant_id().alias(name)
        if name == "maf":
            return clean.minor_allele_frequency(*sources[name]).alias(name)
        return resource(table, *sources[name]).alias(name)

    return df.select("*", *[column(n) for n in sources if names is None or n in names])


def view(table: str, df: DataFrame) -> DataFrame:
    """The view of a table; unused derived columns cost nothing, Catalyst prunes them."""
    return derive(table, df)


def base_name(name: str) -> str:
    """Table behind a base or a view name."""
    base = name.removesuffix("_v")
    if base not in TABLES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(f'{t}_v' for t in TABLES)}")
    return base


def register(spark: SparkSession, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Register the view of each table under its base and its view name."""
    views = {}
    for table, df in frames.items():
        views[table] = view(base_name(table), df)
        for name in (table, f"{table}_v"):
            views[table].createOrReplaceTempView(name)
    return views
