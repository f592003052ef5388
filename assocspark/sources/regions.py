"""Regions of block-gzip files: a sparse index of which byte ranges hold which positions, and reads of these ranges only.

The index has one row for each byte range of ``granule`` bytes and chromosome in it: the least and the greatest position of the lines that
begin there. It is made once, in parallel, and is tiny beside the files. Where files are sorted by position a region is in few
ranges; unsorted files are read in larger part, but give the same rows. Chromosomes are indexed as they are spelled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.functions import clean
from assocspark.sources import bgzf

GRANULE = 1 << 20
_KEYS = ["path", "length", "start", "end"]


def write_index(
    spark: SparkSession,
    paths: str | list[str],
    index_path: str,
    chrom_field: int,
    pos_field: int,
    skip_leading_rows: int = 1,
    granule: int = GRANULE,
    opened: Callable = bgzf.opened,
) -> None:
    """Index files by the tab-separated fields of these numbers, from 0, that hold chromosome and position."""
    lines = bgzf.range_lines(spark, paths, skip_leading_rows, granule, opened, max(bgzf.SPLIT_BYTES // granule, 1))
    placed = lines.select(
        *_KEYS, F.split_part("value", F.lit("\t"), F.lit(chrom_field + 1)).alias("chrom"),
        F.expr(f"try_cast(split_part(value, '\t', {pos_field + 1}) AS bigint)").alias("pos"),
    )
    found = placed.groupBy(*_KEYS, "chrom").agg(F.min("pos").alias("least"), F.max("pos").alias("greatest"))
    found.filter("least IS NOT NULL").write.mode("overwrite").parquet(index_path)


def ranges_of(spark: SparkSession, index_path: str, chrom: int, first: int, last: int) -> DataFrame:
    """The byte ranges that may hold positions ``first`` to ``last`` of a chromosome, given by its code."""
    index = spark.read.parquet(index_path)
    near = index.filter((F.col("greatest") >= first) & (F.col("least") <= last) & (clean.chromosome_code("chrom") == chrom))
    return near.select(*_KEYS).distinct()


def region_lines(
    spark: SparkSession, index_path: str, chrom: int, first: int, last: int, skip_leading_rows: int = 1, opened: Callable = bgzf.opened
) -> DataFrame:
    """Lines of the ranges that may hold the region, as a ``value`` column; filter them by position once parsed."""
    near = ranges_of(spark, index_path, chrom, first, last)
    return bgzf.lines_of(near, skip_leading_rows, opened).select("value")
