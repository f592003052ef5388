"""Mergeable summaries of rows: distinct combinations with counts, and sketches of distinct values.

Merging the summaries of two sets of rows gives the summary of both, so a table that grows by loads is summarised load by load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2 ** LG_K registers a sketch, 4 KB; the relative standard error of an estimate is about 1.04 / sqrt(2 ** LG_K), 1.6 %.
LG_K = 12


def combinations(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct combinations of categorical columns, with ``n_rows``; reduced in each task before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


def merged_combinations(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*[c for c in parts.columns if c != "n_rows"]).agg(F.sum("n_rows").alias("n_rows"))


def value_counts(state: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, value, n_rows of the values of each column, from combinations."""
    text = state.select("n_rows", *[F.col(c).cast("string").alias(c) for c in columns])
    each = text.unpivot(["n_rows"], columns, "column_name", "value").filter(F.col("value").isNotNull())
    return each.groupBy("column_name", "value").agg(F.sum("n_rows").alias("n_rows"))


def _sketch(column: Column) -> Column:
    return F.hll_sketch_agg(column, F.lit(LG_K))


def sketches(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, n_rows, n_null and a sketch of the distinct values of each column, from one pass.

    A sketch has a fixed size, however many values there are; values are compared as text.
    """
    parts = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        parts += [F.count(F.col(c)).alias(f"n{i}"), _sketch(F.col(c).cast("string")).alias(f"s{i}")]
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"n{i}")).alias("n_null"), F.col(f"s{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    return df.agg(*parts).select(F.inline(F.array(*entries)))


def merged_sketches(parts: DataFrame) -> DataFrame:
    """column_name, n_rows, n_null, n_distinct; the estimate is the same as that of one sketch of all rows."""
    merged = parts.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_union_agg("sketch").alias("sketch")
    )
    return merged.select("column_name", "n_rows", "n_null", F.hll_sketch_estimate("sketch").alias("n_distinct"))


def distinct_estimates(df: DataFrame, columns: list[str]) -> DataFrame:
    return merged_sketches(sketches(df, columns))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name and the exact number of distinct values: a shuffle of all of them, so for checks and few values."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot([], columns, "column_name", "value").groupBy("column_name").agg(F.count_distinct("value").alias("n_exact"))
