"""Readers for delimited text and line-wise JSON."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocspark.functions import clean
from assocspark.schemas import CHROM_TEXT_TABLES, JSON_TABLES, PREFIXED_CELL_TYPE_TABLES, table as registered
from assocspark.sources import regions
from assocspark.sources.bgzf import read_bgzf_lines
from assocspark.sources.quoted import CODECS, SPLIT_BYTES, read_records

# A text no field holds: with it Spark's own NULL mapping stays out of the way, so an empty
# STRING field stays empty and only the marker becomes NULL.
_NO_NULL_TEXT = "\u0001"
_CSV = {"sep": "\t", "escape": '"', "mode": "FAILFAST", "nullValue": _NO_NULL_TEXT}


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _drop_leading(rows: int):
    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            order = batch.groupby("_file").cumcount() + batch["_file"].map(seen).fillna(0)
            for name, count in batch["_file"].value_counts().items():
                seen[name] = seen.get(name, 0) + int(count)
            yield batch[order >= rows].drop(columns="_file")

    return drop


def _by_codec(spark: SparkSession, paths: str | list[str]) -> tuple[list[str], list[str]]:
    """The files that a codec keeps whole, and those that can be cut. Only names are read."""
    paths = [paths] if isinstance(paths, str) else paths
    names = [unquote(n) for n in spark.read.format("binaryFile").load(paths).inputFiles()]
    return [n for n in names if n.endswith(CODECS)], [n for n in names if not n.endswith(CODECS)]


def _parsed(records: DataFrame, text: T.StructType, options: dict[str, str]) -> DataFrame:
    ddl = ", ".join(f"`{name}` string" for name in text.names)
    return records.select(F.from_csv("value", ddl, options).alias("fields")).select("fields.*")


def read_fields(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    skip_leading_rows: int = 1,
    quoted_newlines: bool = False,
    block_gzip: bool = False,
    split_bytes: int = SPLIT_BYTES,
    whole_files: bool = False,
) -> DataFrame:
    """Every field as text, by position. Short or long rows fail the job.

    Spark splits plain files; gzip files are one task each. Block-gzip files are split at their blocks. ``quoted_newlines`` allows line
    ends inside quoted fields; plain and block-gzip files are still read in parallel then, at the price of a pass that counts quotes.
    """
    text, options = _text_schema(schema), _CSV
    if quoted_newlines and not block_gzip:
        whole, cut = _by_codec(spark, paths)
        if cut:
            records = read_records(spark, cut, skip_leading_rows, split_bytes=split_bytes)
            rest = [read_fields(spark, whole, schema, skip_leading_rows, whole_files=True)] if whole else []
            return reduce(DataFrame.unionByName, [_parsed(records, text, options), *rest])
    if block_gzip:
        reader = read_records if quoted_newlines else read_bgzf_lines
        extra = {"block_gzip": True} if quoted_newlines else {}
        return _parsed(reader(spark, paths, skip_leading_rows, split_bytes=split_bytes, **extra), text, options)
    reader = spark.read.schema(text).options(
        **options, multiLine=quoted_newlines or whole_files, header=skip_leading_rows == 1, enforceSchema=True
    )
    if skip_leading_rows <= 1:
        return reader.csv(paths)
    # More than one header row: needs each file in one task, which multiLine ensures.
    whole = reader.option("multiLine", True).csv(paths).withColumn("_file", F.col("_metadata.file_path"))
    return whole.mapInPandas(_drop_leading(skip_leading_rows), text)


def load_frame(
    spark: SparkSession,
    table: str,
    paths: str | list[str],
    const_columns: Mapping[str, str] | None = None,
    skip_leading_rows: int = 1,
    **read_options,
) -> DataFrame:
    """Files of a registered table as typed, cleaned rows in registry order.

    Files may lack the columns in ``const_columns``; those are filled with the given constants.
    Chromosome text becomes a code and prefixed cell types are stripped where the table needs
    it. A required column that is NULL fails the job.
    """
    spec = registered(table)
    const_columns = dict(const_columns or {})
    unknown = sorted(set(const_columns) - set(spec.columns))
    if unknown:
        raise ValueError(f"constant columns not in table {table!r}: {unknown}")
    if table in JSON_TABLES:
        if const_columns:
            raise ValueError(f"constant columns are not supported for the JSON table {table!r}")
        return enforce_required(read_ndjson(spark, table, paths), table)

    return _typed(read_fields(spark, paths, _in_file(table, const_columns), skip_leading_rows, **read_options), table, const_columns)


def _in_file(table: str, const_columns: Mapping[str, str]) -> T.StructType:
    return T.StructType([f for f in registered(table).schema if f.name not in const_columns])


def _typed(raw: DataFrame, table: str, const_columns: Mapping[str, str]) -> DataFrame:
    spec = registered(table)

    def value(field: T.StructField):
        if field.name in const_columns:
            column = clean.constant(const_columns[field.name], field.dataType)
        elif field.name == "chr" and table in CHROM_TEXT_TABLES:
            column = clean.chromosome_code(clean.file_value("chr", T.StringType()))
        elif field.name == "cell_type" and table in PREFIXED_CELL_TYPE_TABLES:
            column = clean.strip_cell_type(clean.file_value("cell_type", T.StringType()))
        else:
            column = clean.file_value(field.name, field.dataType)
        return column.alias(field.name, metadata=field.metadata)

    return enforce_required(raw.select(*[value(f) for f in spec.schema]), table)


def index_regions(spark: SparkSession, table: str, paths: str | list[str], index_path: str, const_columns: Iterable[str] = (), **options) -> None:
    """Index block-gzip files of a table for ``load_region``. Files may lack the columns in ``const_columns``."""
    names = _in_file(table, dict.fromkeys(const_columns, "")).names
    regions.write_index(spark, paths, index_path, names.index("chr"), names.index("pos"), **options)


def load_region(
    spark: SparkSession, table: str, index_path: str, chrom: int, first: int, last: int, const_columns: Mapping[str, str] | None = None, **options
) -> DataFrame:
    """The rows of indexed files with ``pos`` in a region, both ends included, typed as ``load_frame`` gives them.

    Only the byte ranges that may hold the region are read.
    """
    const_columns = dict(const_columns or {})
    lines = regions.region_lines(spark, index_path, chrom, first, last, **options)
    rows = _typed(_parsed(lines, _text_schema(_in_file(table, const_columns)), _CSV), table, const_columns)
    return rows.filter((F.col("chr") == chrom) & F.col("pos").between(first, last))


def load_group(
    spark: SparkSession, table: str, files: Iterable[str | tuple[str, Mapping[str, str]]], **options
) -> DataFrame:
    """Several loads as one frame: paths, or (path, constants) pairs, one per source."""
    frames = [
        load_frame(spark, table, f, **options) if isinstance(f, str) else load_frame(spark, table, f[0], f[1], **options)
        for f in files
    ]
    return reduce(DataFrame.unionByName, frames)


def enforce_required(df: DataFrame, table: str) -> DataFrame:
    """Fail the job on a NULL in a required column."""
    spec = registered(table)

    def checked(field: T.StructField):
        column = F.col(field.name)
        if not field.nullable and field.name in df.columns:
            message = F.raise_error(F.lit(f"{table}.{field.name} is required but NULL"))
            column = F.coalesce(column, message.cast(field.dataType))
        return column.alias(field.name, metadata=field.metadata)

    return df.select(*[checked(spec.schema[c]) if c in spec.columns else F.col(c) for c in df.columns])


def read_ndjson(spark: SparkSession, table: str, paths: str | list[str]) -> DataFrame:
    """One JSON object per line, columns by name; a missing array is empty, not NULL."""
    schema = registered(table).schema
    # Required columns are checked later; a non-nullable read schema would hide their NULLs.
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    df = spark.read.schema(loose).option("mode", "FAILFAST").json(paths)
    return df.select(
        *[
            F.coalesce(F.col(f.name), F.array().cast(f.dataType)).alias(f.name, metadata=f.metadata)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f.name).alias(f.name, metadata=f.metadata)
            for f in schema
        ]
    )


def read_strings(spark: SparkSession, paths: str | list[str], sep: str = "\t") -> DataFrame:
    """Delimited text with a header, every column a string by name, empty fields NULL."""
    return (
        spark.read.options(sep=sep, header=True, inferSchema=False, nullValue="", escape='"', multiLine=True)
        .csv(paths)
    )


def write_ndjson(df: DataFrame, path: str) -> None:
    """One JSON object per row; NULL keys are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
