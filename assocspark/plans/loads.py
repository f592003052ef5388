"""Readers and writers: each query writes a stand-in in the file format and reads it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.plans.bgz_files import write_bgzf
from assocspark.operators import genes, profile, results
from assocspark.plans.registry import Inputs, query
from assocspark.schemas import TABLES
from assocspark.sources import tables, text

HLA_FILE = [c for c in TABLES["hla_associations"].columns if c != "dataset"]


def as_text(df: DataFrame) -> DataFrame:
    """All columns as file text, NULL as NA."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in df.columns])


def write_tsv(df: DataFrame, path: str, by: str | None = None) -> str:
    """Gzip TSV files with a header, NULL as NA and empty text kept."""
    shown = as_text(df)
    if by:
        shown = shown.withColumn("_by", F.col(by))
    writer = shown.write.options(sep="\t", header=True, compression="gzip", emptyValue="", escape='"')
    (writer.partitionBy("_by") if by else writer).csv(path)
    return path


def _hla_file(t: Inputs) -> DataFrame:
    """The file of a table whose data set is injected and whose chromosome is text."""
    return t("hla_associations").withColumn("chr", F.concat(F.lit("chr"), "chr")).select(*HLA_FILE)


@query("scan_tsv", "coloc_credsets", "SELECT * FROM coloc_credsets")
def scan_tsv(t: Inputs):
    path = write_tsv(t("coloc_credsets"), f"{t.scratch()}/coloc_credsets")
    return text.load_frame(t.spark, "coloc_credsets", path)


@query(
    "scan_quoted",
    "coloc_credsets",
    """SELECT * REPLACE ('a "' || trait_original || '"' || chr(10) || trait AS trait_original) FROM coloc_credsets""",
)
def scan_quoted(t: Inputs):
    """Plain text files whose quoted fields hold quotes and line ends."""
    path, rows = f"{t.scratch()}/coloc_credsets", t("coloc_credsets")
    odd = F.concat(F.lit('a "'), "trait_original", F.lit('"\n'), "trait")
    shown = as_text(rows.withColumn("trait_original", odd))
    shown.write.options(sep="\t", header=True, emptyValue="", escape='"').csv(path)
    return text.load_frame(t.spark, "coloc_credsets", path, quoted_newlines=True, split_bytes=1 << 20)


@query("scan_glob", "gene_burden_results", "SELECT * FROM gene_burden_results")
def scan_glob(t: Inputs):
    base = write_tsv(t("gene_burden_results"), f"{t.scratch()}/per_trait", by="trait")
    return text.load_frame(t.spark, "gene_burden_results", f"{base}/*/*.csv.gz")


@query(
    "scan_ndjson",
    "gene_annotations",
    "SELECT symbol, chr, gene_group_ids, gene_group_names, download_date FROM gene_annotations",
)
def scan_ndjson(t: Inputs):
    path = f"{t.scratch()}/genes"
    text.write_ndjson(t("gene_annotations"), path)
    loaded = text.load_frame(t.spark, "gene_annotations", path)
    return results.stringify(loaded.select("symbol", "chr", "gene_group_ids", "gene_group_names", "download_date"))


@query("write_ndjson", "gene_annotations", "SELECT count(*) AS n_lines, count_if(chr IS NULL) AS n_null_chr FROM gene_annotations")
def write_ndjson(t: Inputs):
    path = f"{t.scratch()}/genes"
    text.write_ndjson(t("gene_annotations"), path)
    lines = t.spark.read.text(path)
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("value").contains('"chr":null')).alias("n_null_chr")
    )


@query("scan_strings", "family hgnc", "SELECT hgnc_id, symbol, name, alias_symbol FROM hgnc")
def scan_strings(t: Inputs):
    path = f"{t.scratch()}/hgnc"
    named = t("hgnc").select("hgnc_id", "symbol", "name", "alias_symbol")
    named.write.options(sep=",", header=True, escape='"').csv(path)
    return text.read_strings(t.spark, path, ",")


@query("gene_build_files", "gene_annotations", "SELECT * FROM gene_annotations")
def gene_build_files(t: Inputs):
    """The gene build from its five files."""
    base, paths = t.scratch(), {}
    files = {"hgnc": "\t", "gencode": "\t", "gene_has_family": ",", "hierarchy_closure": ",", "family": ","}
    for name, sep in files.items():
        paths[name] = f"{base}/{name}"
        t(name).write.options(sep=sep, header=True, escape='"').csv(paths[name])
    built = genes.build_from_files(
        t.spark, *paths.values(), gencode_version="44", hgnc_version="2024-01-15", download_date="2024-02-20"
    )
    return results.stringify(built)


@query("scan_bgz", "coloc_credsets", "SELECT * FROM coloc_credsets")
def scan_bgz(t: Inputs):
    path = f"{t.scratch()}/coloc_credsets"
    write_bgzf(as_text(t("coloc_credsets")), path)
    return text.load_frame(t.spark, "coloc_credsets", f"{path}/*.bgz", block_gzip=True)


@query("bgz_region", "coloc_credsets", "SELECT * FROM coloc_credsets WHERE chr = 3 AND pos BETWEEN 5000 AND 25000")
def bgz_region(t: Inputs):
    """A region of sorted block-gzip files by their index; the number of files grows with the rows."""
    base, rows = t.scratch(), t("coloc_credsets")
    ordered = rows.repartitionByRange(tables.bucket_count(rows.count(), 8), "chr", "pos").sortWithinPartitions("chr", "pos")
    write_bgzf(as_text(ordered), f"{base}/files")
    text.index_regions(t.spark, "coloc_credsets", f"{base}/files/*.bgz", f"{base}/index", granule=64 << 10)
    return text.load_region(t.spark, "coloc_credsets", f"{base}/index", 3, 5_000, 25_000)


@query(
    "const_column_load",
    "hla_associations",
    "SELECT * FROM hla_associations",
)
def const_column_load(t: Inputs):
    path = write_tsv(_hla_file(t), f"{t.scratch()}/hla")
    return text.load_frame(t.spark, "hla_associations", path, {"dataset": tables.FILE_DATASETS["hla_associations"]})


@query(
    "group_load",
    "hla_associations",
    """SELECT gene, allele, phenotype, mlogp, 'first' AS dataset FROM hla_associations WHERE gene = 'HLA-A'
UNION ALL SELECT gene, allele, phenotype, mlogp, 'rest' FROM hla_associations WHERE gene <> 'HLA-A'""",
)
def group_load(t: Inputs):
    file, base = _hla_file(t), t.scratch()
    first = write_tsv(file.filter("gene = 'HLA-A'"), f"{base}/first")
    rest = write_tsv(file.filter("gene <> 'HLA-A'"), f"{base}/rest")
    loaded = text.load_group(
        t.spark, "hla_associations", [(first, {"dataset": "first"}), (rest, {"dataset": "rest"})]
    )
    tables.write_table(loaded, "hla_associations", f"{base}/table", sampled=False)
    return tables.read_table(
        t.spark, "hla_associations", f"{base}/table", ["gene", "allele", "phenotype", "mlogp", "dataset"]
    )


@query(
    "write_modes",
    "gene_burden_results",
    """SELECT dataset, count(*) * 2 AS n FROM gene_burden_results WHERE dataset = 'genebass' GROUP BY dataset
UNION ALL SELECT dataset, count(*) FROM gene_burden_results WHERE dataset <> 'genebass' GROUP BY dataset""",
)
def write_modes(t: Inputs):
    path, rows = f"{t.scratch()}/burden", t("gene_burden_results")
    tables.write_table(rows.filter("dataset = 'SCHEMA2'"), "gene_burden_results", path, "WRITE_EMPTY")
    tables.write_table(rows, "gene_burden_results", path, "WRITE_TRUNCATE")
    tables.write_table(rows.filter("dataset = 'genebass'"), "gene_burden_results", path, "WRITE_APPEND")
    written = tables.read_table(t.spark, "gene_burden_results", path)
    return written.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query(
    "replace_rows",
    "credible_sets",
    """SELECT dataset, count(*) AS n, sum(cs_size) AS sizes FROM (
  SELECT * FROM credible_sets WHERE dataset NOT LIKE 'QTD%' AND dataset NOT IN ('FinnGen_R14', 'UKB_PPP', 'FinnGen_Olink',
    'FinnGen_ATACseq', 'Open_Targets_26.06', 'PGC_SCZ_2022')
  UNION ALL SELECT * FROM credible_sets WHERE dataset = 'UKB_PPP' AND pip > 5e-1) GROUP BY dataset""",
)
def replace_rows(t: Inputs):
    """Each loader's rows are a partition; a new load replaces its own and reads no other."""
    path, rows = f"{t.scratch()}/credible_sets", t("credible_sets")
    owned = tables.owned_rows(*tables.OWNED_DATASETS["fine_mapped"])
    tables.replace_owned(tables.without_owned(rows, owned), "pseudo", "credible_sets", path)
    tables.replace_owned(rows.filter(owned), "fine_mapped", "credible_sets", path)
    new = rows.filter((F.col("dataset") == "UKB_PPP") & (F.col("pip") > 0.5))
    tables.replace_owned(new, "fine_mapped", "credible_sets", path)
    replaced = tables.read_owned(t.spark, "credible_sets", path)
    return replaced.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("cs_size").alias("sizes"))


@query(
    "truncate_keep_schema",
    "gene_burden_results",
    """SELECT dataset, annotation, count(*) AS n, true AS described FROM gene_burden_results WHERE dataset = 'genebass'
GROUP BY dataset, annotation""",
)
def truncate_keep_schema(t: Inputs):
    base = t.scratch()
    database = "run_" + base.rsplit("-", 1)[-1].replace("/", "_").lower()
    rows = t("gene_burden_results")
    t.spark.sql(f"CREATE DATABASE `{database}` LOCATION '{base}'")
    tables.create_tables(t.spark, database)
    tables.reload_table(rows, database, "gene_burden_results")
    tables.reload_table(rows.filter("dataset = 'genebass'"), database, "gene_burden_results")
    kept = t.spark.table(f"{database}.gene_burden_results")
    made = [t.spark.table(f"{database}.{name}").schema for name in TABLES]
    described = all(f.metadata.get("comment") for schema in made for f in schema)
    return (
        kept.groupBy("dataset", "annotation")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("described", F.lit(described))
    )


@query("partitioned_write", "coloc_credsets", "SELECT * FROM coloc_credsets")
def partitioned_write(t: Inputs):
    path = f"{t.scratch()}/coloc_credsets"
    tables.write_table(t("coloc_credsets"), "coloc_credsets", path)
    return tables.read_table(t.spark, "coloc_credsets", path)


@query(
    "rows_written",
    "gene_burden_results",
    """SELECT 1 AS load, count(*) AS n FROM gene_burden_results
UNION ALL SELECT 2, count(*) FROM gene_burden_results WHERE dataset = 'genebass'""",
)
def rows_written(t: Inputs):
    path, rows = f"{t.scratch()}/burden", t("gene_burden_results")
    first = tables.write_table(rows, "gene_burden_results", path)
    second = tables.write_table(rows.filter("dataset = 'genebass'"), "gene_burden_results", path, "WRITE_APPEND")
    # The counts belong to the loads; the table itself holds both.
    return t.spark.createDataFrame([(1, first), (2, second)], "load int, n bigint")


@query(
    "required_violations",
    " ".join(TABLES),
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, count(*) - count(\"{column}\") AS n_null FROM {name}"
        for name, spec in TABLES.items()
        for column in spec.required
    ),
)
def required_violations(t: Inputs):
    """NULLs in the required columns of all tables."""
    found = [
        profile.required_violations(t(name), spec.required).select(F.lit(name).alias("table_name"), "column_name", "n_null")
        for name, spec in TABLES.items()
    ]
    return reduce(DataFrame.unionByName, found)
