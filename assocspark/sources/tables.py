"""Writers: partitioned tables, write modes, row replacement, catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocspark.schemas import TABLES, table as registered
from assocspark.sources.text import enforce_required

# What is done with the rows of a load, its owner and its id before it is published.
Derive = Callable[[DataFrame, str, str], None]

# What a write does to rows that are already there.
WRITE_MODES = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite", "WRITE_EMPTY": "append"}


# Data sets that each of the two loads of credible sets owns, by name and by pattern.
OWNED_DATASETS = {
    "fine_mapped": (
        ["FinnGen_R14", "FinnGen_kanta", "FinnGen_drugs", "FinnGen_Olink", "FinnGen_Olink_5K", "UKB_PPP",
         "FinnGen_snRNAseq", "FinnGen_ATACseq", "Open_Targets_26.06", "PGC_SCZ_2022"],
        "QTD%",
    ),
    "pseudo": (
        ["FinnGen_R13_UKBB", "FinnGen_R13_UKBB_labs", "FinnGen_R13_MVP_UKBB", "FinnGen_R13_MVP_UKBB_labs",
         "COVID19_HGI", "PGC", "GP2", "IIBDGC"],
        None,
    ),
}

# Data set of the tables whose file does not name it.
FILE_DATASETS = {
    "mpra": "siraj_mpra",
    "hla_associations": "finngen_hla",
    "peak_to_gene": "FinnGen_ATACseq",
}


_PUBLISHED = "_published"  # folder of the versions of an owned table; readers of Parquet skip such names


def _has_rows(spark: SparkSession, table: str, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop_path) or not system.listStatus(hadoop_path):
        return False
    return not read_table(spark, table, path).isEmpty()


def described(df: DataFrame, table: str) -> DataFrame:
    """Registry order, with the registry's comments attached again.

    A column that the registry lacks, or a required one that is missing or NULL, fails the write. Other missing
    columns are NULL.
    """
    spec = registered(table)
    unknown = sorted(set(df.columns) - set(spec.columns))
    missing = sorted(set(spec.required) - set(df.columns))
    if unknown or missing:
        raise ValueError(f"{table}: unknown columns {unknown}, missing required columns {missing}")
    present = [f for f in spec.schema if f.name in df.columns]
    shown = df.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in present])
    return enforce_required(shown, table)


def _order(df: DataFrame, table: str) -> list[str]:
    spec = registered(table)
    order = [spec.partition] if spec.partition else []
    order += list(spec.cluster) + ["pos", "peak_start", "gene_start_pos", "region_start_min", "ref", "alt"]
    return [c for c in dict.fromkeys(order) if c in df.columns]


def _save(df: DataFrame, table: str, path: str, mode: str) -> None:
    partition, writer = registered(table).partition, df.write.mode(mode)
    if partition and partition in df.columns:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def laid_out(df: DataFrame, table: str, partitions: int | None = None, sampled: bool = False) -> DataFrame:
    """Partition by chromosome and cluster columns, sort inside partitions.

    By default rows go by hash of chromosome and first cluster column, and adaptive execution cuts
    partitions that come out large and merges small ones, so files have a useful size however large the
    load is, and the input is read once.

    ``sampled=True`` range-partitions by chromosome, cluster columns and position instead: files then
    cover narrow ranges of the cluster columns, so their statistics prune more. Finding the ranges takes a pass
    over the input of its own, and nothing cuts large ranges, so give ``partitions`` such that each holds
    some hundred megabytes. The input partition number comes last in the order and cuts runs of equal rows.
    """
    order = _order(df, table)
    if not sampled:
        return df.hint("rebalance", *order[:2]).sortWithinPartitions(*order)
    cut = [*order, "_split"] if partitions is None else [partitions, *order, "_split"]
    tagged = df.withColumn("_split", F.spark_partition_id())
    return tagged.repartitionByRange(*cut).drop("_split").sortWithinPartitions(*order)


def write_table(
    df: DataFrame,
    table: str,
    path: str,
    write_mode: str = "WRITE_TRUNCATE",
    partitions: int | None = None,
    sampled: bool = False,
) -> int:
    """Write rows of a registered table and return how many this write added.

    The count is observed above the last shuffle, so it holds rows of this write only and is
    not inflated by the sampling pass of the range partitioning.
    """
    if write_mode not in WRITE_MODES:
        raise ValueError(f"write mode {write_mode!r} is not one of {', '.join(WRITE_MODES)}")
    if write_mode == "WRITE_EMPTY" and _has_rows(df.sparkSession, table, path):
        raise ValueError(f"{path} already holds rows")
    counted = Observation()
    out = laid_out(described(df, table), table, partitions, sampled).observe(counted, F.count(F.lit(1)).alias("rows"))
    _save(out, table, path, WRITE_MODES[write_mode])
    return counted.get["rows"]


def read_table(spark: SparkSession, table: str, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read a written table back in registry order and types; ``chr`` stays a partition column."""
    schema = registered(table).schema
    kept = [f for f in schema if columns is None or f.name in columns]
    return spark.read.schema(T.StructType(kept)).parquet(path).select(*[f.name for f in kept])


def owned_rows(datasets: list[str], like: str | None = None, column: str = "dataset") -> Column:
    """Rows a loader owns: data sets by exact name, or by a case-sensitive LIKE pattern."""
    owned = F.col(column).isin(datasets)
    return owned | F.col(column).like(like) if like else owned


def without_owned(old: DataFrame, owned: Column) -> DataFrame:
    """Rows a delete would leave: those where the predicate is not true."""
    return old.filter(~F.coalesce(owned, F.lit(False)))


def kept_rows(old: DataFrame, owned: Column, table: str) -> DataFrame:
    """The rows that stay, each task's share sorted again: files are laid out already, so no shuffle."""
    kept = described(without_owned(old, owned), table)
    return kept.sortWithinPartitions(*_order(kept, table))


def replace_rows(old: DataFrame, owned: Column, new: DataFrame, table: str, path: str) -> int:
    """Write ``old`` without the owned rows, then ``new``, to a new path; returns the new rows.

    Parquet has no delete, and a path cannot be overwritten while it is read; readers switch to
    the new path when both writes are complete (``ALTER TABLE ... SET LOCATION`` for a catalog
    table). Only the new rows are shuffled. The predicate must also name superseded data sets
    that ``new`` no longer holds.
    """
    if _has_rows(old.sparkSession, table, path):
        raise ValueError(f"{path} already holds rows")
    _save(kept_rows(old, owned, table), table, path, "append")
    return write_table(new, table, path, "WRITE_APPEND")


def _files(spark: SparkSession, path: str):
    """The file context of a path, and a maker of Hadoop paths."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new(path).toUri(), spark._jsc.hadoopConfiguration()), new


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Published versions of an owned table, oldest first."""
    files, new = _files(spark, path)
    place = new(f"{path}/{_PUBLISHED}")
    if not files.util().exists(place):
        return []
    names = [status.getPath().getName() for status in files.util().listStatus(place)]
    return sorted(n for n in names if n.startswith("v"))


def published_loads(spark: SparkSession, path: str, version: str | None = None) -> list[tuple[str, str]]:
    """(owner, load) pairs of a version, the last one by default."""
    versions = _versions(spark, path)
    if not versions:
        return []
    lines = spark.read.text(f"{path}/{_PUBLISHED}/{version or versions[-1]}").collect()  # a line for each load
    return sorted(tuple(line["value"].split("\t")) for line in lines)


def load_path(path: str, owner: str, load: str) -> str:
    return f"{path}/owner={owner}/load={load}"


def _publish(spark: SparkSession, path: str, version: str, loads: list[tuple[str, str]]) -> None:
    """Write a version whole beside its place, then move it there, which fails if the version has been taken."""
    files, new = _files(spark, path)
    staged, target = (new(f"{path}/{_PUBLISHED}/{name}") for name in (f"_{uuid.uuid4().hex}", version))
    make = spark._jvm.java.util.EnumSet.of(spark._jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    no_options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.CreateOpts, 1)
    no_options[0] = spark._jvm.org.apache.hadoop.fs.Options.CreateOpts.createParent()
    out = files.create(staged, make, no_options)
    out.write("".join(f"{owner}\t{load}\n" for owner, load in loads).encode())
    out.close()
    keep = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files.rename(staged, target, keep)


def replace_owned(new: DataFrame, owner: str, table: str, path: str, derive: Derive | None = None) -> int:
    """Replace all rows of one owner; returns the new rows. Readers never see a part of it.

    Each load is a folder of its own, ``owner=<owner>/load=<id>``, and a published version is one small file that names the
    load of each owner. The new rows are written first, then a version with the new load is moved into place, as one rename: until
    then every reader finds the old rows, and a writer that fails leaves them as they are. Two writers cannot publish
    the same version; the later one takes up the other's load and tries again. No row or file of another owner is
    read or written. ``vacuum_owned`` removes what no version names any more. ``derive`` gets the rows just written, their owner
    and load before they are published.
    """
    return _add_load(new, owner, table, path, True, derive)


def append_owned(new: DataFrame, owner: str, table: str, path: str, derive: Derive | None = None) -> int:
    """Add a load to an owner's rows, published in the same way."""
    return _add_load(new, owner, table, path, False, derive)


def _add_load(new: DataFrame, owner: str, table: str, path: str, replace: bool, derive: Derive | None) -> int:
    if "/" in owner or "\t" in owner or not owner:
        raise ValueError(f"not a name for an owner: {owner!r}")
    spark, load = new.sparkSession, uuid.uuid4().hex
    written = write_table(new, table, load_path(path, owner, load))
    if derive is not None:
        derive(read_table(spark, table, load_path(path, owner, load)), owner, load)
    while True:
        versions = _versions(spark, path)
        before = published_loads(spark, path, versions[-1]) if versions else []
        kept = [pair for pair in before if not replace or pair[0] != owner]
        version = f"v{int(versions[-1][1:]) + 1 if versions else 1:012d}"
        try:
            _publish(spark, path, version, [*kept, (owner, load)])
            return written
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise


def read_owned(spark: SparkSession, table: str, path: str, version: str | None = None) -> DataFrame:
    """A version of a table with owners, the last one by default, in registry order; ``owner`` comes last and is a partition column.

    A frame keeps the version it was made from, also when another one is published before it runs.
    """
    schema = registered(table).schema
    kept = T.StructType([*schema, T.StructField("owner", T.StringType())])
    loads = published_loads(spark, path, version)
    if not loads:
        return spark.createDataFrame([], kept)
    stored = T.StructType([*kept, T.StructField("load", T.StringType())])
    folders = [load_path(path, owner, load) for owner, load in loads]
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*kept.names)


def vacuum_owned(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove versions but the last ``keep``, and loads that none of these names; returns the loads removed.

    Run it when no reader of older versions and no writer is left.
    """
    if keep < 1:
        raise ValueError("at least the last version must be kept")
    files, new = _files(spark, path)
    versions, removed = _versions(spark, path), 0
    named = {pair for v in versions[-keep:] for pair in published_loads(spark, path, v)}
    for version in versions[:-keep]:
        files.delete(new(f"{path}/{_PUBLISHED}/{version}"), False)
    for owner in files.util().listStatus(new(path)):
        name = owner.getPath().getName()
        for load in files.util().listStatus(owner.getPath()) if name.startswith("owner=") else []:
            if (name.removeprefix("owner="), load.getPath().getName().removeprefix("load=")) not in named:
                removed += files.delete(load.getPath(), True)
    return removed


BUCKET_ROWS = 1_000_000  # rows of a bucket: some hundred megabytes in memory, at most


def bucket_count(rows: int, least: int = 16) -> int:
    """Buckets for a number of rows, so that a bucket stays as large however many there are."""
    return max(least, -(-rows // BUCKET_ROWS))


def write_bucketed(
    df: DataFrame, table: str, identifier: str, path: str, keys: list[str], buckets: int, placed: bool = False
) -> int:
    """Save rows as a catalog table cut and sorted by join keys, one file for each bucket; returns the rows.

    Joins on exactly these keys then read the table without shuffling it, however often. Adaptive execution cannot
    split a bucket, so this is for keys that spread well; choose ``buckets`` so that one holds some hundred megabytes
    (``bucket_count``). The writer sorts each bucket, so nothing sorts here. ``placed`` says that ``df`` is already
    partitioned by ``repartition(buckets, *keys)``, and spares the shuffle.
    """
    counted = Observation()
    rows = described(df, table) if placed else described(df, table).repartition(buckets, *keys)
    writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(identifier)
    return counted.get["rows"]


def create_tables(spark: SparkSession, database: str, tables: list[str] | None = None, recreate: bool = False) -> None:
    """Create catalog tables with comments and partitioning; ``recreate`` drops them first."""
    for name in tables or list(TABLES):
        identifier = f"`{database}`.`{name}`"
        if recreate:
            spark.sql(f"DROP TABLE IF EXISTS {identifier}")
        spark.sql(registered(name).ddl(identifier))


def reload_table(df: DataFrame, database: str, table: str) -> None:
    """Replace the rows of a catalog table and keep its comments.

    The table is overwritten by an insert, which publishes the new rows when the job is complete and refuses a
    frame that reads the same table.
    """
    identifier = f"{database}.{table}"
    target = df.sparkSession.table(identifier).columns
    laid_out(described(df, table), table).select(*target).write.insertInto(identifier, overwrite=True)
