import glob

import pytest
from pyspark.sql import functions as F

from assocspark.operators import views
from assocspark.schemas import TABLES
from assocspark.sources import tables
from conftest import plan_of


def coloc(spark, rows, dataset="d", chrom=1):
    return spark.range(rows).select(
        F.lit(dataset).alias("dataset"), F.lit("GWAS").alias("data_type"), F.lit("t").alias("trait"), F.lit("t").alias("trait_original"),
        F.lit(None).cast("string").alias("cell_type"), F.lit(chrom).cast("bigint").alias("chr"), F.col("id").alias("pos"),
        F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.lit(1.0).alias("mlog10p"), F.lit(1.0).alias("beta"),
        F.lit(1.0).alias("se"), F.lit(0.5).alias("pip"), F.lit("cs").alias("cs_id"),
    )


def test_write_modes_and_counts_of_one_write(spark, folder):
    path = f"{folder}/t"
    assert tables.write_table(coloc(spark, 50), "coloc_credsets", path, "WRITE_EMPTY") == 50
    assert tables.write_table(coloc(spark, 7, chrom=23), "coloc_credsets", path, "WRITE_APPEND") == 7
    assert tables.read_table(spark, "coloc_credsets", path).count() == 57
    with pytest.raises(ValueError, match="already holds rows"):
        tables.write_table(coloc(spark, 1), "coloc_credsets", path, "WRITE_EMPTY")
    assert tables.write_table(coloc(spark, 3), "coloc_credsets", path, "WRITE_TRUNCATE") == 3
    assert tables.read_table(spark, "coloc_credsets", path).count() == 3
    with pytest.raises(ValueError, match="write mode"):
        tables.write_table(coloc(spark, 1), "coloc_credsets", path, "WRITE_SOMEHOW")


def test_write_empty_accepts_an_empty_table(spark, folder):
    path = f"{folder}/t"
    tables.write_table(coloc(spark, 0), "coloc_credsets", path)
    assert tables.write_table(coloc(spark, 2), "coloc_credsets", path, "WRITE_EMPTY") == 2


def test_chromosome_is_a_pruned_partition_in_its_old_place(spark, folder):
    path = f"{folder}/t"
    tables.write_table(coloc(spark, 5).union(coloc(spark, 5, chrom=25)), "coloc_credsets", path)
    back = tables.read_table(spark, "coloc_credsets", path)
    assert back.columns == TABLES["coloc_credsets"].columns and dict(back.dtypes)["chr"] == "bigint"
    plan = plan_of(views.view("coloc_credsets", back).filter("chr = 25 AND dataset = 'd'").select("variant", "resource"))
    assert "PartitionFilters: [isnotnull(chr" in plan and "EqualTo(dataset,d)" in plan
    assert "mlog10p" not in plan.split("ReadSchema")[1]
    assert {p.split("=")[-1] for p in glob.glob(f"{path}/chr=*")} == {"1", "25"}


def test_hot_chromosome_and_data_set_are_cut_into_several_sorted_files(spark, folder):
    path = f"{folder}/t"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_table(coloc(spark, 4_000), "coloc_credsets", path, sampled=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(f"{path}/chr=1/*.parquet")
    sizes = [spark.read.parquet(f).agg(F.count("*"), F.min("pos"), F.max("pos")).first() for f in files]
    assert len(files) == 8 and max(s[0] for s in sizes) < 1_500
    ordered = sorted((s[1], s[2]) for s in sizes)
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_equal_rows_are_cut_too(spark):
    same = coloc(spark, 4_000).withColumn("pos", F.lit(1).cast("bigint"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = tables.laid_out(same, "coloc_credsets", sampled=True).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 4 and sum(p["count"] for p in parts) == 4_000


def test_unsampled_layout_reads_the_input_once_and_cuts_a_hot_data_set(spark, folder):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8192",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1024",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    reads = spark.sparkContext.accumulator(0)
    try:
        wide = coloc(spark, 8_000).withColumn("trait", F.sha2(F.col("pos").cast("string"), 256))

        def count(batches):
            for batch in batches:
                reads.add(len(batch))
                yield batch

        counted = wide.mapInPandas(count, wide.schema)
        assert tables.write_table(counted, "coloc_credsets", f"{folder}/t", sampled=False) == 8_000
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert reads.value == 8_000
    assert len(glob.glob(f"{folder}/t/chr=1/*.parquet")) > 4
    assert tables.read_table(spark, "coloc_credsets", f"{folder}/t").select("pos").distinct().count() == 8_000


def test_replacing_keeps_other_and_unnamed_data_sets(spark, folder):
    old = coloc(spark, 3, "QTD1").union(coloc(spark, 2, "qtd2")).union(coloc(spark, 1, "A")).union(coloc(spark, 4, "gone"))
    tables.write_table(old, "coloc_credsets", f"{folder}/v1")
    stored = tables.read_table(spark, "coloc_credsets", f"{folder}/v1")
    owned = tables.owned_rows(["A", "gone"], "QTD%")
    assert tables.replace_rows(stored, owned, coloc(spark, 5, "A"), "coloc_credsets", f"{folder}/v2") == 5
    assert "Exchange" not in plan_of(tables.kept_rows(stored, owned, "coloc_credsets"))
    with pytest.raises(ValueError, match="already holds rows"):
        tables.replace_rows(stored, owned, coloc(spark, 5, "A"), "coloc_credsets", f"{folder}/v2")
    back = tables.read_table(spark, "coloc_credsets", f"{folder}/v2").groupBy("dataset").count()
    assert {r["dataset"]: r["count"] for r in back.collect()} == {"A": 5, "qtd2": 2}
    unnamed = spark.createDataFrame([("A",), (None,)], "dataset string")
    assert [r[0] for r in tables.without_owned(unnamed, owned).collect()] == [None]


def test_catalog_tables_keep_comments_over_a_reload(spark, folder):
    spark.sql(f"CREATE DATABASE test_catalog LOCATION '{folder}/db'")
    try:
        tables.create_tables(spark, "test_catalog", ["coloc_credsets", "gene_annotations"])
        tables.reload_table(coloc(spark, 5), "test_catalog", "coloc_credsets")
        tables.reload_table(coloc(spark, 2, "e"), "test_catalog", "coloc_credsets")
        kept = spark.table("test_catalog.coloc_credsets")
        assert [r["dataset"] for r in kept.collect()] == ["e", "e"]
        wanted = {f.name: f.metadata["comment"] for f in TABLES["coloc_credsets"].schema}
        assert {f.name: f.metadata.get("comment") for f in kept.schema} == wanted
        tables.create_tables(spark, "test_catalog", ["coloc_credsets"], recreate=True)
        assert spark.table("test_catalog.coloc_credsets").count() == 0
    finally:
        spark.sql("DROP DATABASE test_catalog CASCADE")


def test_both_names_give_the_view(spark):
    views.register(spark, {"coloc_credsets": coloc(spark, 2)})
    for name in ("coloc_credsets", "coloc_credsets_v"):
        assert spark.sql(f"SELECT variant, resource FROM {name} ORDER BY pos").first() == ("1:0:A:G", "d")
        spark.catalog.dropTempView(name)
    assert views.base_name("mpra_v") == views.base_name("mpra") == "mpra"
    with pytest.raises(KeyError):
        views.base_name("nothing_v")


def owned(spark, path):
    return {(r["owner"], r["dataset"]): r["count"] for r in tables.read_owned(spark, "coloc_credsets", path).groupBy("owner", "dataset").count().collect()}


def test_a_failed_replacement_leaves_the_old_rows(spark, folder):
    path = f"{folder}/t"
    assert tables.read_owned(spark, "coloc_credsets", path).count() == 0
    tables.replace_owned(coloc(spark, 5, "old"), "one", "coloc_credsets", path)
    tables.replace_owned(coloc(spark, 3, "b"), "two", "coloc_credsets", path)
    broken = coloc(spark, 4_000, "new").withColumn("pos", F.when(F.col("pos") > 3_000, F.raise_error(F.lit("midway")).cast("bigint")).otherwise(F.col("pos")))
    with pytest.raises(Exception, match="midway"):
        tables.replace_owned(broken, "one", "coloc_credsets", path)
    assert owned(spark, path) == {("one", "old"): 5, ("two", "b"): 3}
    tables.vacuum_owned(spark, path)  # and what the failed writer may have left goes
    assert len(glob.glob(f"{path}/owner=*/load=*")) == 2
    assert owned(spark, path) == {("one", "old"): 5, ("two", "b"): 3}


def test_readers_keep_their_version_until_it_is_removed(spark, folder):
    path = f"{folder}/t"
    tables.replace_owned(coloc(spark, 5, "old"), "one", "coloc_credsets", path)
    before = tables.read_owned(spark, "coloc_credsets", path)
    assert tables.replace_owned(coloc(spark, 2, "new"), "one", "coloc_credsets", path) == 2
    assert before.count() == 5 and owned(spark, path) == {("one", "new"): 2}
    assert tables.read_owned(spark, "coloc_credsets", path, "v000000000001").count() == 5
    assert tables.vacuum_owned(spark, path) == 1 and owned(spark, path) == {("one", "new"): 2}
    plan = plan_of(tables.read_owned(spark, "coloc_credsets", path).filter("owner = 'one' AND chr = 1"))
    assert "PartitionFilters: [isnotnull(chr" in plan or "owner" in plan.split("PartitionFilters")[1]


def test_two_writers_do_not_lose_a_load(spark, folder, monkeypatch):
    path, real, calls = f"{folder}/t", tables._publish, []
    tables.replace_owned(coloc(spark, 1, "a"), "one", "coloc_credsets", path)

    def overtaken(spark, path, version, loads):
        calls.append(version)
        if len(calls) == 1:  # another writer publishes first
            monkeypatch.setattr(tables, "_publish", real)
            tables.replace_owned(coloc(spark, 2, "b"), "two", "coloc_credsets", path)
            monkeypatch.setattr(tables, "_publish", overtaken)
        real(spark, path, version, loads)

    monkeypatch.setattr(tables, "_publish", overtaken)
    tables.replace_owned(coloc(spark, 3, "c"), "three", "coloc_credsets", path)
    assert calls == ["v000000000002", "v000000000003"]
    assert owned(spark, path) == {("one", "a"): 1, ("two", "b"): 2, ("three", "c"): 3}
