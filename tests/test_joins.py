import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assocspark.operators import joins
from assocspark.plans import loads
from assocspark.sources import tables
from conftest import SMALL, plan_of


@pytest.fixture
def merge_joins(spark):
    """No broadcast, and a low threshold for what counts as a skewed partition."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def coloc(spark, *rows):
    columns = "dataset1 dataset2 trait1 trait2 hit1 hit2".split()
    return spark.createDataFrame(
        [("d1", "d2", "t1", symbol, "1:1:A:G", hit, kind) for symbol, hit, kind in rows],
        ", ".join(f"{c} string" for c in columns) + ", data_type2 string",
    ).withColumn("PP_H4_abf", F.lit(0.9))


def test_cis_and_trans(spark):
    genes = spark.createDataFrame([("G", 1, 5_000_000, 5_001_000), ("N", None, None, None)], "symbol string, chr long, gene_start long, gene_end long")
    rows = coloc(
        spark, ("G", "1:4000000:A:G", "pQTL"), ("G", "1:3999999:A:G", "pQTL"), ("G", "2:5000000:A:G", "pQTL"), ("G", "bad", "pQTL"),
        ("G", "X:6001000:A:G", "pQTL"), ("G", "1:5000000:A:G", "eQTL"), (None, "1:5000000:A:G", "pQTL"), ("N", "1:1:A:G", "pQTL"),
    )

    def hits(df):
        return sorted(r["hit2"] for r in df.collect())

    assert hits(joins.cis_colocalization(rows, genes)) == ["1:4000000:A:G", "2:5000000:A:G", "X:6001000:A:G"]
    assert hits(joins.cis_colocalization(rows, genes, match_chr=True)) == ["1:4000000:A:G"]
    assert hits(joins.trans_colocalization(rows, genes)) == ["1:3999999:A:G"]
    assert hits(joins.trans_colocalization(rows, genes, match_chr=True)) == ["1:3999999:A:G", "2:5000000:A:G", "X:6001000:A:G"]


def test_hot_key_is_split_and_the_result_is_whole(spark, merge_joins):
    """A third of all variants carry one peak id."""
    peaks = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 997))
    variants = spark.range(0, 60_000, 1, 8).select(
        peaks.alias("trait"), F.lit("c").alias("cell_type"), F.lit("caQTL").alias("data_type"), F.lit("d").alias("dataset"),
        F.sha2(F.col("id").cast("string"), 256).alias("cs_id"), F.lit(1).cast("bigint").alias("chr"), F.col("id").alias("pos"),
        F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.lit(0.5).alias("pip"),
    )
    links = spark.createDataFrame([("hot", "c", "G1"), ("hot", "c", "G2"), ("hot", "other", "G3"), ("p1", "c", "G4")], "peak_id string, cell_type string, symbol string").withColumn("chr", F.lit(1))
    joined = joins.caqtl_to_gene(variants, links)
    found = Counter(r["symbol"] for r in joined.select("symbol", "cs_id").collect())
    assert found == {"G1": 20_000, "G2": 20_000, "G4": variants.filter("trait = 'p1'").count()}
    run = joins.caqtl_to_gene(variants, links)
    run.collect()
    assert re.search(r"SortMergeJoin\(skew=true\)", plan_of(run))


def test_any_cell_type_keeps_both(spark):
    variants = spark.createDataFrame([("p", "c", "caQTL"), ("p", "c", "eQTL")], "trait string, cell_type string, data_type string")
    for name, value in {"dataset": "d", "cs_id": "c", "ref": "A", "alt": "G"}.items():
        variants = variants.withColumn(name, F.lit(value))
    variants = variants.withColumns({"chr": F.lit(1), "pos": F.lit(1), "pip": F.lit(0.1)})
    links = spark.createDataFrame([("p", "c", "G1"), ("p", "e", "G2")], "peak_id string, cell_type string, symbol string").withColumn("chr", F.lit(2))
    assert joins.caqtl_to_gene(variants, links, same_chr=True).count() == 0
    assert [r["symbol"] for r in joins.caqtl_to_gene(variants, links).collect()] == ["G1"]
    other = joins.caqtl_to_gene(variants, links, same_cell_type=False).collect()
    assert sorted((r["symbol"], r["link_cell_type"]) for r in other) == [("G1", "c"), ("G2", "e")]


def test_variant_join_prunes_partitions_of_the_other_side(spark, folder):
    sites = spark.range(50).select((F.col("id") % 5).alias("chr"), F.col("id").alias("pos"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.lit("rs").alias("rsid"))
    sites.write.partitionBy("chr").parquet(f"{folder}/a")
    stored = spark.read.parquet(f"{folder}/a").select("chr", "pos", "ref", "alt", "rsid")
    joined = joins.annotate_variants(stored.drop("rsid").filter("chr = 3"), stored, ["rsid"])
    assert joined.count() == 10
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan_of(joined))
    assert len(filters) == 2 and all("= 3)" in f for f in filters)
    assert joins.annotate_variants(stored.drop("rsid"), stored.filter("pos < 5"), ["rsid"], "left").count() == 50


def test_links_of_one_gene_prune_the_chromosomes_of_the_credible_sets(spark, folder):
    one = spark.range(1_000).select(
        (F.col("id") % 20).alias("chr"), F.col("id").alias("pos"), F.concat(F.lit("p"), F.col("id") % 100).alias("trait"),
        *[F.lit(v).alias(n) for n, v in {"data_type": "caQTL", "cell_type": "c", "dataset": "d", "cs_id": "c", "ref": "A", "alt": "G"}.items()],
        F.lit(0.5).alias("pip"),
    )
    one.write.partitionBy("chr").parquet(f"{folder}/cs")
    peaks = spark.range(100).select(
        F.concat(F.lit("p"), "id").alias("peak_id"), F.lit("c").alias("cell_type"), (F.col("id") % 20).alias("chr"),
        F.concat(F.lit("G"), "id").alias("symbol"),
    )
    peaks.write.parquet(f"{folder}/links")
    stored, links = spark.read.parquet(f"{folder}/cs"), spark.read.parquet(f"{folder}/links").filter("symbol = 'G7'")
    found = joins.caqtl_to_gene(stored, links, same_chr=True)
    assert "dynamicpruning" in plan_of(found)
    assert found.count() == 10 and {r["chr"] for r in found.collect()} == {7}


def test_bucketed_sides_are_not_shuffled(spark, folder):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    sets = spark.range(4_000).selectExpr(
        "'d' || id % 7 AS dataset", "'x' AS data_type", "'t' AS trait", "'t' AS trait_original", "id % 24 + 1 AS chr", "id AS pos", "'A' AS ref", "'G' AS alt",
        "1D AS mlog10p", "1D AS beta", "id / 4000D AS pip", "'c' || id % 500 AS cs_id",
    )
    pairs = spark.range(600).selectExpr(
        "'d' || id % 7 AS dataset1", "'c' || id % 500 AS cs1_id", "'d' || id % 3 AS dataset2", "'c' || id % 90 AS cs2_id", "5e-1D AS PP_H4_abf"
    )
    written = tables.write_bucketed(sets, "coloc_credsets", "bucket_test", f"{folder}/b", ["dataset", "cs_id"], 8)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key in settings:
        spark.conf.set(key, "-1")
    try:
        stored = spark.table("bucket_test")
        joined = joins.colocalized_members(pairs, stored)
        found, plain = joined.collect(), joins.colocalized_members(pairs, sets).collect()
        plan = plan_of(joined)
        both = plan_of(stored.alias("a").join(stored.alias("b"), ["dataset", "cs_id"]).select("a.pos", "b.pip"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        spark.sql("DROP TABLE bucket_test")
    assert written == 4_000 and sorted(map(str, found)) == sorted(map(str, plain)) and found
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(dataset") == 1 and "Bucketed: true" in final
    assert "Exchange" not in both.split("== Initial Plan ==")[0]


def test_buckets_follow_from_the_rows():
    assert tables.bucket_count(0) == 16 and tables.bucket_count(16_000_001) == 17 and tables.bucket_count(216_000_000) == 216
    assert tables.bucket_count(5, 8) == 8


def test_bucketed_queries_ask_for_their_buckets(spark, monkeypatch):
    """Members and annotated sites: the count follows from the rows, and sites are dealt to buckets once."""
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    asked, write = [], tables.write_bucketed

    def noted(df, table, *rest):
        asked.append((table, rest[3], rest[4], plan_of(df).count("Exchange hashpartitioning") if rest[4] else None))
        return write(df, table, *rest)

    monkeypatch.setattr(tables, "write_bucketed", noted)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    buckets = -(-lines // 100)
    for name in ("bucketed_members", "bucketed_annotation"):
        assert entry.queries()[name](spark, SMALL).count() > 0
    assert asked == [
        ("coloc_credsets", buckets, False, None), ("credible_sets", buckets, False, None), ("variant_annotation", buckets, True, 1),
    ]


def test_sorted_region_files_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 500)
    parts, write = [], loads.write_bgzf

    def noted(df, path):
        parts.append(df.rdd.getNumPartitions())
        return write(df, path)

    monkeypatch.setattr(loads, "write_bgzf", noted)
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    entry.queries()["bgz_region"](spark, SMALL).collect()
    assert parts == [-(-rows // 500)] and parts[0] > 8
