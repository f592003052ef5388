import pytest
from pyspark.sql import functions as F

from assocspark.functions.resources import Rule
from assocspark.operators import lookups, profile, results, views
from assocspark.schemas import TABLES
from conftest import plan_of


@pytest.fixture(scope="module")
def credible(spark):
    rows = [("QTD000001", "eQTL", "a"), ("QTD000002", "sQTL", None), ("UKB_PPP", "pQTL", "b"), ("UKB_PPP", "pQTL", "b"), (None, "GWAS", "c")]
    return spark.createDataFrame(rows, "dataset string, data_type string, cell_type string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_an_answer_is_computed_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 10_000, 1, 7).mapInArrow(count, "id long")
    for order in ([], [F.col("id").desc()]):
        before = reads.value
        found = results.capped(rows, 20, order).collect()
        assert reads.value - before == 10_000 and len(found) == 20 and found[0]["total_rows"] == 10_000
    assert results.capped(spark.range(30).limit(20).orderBy(F.col("id").desc()), 25).first()["total_rows"] == 20
    views_before = {t.name for t in spark.catalog.listTables()}
    frames = {"coloc_credsets": spark.createDataFrame([("FinnGen_R14", 1, 5, "A", "G", "CS1")], "dataset string, chr long, pos long, ref string, alt string, cs_id string")}
    asked = results.ask(spark, frames, "SELECT resource, count(*) AS n FROM coloc_credsets_v GROUP BY resource", 10).collect()
    assert asked == [("finngen", 1, 1, False)]
    for name in {t.name for t in spark.catalog.listTables()} - views_before:
        spark.catalog.dropTempView(name)


def test_allowed_values_are_distinct_known_and_sorted(credible):
    found = rows(profile.allowed_values("credible_sets", credible, ["cell_type", "resource"]))
    assert found == [("cell_type", v) for v in "abc"] + [("resource", v) for v in ("qtd000001", "qtd000002", "ukbb")]


def test_allowed_values_by_parent_skip_null_parents(credible):
    found = rows(profile.allowed_values_by("credible_sets", credible, ["data_type", "cell_type"], "resource"))
    assert found == [
        ("qtd000001", "cell_type", "a"), ("qtd000001", "data_type", "eQTL"), ("qtd000002", "data_type", "sQTL"),
        ("ukbb", "cell_type", "b"), ("ukbb", "data_type", "pQTL"),
    ]


def test_collections_fold_to_a_count_and_shared_types(credible):
    values = profile.allowed_values("credible_sets", credible, ["resource"])
    assert rows(profile.compact_values(values, ["qtd"])) == [("resource", False, "ukbb", 1), ("resource", True, "qtd", 2)]
    assert rows(profile.compact_values(values, [])) == [("resource", False, v, 1) for v in ("qtd000001", "qtd000002", "ukbb")]
    grouped = profile.allowed_values_by("credible_sets", credible, ["data_type"], "resource")
    assert rows(profile.compact_values_by(grouped, ["qtd"])) == [
        ("ukbb", False, "data_type", "pQTL"), (None, True, "data_type", "eQTL"), (None, True, "data_type", "sQTL"),
    ]


def test_audit_names_the_deciding_rule(credible):
    found = {r["dataset"]: tuple(r)[1:] for r in profile.mapping_audit(credible, [Rule("ukb%", "u"), Rule("*", transform="lowercase")]).collect()}
    assert found["UKB_PPP"] == (2, "u", "ukb%", False)
    assert found["QTD000001"] == (1, "qtd000001", "*", True)


def test_required_violations(credible):
    assert dict(rows(profile.required_violations(credible, ["dataset", "cell_type", "data_type"]))) == {"dataset": 1, "cell_type": 1, "data_type": 0}


def test_modes_of_stored_and_derived_columns():
    assert profile.column_mode("asm_qtl", "variant") == "NULLABLE"
    assert profile.column_mode("credible_sets", "variant") == "REQUIRED"
    assert profile.column_mode("mpra", "variant") == "NULLABLE"
    assert profile.column_mode("credible_sets", "maf") == "NULLABLE"
    assert profile.column_mode("colocalization", "resource2") == "REQUIRED"
    assert profile.column_mode("gene_annotations", "gene_group_ids") == "REPEATED"


def test_dictionary_covers_all_views_with_types_comments_and_nulls(spark):
    frames = {name: spark.createDataFrame([], t.schema) for name, t in TABLES.items()}
    found = profile.data_dictionary(frames).collect()
    expected = [(f"{t}_v", c) for t in TABLES for c in views.view(t, frames[t]).columns]
    assert [(r["view_name"], r["column_name"]) for r in found] == expected
    kinds = {(r["view_name"], r["column_name"]): r["type"] for r in found}
    assert kinds["gene_annotations_v", "gene_group_ids"] == "INT64" and kinds["credible_sets_v", "maf"] == "FLOAT64"
    assert all(r["description"] for r in found)
    one = profile.data_dictionary({"mpra": frames["mpra"]}, {("mpra", "emVar"): "own text"}).filter("column_name = 'emVar'")
    assert one.first()["description"] == "own text"


def test_dictionary_counts_nulls_of_derived_columns(spark):
    df = spark.createDataFrame([(1, 1, "A", None, 0.1), (1, 2, "A", "G", None)], "chr long, pos long, ref string, alt string, af double").withColumn("dataset", F.lit("d"))
    nulls = {r["column_name"]: r["n_null"] for r in profile.data_dictionary({"asm_qtl": df}).collect()}
    assert (nulls["variant"], nulls["maf"], nulls["resource"], nulls["pos"]) == (1, 1, 0, 0)


def test_caps(spark):
    answer = spark.range(25)
    capped = results.capped(answer, 10).collect()
    assert len(capped) == 10 and {(r["total_rows"], r["truncated"]) for r in capped} == {(25, True)}
    assert {r["truncated"] for r in results.capped(answer, 25).collect()} == {False}
    assert results.capped_flag(answer, 24)[1] and not results.capped_flag(answer, 25)[1]
    assert results.answer(spark.sql("SELECT array(1L) AS a"), 5).collect() == [("[1]", 1, False)]
    assert results.capped(answer.filter("id > 99"), 10).collect() == [(None, 0, False)]
    assert [r["id"] for r in results.capped(answer, 3, [F.col("id").desc()]).collect()] == [24, 23, 22]
    assert [r["id"] for r in results.capped(answer.orderBy(F.col("id") % 5, "id"), 6).collect()] == [0, 5, 10, 15, 20, 1]
    for bad in (0, -1, 100_001):
        with pytest.raises(ValueError):
            results.capped(answer, bad)
    for bad in (0, 101):
        with pytest.raises(ValueError):
            results.sample_rows(answer, bad)
    assert results.sample_rows(spark.range(500), 100).count() == 100
    assert results.sample_rows(spark.range(500)).count() == 10


def test_values_as_text(spark):
    df = spark.sql("SELECT date'2026-06-02' AS d, array(1L, NULL) AS n, array('a', 'it''s', 'x\"''y') AS s, 1L AS i, true AS b, 0.5D AS f")
    assert tuple(results.stringify(df).first()) == ("2026-06-02", "[1, None]", str(["a", "it's", "x\"'y"]), 1, True, 0.5)


def test_lead_variants_break_ties_and_put_nulls_last(spark):
    data = [
        ("d", "c", 0.5, None, 1, 9, "A", "G"), ("d", "c", 0.5, 3.0, 2, 5, "A", "G"), ("d", "c", 0.5, 3.0, 1, 7, "C", "G"),
        ("d", "c", 0.5, 3.0, 1, 7, "A", "G"), ("d", "c", 0.5, 3.0, 1, 7, "A", "T"), ("d", "c", None, 99.0, 1, 1, "A", "A"),
        ("e", "c", 0.1, 1.0, 1, 1, "A", "G"),
    ]
    df = spark.createDataFrame(data, "dataset string, cs_id string, pip double, mlog10p double, chr long, pos long, ref string, alt string")
    lead = lookups.lead_variants(df)
    assert sorted((r["dataset"], r["pos"], r["ref"], r["alt"]) for r in lead.collect()) == [("d", 7, "A", "G"), ("e", 1, "A", "G")]
    before_shuffle = plan_of(lead).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_resource_filter_is_a_semi_join_on_names(spark, credible, folder):
    credible.write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    rules = [Rule("ukb%", "u"), Rule("*", transform="lowercase")]
    found = lookups.filter_by_resource(stored, rules, "u")
    assert "LeftSemi" in plan_of(found) and found.columns == stored.columns
    assert found.count() == 2


def test_other_lookups(spark):
    coloc = spark.createDataFrame([("a", "b"), ("b", None), ("c", "a"), ("d", None)], "trait1 string, trait2 string")
    assert lookups.colocalizations_of(coloc, "a").count() == 2
    variants = spark.createDataFrame([(1, 1, "A", "G"), (23, 1, "A", "G"), (23, 1, "A", "T")], "chr long, pos long, ref string, alt string")
    assert lookups.variants_in_list(variants, ["1:1:A:G"]).count() == 1
    for x in ("X:1:A:G", "chrX:1:A:G", "23:1:A:G"):
        assert [r["chr"] for r in lookups.variants_in_list(variants, ["1:1:A:G", x]).collect()] == [1, 23]
    for bad in ("1:1:A", "Q:1:A:G", "1:x:A:G"):
        with pytest.raises(ValueError):
            lookups.variants_in_list(variants, [bad])
    hla = spark.createDataFrame([("p", "A*01:01", 8.0, 0.5), ("p", "A*01:01", 8.0, 0.4), ("q", "A*01:01", 7.3, 0.9), ("q", "B", 9.0, 0.9)], "phenotype string, allele string, mlogp double, info double")
    assert lookups.phenotypes_of_allele(hla, "A*01:01").count() == 1
    assert lookups.alleles_of_phenotype(hla, "q").count() == 1
    genes = spark.createDataFrame([("g", [1, 2], ["a", None]), ("h", [], [])], "symbol string, gene_group_ids array<long>, gene_group_names array<string>")
    assert [r["symbol"] for r in lookups.genes_outside_group(genes, "b").collect()] == ["g", "h"]
    assert [r["symbol"] for r in lookups.genes_outside_group(genes, "a").collect()] == ["h"]


def test_regions_include_both_ends(spark):
    sites = spark.createDataFrame([(1, p) for p in (99, 100, 200, 201)] + [(2, 150)], "chr long, pos long")
    assert [r["pos"] for r in lookups.in_region(sites, 1, 100, 200, "pos").collect()] == [100, 200]
    peaks = spark.createDataFrame([(1, 0, 99), (1, 0, 100), (1, 199, 300), (1, 200, 300)], "chr long, peak_start long, peak_end long")
    assert [tuple(r)[1:] for r in lookups.peaks_in_region(peaks, 1, 100, 200).collect()] == [(0, 100), (199, 300)]
    spans = spark.createDataFrame([(1, 10, 99), (1, 10, 100), (1, 200, 300), (1, 201, 300), (1, 1, 999)], "chr long, a long, b long")
    assert lookups.in_region(spans, 1, 100, 200, "a", "b").count() == 3
