"""Summaries of loads, merged, against full scans."""

import pytest
from pyspark.sql import functions as F

from assocspark.operators import profile, states
from assocspark.sources import profiled, tables

VALUES = ["dataset", "data_type", "cell_type"]


def sets(spark, n, dataset, first=0):
    return spark.range(first, first + n).selectExpr(
        f"'{dataset}' || id % 3 AS dataset", "CASE id % 4 WHEN 0 THEN 'eQTL' ELSE 'GWAS' END AS data_type", "'t' || id AS trait", "'t' AS trait_original",
        "CASE WHEN id % 5 > 1 THEN 'cell' || id % 5 END AS cell_type", "id % 24 + 1 AS chr", "id AS pos", "'A' AS ref", "'G' AS alt", "1D AS mlog10p",
        "1D AS beta", "id / 1000D AS pip", "'c' || id % 50 AS cs_id",
    )


def rows_of(df):
    return sorted(map(str, df.collect()))


def check(spark, path):
    table = tables.read_owned(spark, "coloc_credsets", path)
    state = profiled.stored_values(spark, path)
    assert rows_of(state.select(*VALUES, "n_rows")) == rows_of(states.combinations(table, VALUES))
    columns = [*VALUES, "resource"]
    assert rows_of(profile.allowed_values("coloc_credsets", state, columns)) == rows_of(profile.allowed_values("coloc_credsets", table, columns))
    by = [profile.allowed_values_by("coloc_credsets", df, ["data_type", "cell_type"], "resource") for df in (state, table)]
    assert rows_of(by[0]) == rows_of(by[1])
    found = {r["column_name"]: r for r in profiled.stored_sketches(spark, path).collect()}
    exact = {r["column_name"]: r["n_exact"] for r in states.distinct_counts(table, ["trait", "cell_type"]).collect()}
    for name, n in exact.items():
        assert abs(found[name]["n_distinct"] - n) <= 0.07 * n and found[name]["n_rows"] == table.count()
    assert found["cell_type"]["n_null"] == table.filter("cell_type IS NULL").count()


def test_states_follow_appends_and_replacements(spark, folder):
    path, read = f"{folder}/t", []
    keep = profiled.profiled(path, VALUES, ["trait", "cell_type"])

    def derive(rows, owner, load):
        read.append({f.split("/load=")[1].split("/")[0] for f in rows.inputFiles()} == {load})
        keep(rows, owner, load)

    with pytest.raises(ValueError, match="no published loads"):
        profiled.stored_values(spark, path)
    tables.replace_owned(sets(spark, 3_000, "FinnGen_R"), "one", "coloc_credsets", path, derive)
    check(spark, path)
    tables.append_owned(sets(spark, 2_000, "UKB_", 2_000), "one", "coloc_credsets", path, derive)
    tables.append_owned(sets(spark, 500, "QTD"), "two", "coloc_credsets", path, derive)
    check(spark, path)
    assert tables.read_owned(spark, "coloc_credsets", path).count() == 5_500
    tables.replace_owned(sets(spark, 40, "gp"), "one", "coloc_credsets", path, derive)
    check(spark, path)
    assert tables.read_owned(spark, "coloc_credsets", path).count() == 540
    assert read == [True] * 4  # each state is made from the files of its own load


def test_a_failed_load_leaves_the_profile(spark, folder):
    path = f"{folder}/t"
    tables.replace_owned(sets(spark, 30, "a"), "one", "coloc_credsets", path, profiled.profiled(path, VALUES, ["trait", "cell_type"]))

    def broken(rows, owner, load):
        profiled.profiled(path, VALUES, ["trait", "cell_type"])(rows, owner, load)
        raise RuntimeError("after the states")

    with pytest.raises(RuntimeError):
        tables.append_owned(sets(spark, 30, "b"), "one", "coloc_credsets", path, broken)
    check(spark, path)
    assert {r["dataset"][0] for r in profiled.stored_values(spark, path).collect()} == {"a"}


@pytest.mark.parametrize("n", [0, 1, 200, 60_000])
def test_merged_sketches_equal_one_sketch_within_the_error(spark, n):
    df = spark.range(0, n, 1, 6).select(F.col("id").cast("string").alias("a"), (F.col("id") % 77).alias("b"), F.lit(None).cast("double").alias("c"))
    halves = [states.sketches(df.filter(half), ["a", "b", "c"]) for half in ("a < '5'", "a >= '5'")]
    merged = halves[0].unionByName(halves[1])
    found = {r["column_name"]: r for r in states.merged_sketches(merged).collect()}
    one = {r["column_name"]: r["n_distinct"] for r in states.distinct_estimates(df, ["a", "b", "c"]).collect()}
    for name, exact in (("a", n), ("b", min(n, 77)), ("c", 0)):
        assert abs(found[name]["n_distinct"] - exact) <= 0.05 * exact and abs(one[name] - exact) <= 0.05 * exact
    assert found["c"]["n_null"] == n == found["a"]["n_rows"]
