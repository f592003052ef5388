"""Queries on few groups and places: every row of a folded key meets every other one."""

import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def dense(spark, tmp_path_factory):
    """Lines, orders and parts whose keys are 312 groups or 500 places apart."""
    base = str(tmp_path_factory.mktemp("dense"))
    lines = spark.range(60).selectExpr(
        "id * 500 + 3 AS l_orderkey", "id % 6 * 312 + 1 AS l_partkey", "1L AS l_suppkey", "CAST(id % 2 + 1 AS INT) AS l_linenumber",
        "1D AS l_quantity", "0.05D AS l_discount", "0.02D AS l_tax",
    )
    orders = spark.range(20).selectExpr(
        "id * 6500 + 3 AS o_orderkey", "id % 4 * 312 + 1 AS o_custkey", "'F' AS o_orderstatus", "'1-URGENT' AS o_orderpriority", "100D AS o_totalprice",
    )
    parts = spark.range(10).selectExpr("id * 3500 + 505 AS p_partkey", "CAST(3 AS INT) AS p_size", "900D AS p_retailprice")
    for name, rows in {"lineitem": lines, "orders": orders, "part": parts}.items():
        rows.coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return base


def test_members_of_folded_sets_all_meet(spark, dense):
    found = entry.queries()["coloc_members"](spark, dense).collect()
    sides = [r["side"] for r in found]
    # 20 pairs of set CS1 with the set 24 * 3 further; all 60 lines are members of CS1
    assert sides.count(1) == 20 * 60 and sides.count(2) == 0
    assert {(r["cs1_id"], r["cs2_id"]) for r in found} == {("CS1", "CS73")}


def test_regions_and_peaks_of_shared_places_all_meet(spark, dense):
    found = entry.queries()["region_overlap"](spark, dense).collect()
    assert len(found) == 20 * 10 and {(r["region_start_min"], r["peak_start"]) for r in found} == {(3_000, 5_000)}
