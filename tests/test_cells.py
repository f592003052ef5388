"""Joins of keys with very many pairs: whole, and dealt over tasks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from assocspark.operators import cells, intervals, joins
from conftest import plan_of


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def sides(spark):
    """Keys of few and many rows on either side or both, null keys, copies of rows."""
    left = [(k, "x", i % 7 if k == "copies" else i) for k, n in {"both": 30, "left": 200, "right": 1, "few": 2, "alone": 90, "copies": 40}.items() for i in range(n)]
    right = [(k, "x", float(i % 3)) for k, n in {"both": 25, "left": 1, "right": 300, "few": 3, "copies": 20, "other": 70}.items() for i in range(n)]
    left, right = left + [(None, "x", i) for i in range(20)], right + [("both", None, 0.5)] * 20 + [(None, "x", 0.5)] * 20
    return left, right, spark.createDataFrame(left, "k string, v string, l long"), spark.createDataFrame(right, "k string, v string, r double")


@pytest.mark.parametrize("strategy", [None, "shuffle_hash"])
def test_cut_keys_make_each_pair_once(spark, monkeypatch, strategy):
    monkeypatch.setattr(cells, "SIDE", 4)
    monkeypatch.setattr(cells, "TASK", 100)
    left, right, lefts, rights = sides(spark)
    joined = cells.join(lefts, rights, ["k", "v"], strategy)
    assert joined.columns == ["k", "v", "l", "r"] and "_cell" in plan_of(joined)
    found = Counter(map(tuple, joined.collect()))
    assert found == Counter((k, v, i, j) for k, v, i in left for m, w, j in right if k is not None and v is not None and (k, v) == (m, w))


def test_only_the_keys_of_most_pairs_are_cut(spark, monkeypatch):
    monkeypatch.setattr(cells, "SIDE", 4)
    monkeypatch.setattr(cells, "MOST", 2)
    left, right, lefts, rights = sides(spark)
    assert [r["k"] for r in cells.heavy_keys(lefts, rights, ["k", "v"])] == ["copies", "both"]
    assert cells.join(lefts, rights, ["k", "v"]).count() == 30 * 25 + 200 + 300 + 2 * 3 + 40 * 20


def test_a_grid_has_about_square_cells_and_few_stripes_for_a_short_side():
    assert cells.grid(2_000, 1_000, 500) == (4, 2)
    assert cells.grid(1, 1_000_000, 500) == (1, 4) and cells.grid(1_000_000, 1, 500) == (4, 1)
    assert cells.grid(400, 1_250, 500) == (1, 2)


def test_pairs_of_one_large_set_are_dealt_over_tasks(spark, no_broadcast):
    """One set of 2,500 members in 2,500 pairs is few bytes and 6 million rows. Its name is no constant, else the join is a plain product."""
    pairs = spark.range(2_500).selectExpr("'d' AS dataset1", "'c' || id % 1 AS cs1_id", "'e' AS dataset2", "'o' AS cs2_id", "id / 1e4 AS PP_H4_abf")
    sets = spark.range(2_500).selectExpr("'d' AS dataset", "'c' || id % 1 AS cs_id", "1L AS chr", "id AS pos", "'A' AS ref", "'G' AS alt", "0.5D AS pip")
    tasks = [r["count"] for r in joins.colocalized_members(pairs, sets).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 2_500**2 and len(tasks) >= 3 and max(tasks) < 2_500**2 / 2


def test_sets_of_few_pairs_are_joined_as_they_are(spark):
    pairs = spark.range(300).selectExpr("'d' AS dataset1", "'c' || id AS cs1_id", "'e' AS dataset2", "'o' AS cs2_id", "0.1D AS PP_H4_abf")
    sets = spark.range(900).selectExpr("'d' AS dataset", "'c' || id % 300 AS cs_id", "1L AS chr", "id AS pos", "'A' AS ref", "'G' AS alt", "0.5D AS pip")
    joined = joins.colocalized_members(pairs, sets)
    assert "_cell" not in plan_of(joined) and joined.count() == 900


def test_overlaps_of_one_place_are_dealt_over_tasks(spark, no_broadcast):
    """A place with 2,500 regions and 2,500 peaks is one bin of 6 million pairs; a second place is met as before."""
    regions = spark.range(2_501).selectExpr("id % 1 + 1 AS chr", "IF(id = 0, 900000, 100) AS ls", "IF(id = 0, 900000, 100) + 200 AS le")
    peaks = spark.range(2_501).selectExpr("id % 1 + 1 AS chr", "IF(id = 0, 900000, 150) AS rs", "IF(id = 0, 900000, 150) + 50 + id % 50 AS re")
    joined = intervals.overlapping(regions, peaks, F.col("ls"), F.col("le"), F.col("rs"), F.col("re"))
    assert joined.columns == ["chr", "ls", "le", "rs", "re"]
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 2_500**2 + 1 and max(tasks) < 2_500**2 / 2
