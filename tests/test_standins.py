"""Spark's own texts of stand-ins, against the texts that they stand for."""

import re

import pytest

from assocspark.plans import profiles, standins
from assocspark.plans.registry import Inputs
from assocspark.sources import tables

LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture()
def lines(spark, folder):
    rows = [(key * 7, key, key % 11, key % 7, 1.5 * key, 2.0, 0.05, 0.02, "A", "O", None) for key in range(-30, 700)]
    rows += rows[40:80] + [(5, 9_999_991 + key, 3, 2, 1.0, 2.0, 0.1, 0.0, "A", "O", None) for key in range(13)]
    rows += [tuple(None if at == gap else value for at, value in enumerate(rows[50])) for gap in range(11)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("name", ["credible_sets", "dense_credible_sets"])
def test_short_text_gives_the_rows_and_types_of_the_plain_one(spark, lines, name):
    t = Inputs(spark, lines)
    plain = spark.sql(standins.as_template(standins.STANDINS[name]), lineitem=t("lineitem"))
    assert t(name).dtypes == plain.dtypes and plain.count() > 700
    assert t(name).exceptAll(plain).isEmpty() and plain.exceptAll(t(name)).isEmpty()


def test_code_of_each_load_is_short_enough_to_be_compiled(spark, lines, monkeypatch, capsys):
    loads = []

    def kept(new, owner, table, path, derive):
        loads.append(new)

    monkeypatch.setattr(tables, "replace_owned", kept)
    monkeypatch.setattr(tables, "append_owned", kept)
    profiles._three_loads(Inputs(spark, lines))
    assert len(loads) == 4
    for new in loads:
        tables.described(new, "credible_sets").explain("codegen")
        sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) <= 8_000
