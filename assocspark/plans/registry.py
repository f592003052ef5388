"""Registry of the queries: the Spark callable next to its check SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from assocspark.operators import views
from assocspark.plans.standins import SOURCES, SPARK_TEXTS, STANDINS, as_template, inputs_of
from assocspark.session import scratch_dir


class Inputs:
    """Input frames of one run, built on demand: stored tables, stand-ins, prepared tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in SOURCES:
            return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))
        if name in PREPARED:
            return PREPARED[name].build(self)
        text = SPARK_TEXTS.get(name) or STANDINS[name]
        return self.spark.sql(as_template(text), **{n: self(n) for n in inputs_of(text)})

    def place(self, name: str, keys: list[str], partitions: int) -> None:
        """Deal the rows of an input by hash of its keys, for the inputs made from it later."""
        self._frames[name] = self(name).repartition(partitions, *keys)

    def view(self, table: str) -> DataFrame:
        return views.view(table, self(table))

    def scratch(self) -> str:
        return scratch_dir(self.spark)


@dataclass(frozen=True)
class Prepared:
    """A table made from stand-ins by operators, and the same in check SQL."""

    build: Callable[[Inputs], DataFrame]
    needs: tuple[str, ...]
    sql: str


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    needs: tuple[str, ...]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Inputs(spark, folder))

    def oracle(self) -> str | None:
        return None if self.sql is None else _with_inputs(self.needs, self.sql)


PREPARED: dict[str, Prepared] = {}
QUERIES: dict[str, Query] = {}


def prepared(name: str, needs: str, sql: str):
    def add(build):
        PREPARED[name] = Prepared(build, tuple(needs.split()), sql)
        return build

    return add


def query(name: str, needs: str, sql: str | None = None):
    def add(build):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(name, build, tuple(needs.split()), sql)
        return build

    return add


def _with_inputs(needs: tuple[str, ...], sql: str) -> str:
    """Check SQL with the texts of its inputs as leading WITH items."""
    items: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in items or name in SOURCES:
            return
        text = PREPARED[name].sql if name in PREPARED else STANDINS[name]
        for other in PREPARED[name].needs if name in PREPARED else inputs_of(text):
            visit(other)
        items[name] = text

    for name in needs:
        visit(name)
    head = ",\n".join(f"{name} AS ({text.strip()})" for name, text in items.items())
    return f"WITH {head}\n{sql.strip()}" if head else sql.strip()
