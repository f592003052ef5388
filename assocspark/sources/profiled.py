"""Profiles of owned tables: what is distinct in each load, kept beside it and merged for an answer.

Allowed values, values per parent and counts per group need only the distinct combinations of a few categorical columns, and counts
of distinct values of other columns only a sketch. Both are mergeable, so each is made once, from the files of a load when it is
written, and stored under the load's name. An answer reads the states of the published loads, not the table. An append adds a
state; a replacement leaves the old load's state unread together with its rows; a writer that fails publishes neither.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from assocspark.operators import states
from assocspark.sources import tables

# Beside the folders of owners; readers of Parquet skip such names.
_PROFILES = "_profiles"


def _state_path(path: str, kind: str, owner: str, load: str) -> str:
    return f"{path}/{_PROFILES}/{kind}/owner={owner}/load={load}"


def profiled(path: str, values: list[str], sketched: list[str]) -> tables.Derive:
    """For ``replace_owned`` and ``append_owned``: keeps combinations of ``values`` and sketches of ``sketched``."""

    def derive(rows: DataFrame, owner: str, load: str) -> None:
        states.combinations(rows, values).write.parquet(_state_path(path, "values", owner, load))
        if sketched:
            states.sketches(rows, sketched).write.parquet(_state_path(path, "sketches", owner, load))

    return derive


def _read(spark: SparkSession, path: str, kind: str, loads: Iterable[tuple[str, str]]) -> DataFrame:
    folders = [_state_path(path, kind, owner, load) for owner, load in loads]
    if not folders:
        raise ValueError(f"{path} has no published loads")
    # loads may have been profiled with other columns, so each is read with its own schema
    frames = [spark.read.parquet(folder) for folder in folders]
    if len({tuple(f.dtypes) for f in frames}) == 1:
        return spark.read.parquet(*folders)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stored_values(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """Distinct combinations of the profiled columns over all published loads, with ``n_rows``."""
    return states.merged_combinations(_read(spark, path, "values", tables.published_loads(spark, path, version)))


def stored_sketches(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """column_name, n_rows, n_null and n_distinct (estimated) over all published loads."""
    return states.merged_sketches(_read(spark, path, "sketches", tables.published_loads(spark, path, version)))
