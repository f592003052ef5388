"""Counts, allowed values and the data dictionary.

Allowed values are rows, not arrays: each (column, value) pair is reduced on the input side
first, so neither a hot value nor a column with very many values ends up in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocspark.functions.resources import Rule, matched_rule, resource_expr, shadowed_by
from assocspark.operators.views import derive, derived_from
from assocspark.schemas import DERIVED_COMMENTS, TABLES


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Row counts per key combination, largest first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *keys)


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per table; over parquet the counts come from file footers."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def _long(df: DataFrame, columns: list[str], *ids: str) -> DataFrame:
    text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot(list(ids), columns, "column_name", "value").filter(F.col("value").isNotNull())


def _combinations(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct combinations of view columns, reduced on stored columns before any is derived.

    The rules behind ``resource`` then run once per combination instead of once per row.
    """
    sources = derived_from(table)
    stored = [c for c in columns if c not in sources]
    stored += [c for name in columns for c in sources.get(name, [])]
    reduced = df.select(*dict.fromkeys(stored)).distinct()
    return derive(table, reduced, columns).select(*dict.fromkeys(columns))


def allowed_values(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of several view columns from one scan, as (column_name, value) rows in order."""
    return _long(_combinations(table, df, columns), columns).distinct().orderBy("column_name", "value")


def allowed_values_by(table: str, df: DataFrame, columns: list[str], parent: str) -> DataFrame:
    """Distinct values of several view columns per value of a parent column."""
    named = _combinations(table, df, [*columns, parent]).withColumn("parent_value", F.col(parent).cast("string"))
    # Counting the parent drops NULL parents after the reduction; as a filter the check would
    # move down to the scan and derive the parent there once more for every row.
    groups = _long(named, columns, "parent_value").groupBy("parent_value", "column_name", "value")
    known = groups.agg(F.count("parent_value").alias("_n")).filter("_n > 0").drop("_n")
    return known.orderBy("parent_value", "column_name", "value")


def collection_of(value: Column, prefixes: list[str]) -> Column:
    """The first prefix that a value starts with in lower case, else NULL."""
    chain = F
    for prefix in prefixes:
        chain = chain.when(F.lower(value).startswith(prefix), F.lit(prefix))
    return F.lit(None).cast("string") if chain is F else chain.otherwise(F.lit(None))


def compact_values(values: DataFrame, prefixes: list[str]) -> DataFrame:
    """Allowed values with collections folded: one row per named value, one per prefix with a count."""
    tagged = values.withColumn("collection", collection_of(F.col("value"), prefixes))
    folded = tagged.withColumn("value", F.coalesce("collection", "value"))
    return (
        folded.groupBy("column_name", F.col("collection").isNotNull().alias("is_collection"), "value")
        .agg(F.count(F.lit(1)).alias("n_values"))
        .orderBy("column_name", "is_collection", "value")
    )


def compact_values_by(values: DataFrame, prefixes: list[str]) -> DataFrame:
    """Values per parent with collections folded: the members of all prefixes share one group."""
    member = collection_of(F.col("parent_value"), prefixes).isNotNull()
    folded = values.select(
        F.when(~member, F.col("parent_value")).alias("parent_value"), member.alias("is_collection"), "column_name", "value"
    )
    return folded.distinct().orderBy("is_collection", "parent_value", "column_name", "value")


def mapping_audit(df: DataFrame, rules: list[Rule], dataset: str = "dataset") -> DataFrame:
    """Each data set with its rows, its resource, the deciding rule and whether that is the rest rule."""
    counts = df.groupBy(dataset).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select(
        dataset,
        "n_rows",
        resource_expr(rules, dataset).alias("resource"),
        matched_rule(rules, dataset).alias("rule"),
        matched_rule(rules, dataset).eqNullSafe("*").alias("is_fallback"),
    )


def rule_overlaps(df: DataFrame, rules: list[Rule], dataset: str = "dataset") -> DataFrame:
    """For each rule: data sets and rows it could take, those it wins, the rules it loses to, and whether patterns alone rule it out.

    Data sets are counted before rules are tried, so each is matched once. A rule that wins nothing here loses all its data sets to
    earlier rules (``beaten_by``) or has none; ``shadowed_by`` names an earlier rule that takes whatever it could take, on any data.
    """
    tried = [(k, rule, F.lit(True) if rule.pattern == "*" else rule.matches(F.col(dataset))) for k, rule in enumerate(rules)]
    counts = df.groupBy(dataset).agg(F.count(F.lit(1)).alias("rows")).filter(F.col(dataset).isNotNull())
    taken = F.array_compact(F.array(*[F.when(match, F.lit(k)) for k, _, match in tried]))
    each = counts.withColumn("taken", taken).withColumn("winner", F.get("taken", F.lit(0)))
    each = each.select(dataset, "rows", "winner", F.explode("taken").alias("rule_no"))
    won = F.col("winner") == F.col("rule_no")
    found = each.groupBy("rule_no").agg(
        F.count(F.lit(1)).alias("n_datasets"), F.sum("rows").alias("n_rows"), F.count_if(won).alias("n_won"),
        F.array_sort(F.collect_set(F.when(~won, F.col("winner")))).alias("winners"),
    )
    shadows = dict(shadowed_by(rules))
    names = F.array(*[F.lit(rule.pattern) for rule in rules])
    listed = F.array(*[F.struct(F.lit(k).alias("rule_no"), F.lit(r.pattern).alias("rule"), F.lit(shadows.get(r.pattern)).alias("shadowed_by")) for k, r in enumerate(rules)])
    every = df.sparkSession.range(1).select(F.inline(listed))
    beaten = F.array_join(F.transform("winners", lambda w: F.get(names, w)), " ")
    return every.join(found, "rule_no", "left").select(
        "rule", F.coalesce("n_datasets", F.lit(0)).alias("n_datasets"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_won", F.lit(0)).alias("n_won"), F.coalesce(beaten, F.lit("")).alias("beaten_by"), "shadowed_by",
    )


def required_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """NULLs per required column, from one pass."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return nulls.unpivot([], required, "column_name", "n_null")


def column_mode(table: str, column: str) -> str:
    """REQUIRED, NULLABLE or REPEATED, of stored and derived columns.

    ``variant`` is required only where all its parts are, and ``resource`` always is.
    """
    spec = TABLES[table]
    if column in spec.columns:
        return spec.mode(column)
    if column == "variant":
        return "REQUIRED" if all(spec.mode(c) == "REQUIRED" for c in ("chr", "pos", "ref", "alt")) else "NULLABLE"
    return "REQUIRED" if column.startswith("resource") else "NULLABLE"


_TYPE_NAMES = {"string": "STRING", "bigint": "INT64", "double": "FLOAT64", "boolean": "BOOL", "date": "DATE"}


def _type_name(data_type: T.DataType) -> str:
    element = data_type.elementType if isinstance(data_type, T.ArrayType) else data_type
    return _TYPE_NAMES.get(element.simpleString(), element.simpleString().upper())


def data_dictionary(
    frames: dict[str, DataFrame],
    overrides: dict[tuple[str, str], str] | None = None,
    categorical: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Per view and column: type, mode, description, rows of the view, NULLs and allowed values.

    Takes the stored tables and makes one aggregate pass over each; NULLs of a derived column
    are counted from its sources. ``overrides`` gives descriptions that win over the registry's.
    ``categorical`` names columns whose distinct values are counted, for the others it is NULL.
    """
    overrides, categorical = overrides or {}, categorical or {}
    parts = [_describe(table, df, overrides) for table, df in frames.items()]
    described = reduce(DataFrame.unionByName, parts)
    counted = [
        _long(_combinations(table, frames[table], columns), columns)
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_allowed"))
        .withColumn("view_name", F.lit(f"{table}_v"))
        for table, columns in categorical.items()
    ]
    if not counted:
        return described.withColumn("n_allowed", F.lit(None).cast("bigint"))
    return described.join(reduce(DataFrame.unionByName, counted), ["view_name", "column_name"], "left")


def _describe(table: str, df: DataFrame, overrides: dict[tuple[str, str], str]) -> DataFrame:
    spec, sources = TABLES[table], derived_from(table)
    columns = [(f.name, _type_name(f.dataType), spec.schema[f.name].metadata["comment"], [f.name]) for f in df.schema]
    columns += [(n, "FLOAT64" if n == "maf" else "STRING", DERIVED_COMMENTS[n], by) for n, by in sources.items()]
    counts, entries = ["count(*) AS _rows"], []
    for i, (name, kind, comment, by) in enumerate(columns):
        complete = " AND ".join(f"`{c}` IS NOT NULL" for c in by) or "true"
        counts.append(f"count_if({complete}) AS n{i}")
        texts = (name, kind, column_mode(table, name), overrides.get((table, name), comment))
        quoted = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in texts)
        entries.append(f"struct({i}, {quoted}, _rows - n{i})")
    names = "position, column_name, type, mode, description, n_null"
    return df.selectExpr(*counts).selectExpr(
        f"'{table}_v' AS view_name", "_rows AS n_rows", f"inline(array({', '.join(entries)})) AS ({names})"
    )
