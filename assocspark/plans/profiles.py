"""Counts, allowed values, audits and the data dictionary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocspark.functions.resources import Rule, rules_for
from assocspark.operators import profile, states, views
from assocspark.plans.projections import EXPECTED, resource_sql, rule_sql, view_sql
from assocspark.plans.registry import Inputs, prepared, query
from assocspark.schemas import DERIVED_COMMENTS, TABLES
from assocspark.sources import profiled, tables


@query(
    "stats_breakdown",
    "credible_sets",
    "SELECT dataset, data_type, count(*) AS n FROM credible_sets GROUP BY dataset, data_type ORDER BY n DESC, dataset, data_type",
)
def stats_breakdown(t: Inputs):
    return profile.count_by(t.view("credible_sets"), "dataset", "data_type")


@query(
    "table_counts",
    " ".join(TABLES),
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in TABLES),
)
def table_counts(t: Inputs):
    return profile.table_counts({name: t(name) for name in TABLES})


_FLAT = ("data_type", "cell_type", "most_severe", "resource")


def _values_sql(columns, source: str, parent: str | None = None) -> str:
    lead = f"{parent} AS parent_value, " if parent else ""
    known = f" AND {parent} IS NOT NULL" if parent else ""
    parts = [
        f"SELECT DISTINCT {lead}'{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {source} WHERE {c} IS NOT NULL{known}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


_CS_VIEW = f"({view_sql('credible_sets')}) v"


@query("allowed_values", "credible_sets", _values_sql(_FLAT, _CS_VIEW))
def allowed_values(t: Inputs):
    return profile.allowed_values("credible_sets", t("credible_sets"), list(_FLAT))


@query("allowed_values_by", "credible_sets", _values_sql(("data_type", "cell_type"), _CS_VIEW, "resource"))
def allowed_values_by(t: Inputs):
    return profile.allowed_values_by("credible_sets", t("credible_sets"), ["data_type", "cell_type"], "resource")


@query(
    "compact_values",
    "credible_sets",
    f"""SELECT column_name, value LIKE 'qtd%' AS is_collection, CASE WHEN value LIKE 'qtd%' THEN 'qtd' ELSE value END AS value,
  count(*) AS n_values FROM ({_values_sql(_FLAT, _CS_VIEW)}) GROUP BY 1, 2, 3""",
)
def compact_values(t: Inputs):
    values = profile.allowed_values("credible_sets", t("credible_sets"), list(_FLAT))
    return profile.compact_values(values, ["qtd"])


@query(
    "compact_values_by",
    "credible_sets",
    f"""SELECT DISTINCT CASE WHEN parent_value NOT LIKE 'qtd%' THEN parent_value END AS parent_value, parent_value LIKE 'qtd%' AS is_collection,
  column_name, value FROM ({_values_sql(("data_type",), _CS_VIEW, "resource")})""",
)
def compact_values_by(t: Inputs):
    values = profile.allowed_values_by("credible_sets", t("credible_sets"), ["data_type"], "resource")
    return profile.compact_values_by(values, ["qtd"])


_STORED = ["dataset", "data_type", "cell_type", "most_severe"]


def _three_loads(t: Inputs) -> str:
    """Credible sets as they are loaded: one owner's rows, the other's, a part of these again, and the part in place of the first."""
    path, rows = f"{t.scratch()}/credible_sets", t("credible_sets")
    derive = profiled.profiled(path, _STORED, ["trait", "cs_id", "pos", "se"])
    owned = tables.owned_rows(*tables.OWNED_DATASETS["fine_mapped"])
    tables.replace_owned(rows, "fine_mapped", "credible_sets", path, derive)
    tables.replace_owned(tables.without_owned(rows, owned), "pseudo", "credible_sets", path, derive)
    tables.append_owned(rows.filter("pip > 9e-1"), "pseudo", "credible_sets", path, derive)
    tables.replace_owned(rows.filter(owned & (F.col("pip") > 0.5)), "fine_mapped", "credible_sets", path, derive)
    return path


_OWNED_SQL = "(dataset LIKE 'QTD%' OR dataset IN ({}))".format(", ".join(f"'{d}'" for d in tables.OWNED_DATASETS["fine_mapped"][0]))
_LOADED_SQL = f"""(SELECT * FROM credible_sets WHERE NOT {_OWNED_SQL} UNION ALL SELECT * FROM credible_sets WHERE pip > 9e-1
UNION ALL SELECT * FROM credible_sets WHERE {_OWNED_SQL} AND pip > 5e-1)"""


@query(
    "stored_profile",
    "credible_sets",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n_rows FROM (SELECT *, {resource_sql('credible_sets')} AS resource FROM {_LOADED_SQL}) WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in (*_STORED, "resource")
    ),
)
def stored_profile(t: Inputs):
    """Values and their rows from the states of the loads; the rows themselves are not read again."""
    state = profiled.stored_values(t.spark, _three_loads(t))
    return states.value_counts(views.derive("credible_sets", state, ["resource"]), [*_STORED, "resource"])


@query(
    "stored_allowed_values_by",
    "credible_sets",
    _values_sql(("data_type", "cell_type"), f"(SELECT *, {resource_sql('credible_sets')} AS resource FROM {_LOADED_SQL})", "resource"),
)
def stored_allowed_values_by(t: Inputs):
    state = profiled.stored_values(t.spark, _three_loads(t))
    return profile.allowed_values_by("credible_sets", state, ["data_type", "cell_type"], "resource")


_SKETCHED = ("trait", "cs_id", "pos", "se")


@query(
    "stored_distinct_estimates",
    "credible_sets",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_exact, true AS close FROM {_LOADED_SQL}"
        for c in _SKETCHED
    ),
)
def stored_distinct_estimates(t: Inputs):
    """Estimates merged from the loads' sketches, beside exact counts of the table."""
    path = _three_loads(t)
    exact = states.distinct_counts(tables.read_owned(t.spark, "credible_sets", path), list(_SKETCHED))
    found = profiled.stored_sketches(t.spark, path).join(exact, "column_name")
    close = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.07 * F.col("n_exact")
    return found.select("column_name", "n_rows", "n_null", "n_exact", close.alias("close"))


_SIDES = [(name, d) for name in EXPECTED for d in (("dataset1", "dataset2") if name == "colocalization" else ("dataset",))]


@query(
    "mapping_audit",
    " ".join(EXPECTED),
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{d}' AS side, {d} AS dataset, count(*) AS n_rows, {resource_sql(name, d)} AS resource,
  {rule_sql(name, d)} AS rule, {rule_sql(name, d)} = '*' AS is_fallback FROM {name} GROUP BY {d}"""
        for name, d in _SIDES
    ),
)
def mapping_audit(t: Inputs):
    """Data sets of all tables whose resource follows from rules, both sides of pairs."""
    found = []
    for name, side in _SIDES:
        audit = profile.mapping_audit(t(name), rules_for(name), side).withColumnRenamed(side, "dataset")
        audit = audit.withColumn("rule", F.lower("rule"))
        found.append(audit.select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), *audit.columns))
    return reduce(DataFrame.unionByName, found)


# The mapped tables with one more rule, which an earlier one shadows.
_TRIED = {"credible_sets": "dataset", "coloc_credsets": "dataset", "open_chromatin": "dataset", "peak_to_gene": "dataset"}
_EXTRA = Rule("finngen_hla%", "finngen")


def _tried_rules(table: str) -> list[Rule]:
    *named, rest = rules_for(table)
    return [*named, _EXTRA, rest]


def _overlap_sql(table: str, dataset: str) -> str:
    """Check SQL: every data set against every pattern, the first match by row number."""
    patterns = [*(pattern.lower() for pattern, _ in EXPECTED[table]), "finngen_hla%", "*"]
    rows = ", ".join(f"({k}, '{p}')" for k, p in enumerate(patterns))
    names = ", ".join(f"'{p}'" for p in patterns)
    shadow = "CASE WHEN p.k < 0 THEN 'x' END" if "finngen%" not in patterns else "CASE WHEN p.pattern = 'finngen_hla%' THEN 'finngen%' END"
    return f"""SELECT '{table}' AS table_name, p.pattern AS rule, count(m.d) AS n_datasets, CAST(coalesce(sum(m.n), 0) AS BIGINT) AS n_rows,
  count(m.d) FILTER (m.k = m.w) AS n_won,
  coalesce((SELECT string_agg(([{names}])[w + 1], ' ' ORDER BY w) FROM (SELECT DISTINCT o.w FROM matched_{table} o WHERE o.k = p.k AND o.w <> o.k)), '') AS beaten_by,
  {shadow} AS shadowed_by
FROM (VALUES {rows}) AS p(k, pattern) LEFT JOIN matched_{table} m ON m.k = p.k GROUP BY p.k, p.pattern"""


def _matched_sql(table: str, dataset: str) -> str:
    patterns = [*(pattern.lower() for pattern, _ in EXPECTED[table]), "finngen_hla%", "*"]
    rows = ", ".join(f"({k}, '{p}')" for k, p in enumerate(patterns))
    return f"""SELECT p.k, s.d, s.n, min(p.k) OVER (PARTITION BY s.d) AS w
FROM (SELECT {dataset} AS d, count(*) AS n FROM {table} WHERE {dataset} IS NOT NULL GROUP BY 1) s JOIN (VALUES {rows}) AS p(k, pattern)
  ON p.pattern = '*' OR CASE WHEN contains(p.pattern, '%') THEN lower(s.d) LIKE p.pattern ELSE lower(s.d) = p.pattern END"""


for _name, _side in _TRIED.items():
    prepared(f"matched_{_name}", _name, _matched_sql(_name, _side))(None)


@query(
    "rule_overlaps",
    " ".join(f"matched_{name}" for name in _TRIED),
    " UNION ALL ".join(_overlap_sql(name, side) for name, side in _TRIED.items()),
)
def rule_overlaps(t: Inputs):
    """Rules that lose data sets to earlier ones, or can never win."""
    found = []
    for name, side in _TRIED.items():
        each = profile.rule_overlaps(t(name), _tried_rules(name), side).withColumn("rule", F.lower("rule"))
        found.append(each.select(F.lit(name).alias("table_name"), *each.columns))
    return reduce(DataFrame.unionByName, found)


def _dictionary_sql(table: str) -> str:
    """Check SQL: non-NULL counts per column of the view, joined to declared types and modes."""
    spec = TABLES[table]
    declared = [
        (f.name, profile._type_name(f.dataType), profile.column_mode(table, f.name), f.metadata["comment"]) for f in spec.schema
    ] + [(d, "STRING" if d != "maf" else "FLOAT64", profile.column_mode(table, d), DERIVED_COMMENTS[d]) for d in views.derived_names(table)]
    rows = ", ".join("({})".format(", ".join("'" + v.replace("'", "''") + "'" for v in d)) for d in declared)
    return f"""SELECT '{table}_v' AS view_name, n.n_rows, d.column_name, d.type, d.mode, d.description, n.n_rows - k.n_known AS n_null
FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM ({view_sql(table)})) ON COLUMNS(*) INTO NAME column_name VALUE n_known) k
JOIN (VALUES {rows}) AS d(column_name, type, mode, description) ON d.column_name = k.column_name
CROSS JOIN (SELECT count(*) AS n_rows FROM {table}) n"""


_CATEGORICAL = {
    "credible_sets": ["data_type", "resource"],
    "gene_burden_results": ["annotation", "resource"],
    "mpra": ["cell_line", "cohort", "resource"],
    "colocalization": ["data_type1", "data_type2", "resource1", "resource2"],
    "coloc_credsets": ["data_type", "resource"],
    "exome_variant_results": ["annotation", "resource"],
    "asm_qtl": ["variant_rank", "vartype", "resource"],
    "gene_annotations": ["locus_type", "strand", "resource"],
    "open_chromatin": ["tissue", "life_stage", "resource"],
    "variant_effect": ["model", "tissue", "resource"],
    "variant_annotation": ["most_severe", "resource"],
    "peak_to_gene": ["cell_type", "resource"],
    "hla_associations": ["gene", "resource"],
}
_ALLOWED_SQL = " UNION ALL ".join(
    f"SELECT '{table}_v' AS view_name, '{c}' AS column_name, count(DISTINCT {c}) AS n_allowed FROM ({view_sql(table)})"
    for table, columns in _CATEGORICAL.items()
    for c in columns
)


@query(
    "data_dictionary",
    " ".join(TABLES),
    f"""SELECT d.*, a.n_allowed FROM ({" UNION ALL ".join(_dictionary_sql(name) for name in TABLES)}) d
LEFT JOIN ({_ALLOWED_SQL}) a ON a.view_name = d.view_name AND a.column_name = d.column_name""",
)
def data_dictionary(t: Inputs):
    return profile.data_dictionary({name: t(name) for name in TABLES}, categorical=_CATEGORICAL).drop("position")


@query(
    "schema_registry",
    " ".join(TABLES),
    f"""SELECT view_name, column_name, type, mode, n_rows - n_null AS n_known, mode = 'REQUIRED' AND n_null > 0 AS violated
FROM ({" UNION ALL ".join(_dictionary_sql(name) for name in TABLES)})""",
)
def schema_registry(t: Inputs):
    """Declared type and mode per column, and whether the data keeps to it."""
    found = profile.data_dictionary({name: t(name) for name in TABLES})
    violated = (F.col("mode") == "REQUIRED") & (F.col("n_null") > 0)
    known = (F.col("n_rows") - F.col("n_null")).alias("n_known")
    return found.select("view_name", "column_name", "type", "mode", known, violated.alias("violated"))
