"""Derived columns, resources, identifiers, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from assocspark.functions import clean
from assocspark.functions.resources import CONSTANT_RESOURCES, Rule, matched_rule, resource, resource_expr, rules_for
from assocspark.operators import results, views
from assocspark.plans.prepared import chrom_sql
from assocspark.plans.registry import Inputs, query
from assocspark.schemas import TABLES

VARIANT_SQL = "chr || ':' || pos || ':' || ref || ':' || alt"


_MAPPED = (
    ("finngen%mvp_ukbb%", "finngen_mvp_ukbb"), ("finngen%ukbb%", "finngen_ukbb"), ("finngen%", "finngen"), ("ukb%", "ukbb"),
    ("open_targets%", "open_targets"), ("covid19_hgi%", "covid_hgi"), ("pgc", "pgc"), ("pgc_scz%", "pgc"), ("gp2", "gp2"), ("iibdgc", "ibd_gwas"),
)
_EXOME = (("genebass", "genebass"), ("ibd_exome", "ibd_exome_2026"))

# What each view is expected to make of a data set, first match first; other names in lower case. This is
# written out here so that the check does not depend on the rules it checks.
EXPECTED: dict[str, tuple[tuple[str, str], ...]] = {
    "credible_sets": _MAPPED,
    "colocalization": _MAPPED,
    "coloc_credsets": _MAPPED,
    "exome_variant_results": _EXOME,
    "gene_burden_results": _EXOME,
    "asm_qtl": (("decode%", "decode"),),
    "open_chromatin": (
        ("marderstein%", "marderstein"), ("li_brain%", "li_brain_atac"), ("catlas%", "catlas"), ("epimap%", "epimap"),
        ("calderon%", "calderon_immune"), ("rosmap%", "rosmap_brain"),
    ),
    "variant_effect": (("marderstein%", "marderstein"),),
    "mpra": (("siraj_mpra%", "siraj_mpra"),),
    "peak_to_gene": (("finngen%", "finngen"),),
    "hla_associations": (("finngen_hla%", "finngen"),),
}
EXPECTED_CONSTANTS = {"gene_annotations": "hgnc", "variant_annotation": "finngen"}

# The derived columns expected of each view, {..} for a resource.
_MAF = "CASE WHEN {0} < 1 - {0} THEN {0} ELSE 1 - {0} END AS maf"
EXPECTED_COLUMNS = {
    "credible_sets": f"{VARIANT_SQL} AS variant, {_MAF.format('aaf')}, {{dataset}} AS resource",
    "colocalization": "{dataset1} AS resource1, {dataset2} AS resource2",
    "coloc_credsets": f"{VARIANT_SQL} AS variant, {{dataset}} AS resource",
    "exome_variant_results": f"{VARIANT_SQL} AS variant, {{dataset}} AS resource",
    "gene_burden_results": "{dataset} AS resource",
    "asm_qtl": f"{VARIANT_SQL} AS variant, {_MAF.format('af')}, {{dataset}} AS resource",
    "gene_annotations": "{dataset} AS resource",
    "open_chromatin": "{dataset} AS resource",
    "variant_effect": "{dataset} AS resource",
    "mpra": "{dataset} AS resource",
    "variant_annotation": "{dataset} AS resource",
    "peak_to_gene": "{dataset} AS resource",
    "hla_associations": "{dataset} AS resource",
}


def _case(table: str, dataset: str, values: dict[str, str] | None = None, rest: str | None = None) -> str:
    """Check SQL: a CASE over the expected patterns of a table, in order."""
    whens = [
        f"WHEN lower({dataset}) {'LIKE' if '%' in pattern else '='} '{pattern}' THEN '{values[pattern] if values else value}'"
        for pattern, value in EXPECTED[table]
    ]
    return f"CASE {' '.join(whens)} ELSE {rest or f'lower({dataset})'} END"


def resource_sql(table: str, dataset: str = "dataset") -> str:
    """Check SQL of a resource."""
    return f"'{EXPECTED_CONSTANTS[table]}'" if table in EXPECTED_CONSTANTS else _case(table, dataset)


def rule_sql(table: str, dataset: str = "dataset") -> str:
    """Check SQL of the pattern that decided, ``*`` for none."""
    return _case(table, dataset, {pattern: pattern for pattern, _ in EXPECTED[table]}, "'*'")


def view_sql(table: str) -> str:
    """Check SQL of a view."""
    names = {d: resource_sql(table, d) for d in ("dataset", "dataset1", "dataset2")}
    return f"SELECT *, {EXPECTED_COLUMNS[table].format(**names)} FROM {table}"


def _register_view(table: str) -> None:
    @query(f"view_{table}", table, view_sql(table))
    def build(t: Inputs):
        return results.stringify(t.view(table)) if table == "gene_annotations" else t.view(table)


for _table in views.DERIVED:
    _register_view(_table)


def _register_resource(table: str, dataset: str) -> None:
    @query(
        f"resource_{table}",
        table,
        f"SELECT {dataset}, {resource_sql(table, dataset)} AS resource, count(*) AS n FROM {table} GROUP BY 1, 2",
    )
    def build(t: Inputs):
        counts = t(table).groupBy(dataset).agg(F.count(F.lit(1)).alias("n"))
        return counts.select(dataset, resource(table, dataset).alias("resource"), "n")


for _table in (
    "credible_sets", "coloc_credsets", "exome_variant_results", "gene_burden_results", "asm_qtl", "open_chromatin",
    "variant_effect", "mpra", "peak_to_gene", "hla_associations",
):
    _register_resource(_table, "dataset")


@query(
    "resource_pair",
    "colocalization",
    f"""SELECT dataset1, dataset2, {resource_sql('colocalization', 'dataset1')} AS resource1,
  {resource_sql('colocalization', 'dataset2')} AS resource2, count(*) AS n FROM colocalization GROUP BY 1, 2, 3, 4""",
)
def resource_pair(t: Inputs):
    pairs = t("colocalization").groupBy("dataset1", "dataset2").agg(F.count(F.lit(1)).alias("n"))
    return views.derive("colocalization", pairs)


@query(
    "resource_constant",
    "gene_annotations variant_annotation",
    """SELECT 'gene_annotations' AS table_name, 'hgnc' AS resource, count(*) AS n FROM gene_annotations
UNION ALL SELECT 'variant_annotation', 'finngen', count(*) FROM variant_annotation""",
)
def resource_constant(t: Inputs):
    def counted(table):
        counts = t.view(table).groupBy("resource").agg(F.count(F.lit(1)).alias("n"))
        return counts.select(F.lit(table).alias("table_name"), "resource", "n")

    return counted("gene_annotations").unionByName(counted("variant_annotation"))


CUSTOM_RULES = (
    Rule("ukb_ppp", "proteins", applies_to=("credible_sets",)),
    Rule("ukb_ppp", "never", applies_to=("colocalization",)),
    Rule("pgc%", transform="lowercase"),
    Rule("pgc_scz_2022", "too late"),
    Rule("*", "other"),
)


@query(
    "rule_compile",
    "credible_sets",
    """SELECT dataset, CASE WHEN lower(dataset) = 'ukb_ppp' THEN 'proteins' WHEN lower(dataset) LIKE 'pgc%' THEN lower(dataset)
  ELSE 'other' END AS resource, CASE WHEN lower(dataset) = 'ukb_ppp' THEN 'ukb_ppp' WHEN lower(dataset) LIKE 'pgc%' THEN 'pgc%'
  ELSE '*' END AS rule, count(*) AS n FROM credible_sets GROUP BY ALL""",
)
def rule_compile(t: Inputs):
    rules = rules_for("credible_sets", CUSTOM_RULES)
    counts = t("credible_sets").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("dataset", resource_expr(rules).alias("resource"), matched_rule(rules).alias("rule"), "n")


@query("variant_id", "asm_qtl", f"SELECT chr, pos, ref, alt, {VARIANT_SQL} AS variant FROM asm_qtl")
def variant_id(t: Inputs):
    return t("asm_qtl").select("chr", "pos", "ref", "alt", clean.variant_id().alias("variant"))


@query("maf", "credible_sets", "SELECT aaf, CASE WHEN aaf < 1 - aaf THEN aaf ELSE 1 - aaf END AS maf FROM credible_sets")
def maf(t: Inputs):
    return t("credible_sets").select("aaf", clean.minor_allele_frequency("aaf").alias("maf"))


@query("chrom_code_load", "open_chromatin_raw", f"SELECT chrom, {chrom_sql('chrom')} AS chr FROM open_chromatin_raw")
def chrom_code_load(t: Inputs):
    return t("open_chromatin_raw").select("chrom", clean.chromosome_code("chrom").alias("chr"))


@query(
    "chrom_code_strict",
    "open_chromatin_raw",
    """SELECT chrom, CASE WHEN code BETWEEN 1 AND 26 THEN code END AS chr FROM (SELECT chrom,
  CASE bare WHEN 'X' THEN 23 WHEN 'Y' THEN 24 WHEN 'M' THEN 25 WHEN 'MT' THEN 25
    ELSE CASE WHEN regexp_full_match(bare, '[0-9]+') THEN CAST(bare AS BIGINT) END END AS code
  FROM (SELECT chrom, upper(regexp_replace(trim(chrom), '^chr', '', 'i')) AS bare FROM open_chromatin_raw))""",
)
def chrom_code_strict(t: Inputs):
    padded = F.concat(F.lit("\t"), "chrom", F.lit(" "))
    return t("open_chromatin_raw").select("chrom", clean.chromosome_code_strict(padded).alias("chr"))


@query("strip_cell_type", "peak_to_gene_raw", "SELECT peak_id, substr(cell_type, 20) AS cell_type FROM peak_to_gene_raw")
def strip_cell_type(t: Inputs):
    return t("peak_to_gene_raw").select("peak_id", clean.strip_cell_type("cell_type").alias("cell_type"))


@query(
    "strip_version",
    "hgnc",
    "SELECT ensembl_gene_id AS versioned, regexp_replace(ensembl_gene_id, '[.].*', '') AS gene_id FROM hgnc",
)
def strip_version(t: Inputs):
    return t("hgnc").select(F.col("ensembl_gene_id").alias("versioned"), clean.strip_version("ensembl_gene_id").alias("gene_id"))


@query(
    "canonical_id",
    "hgnc gene_has_family",
    """SELECT hgnc_id AS given, hgnc_id AS canonical FROM hgnc
UNION ALL SELECT lower(hgnc_id), hgnc_id FROM hgnc UNION ALL SELECT hgnc_id, 'HGNC:' || hgnc_id FROM gene_has_family""",
)
def canonical_id(t: Inputs):
    given = t("hgnc").select("hgnc_id").union(t("hgnc").select(F.lower("hgnc_id"))).union(t("gene_has_family").select("hgnc_id"))
    return given.select(F.col("hgnc_id").alias("given"), clean.canonical_gene_id("hgnc_id").alias("canonical"))


@query(
    "clean_pipe",
    "hgnc",
    "SELECT alias_symbol AS given, translate(nullif(alias_symbol, ''), '\"', '') AS cleaned FROM hgnc",
)
def clean_pipe(t: Inputs):
    return t("hgnc").select(F.col("alias_symbol").alias("given"), clean.clean_pipe("alias_symbol").alias("cleaned"))


@query(
    "variant_parts",
    "colocalization",
    """SELECT hit2, CASE WHEN hit2 LIKE '%:%' THEN CAST(split_part(hit2, ':', 1) AS BIGINT) END AS hit_chr,
  CASE WHEN hit2 LIKE '%:%' THEN TRY_CAST(split_part(hit2, ':', 2) AS BIGINT) END AS hit_pos FROM colocalization""",
)
def variant_parts(t: Inputs):
    return t("colocalization").select(
        "hit2", clean.variant_chromosome("hit2").alias("hit_chr"), clean.variant_position("hit2").alias("hit_pos")
    )


@query(
    "stringify",
    "gene_annotations",
    "SELECT symbol, chr, gene_group_ids, gene_group_names, download_date FROM gene_annotations",
)
def stringify(t: Inputs):
    return results.stringify(
        t("gene_annotations").select("symbol", "chr", "gene_group_ids", "gene_group_names", "download_date")
    )


@query(
    "register_views",
    " ".join(TABLES),
    " UNION ALL ".join(
        f"SELECT '{name}{end}' AS name, count(*) AS n, count({column}) AS n_known FROM ({view_sql(name)})"
        for name in TABLES
        for end in ("", "_v")
        for column in ("resource1" if name == "colocalization" else "resource",)
    ),
)
def register_views(t: Inputs):
    """SQL text over all tables: both names of a table give its view."""
    existing = {v.name for v in t.spark.catalog.listTables() if v.isTemporary}
    views.register(t.spark, {name: t(name) for name in TABLES})
    names = [f"{name}{end}" for name in TABLES for end in ("", "_v")]
    texts = [
        f"SELECT '{n}' AS name, count(*) AS n, count({'resource1' if n.startswith('colocalization') else 'resource'}) AS n_known FROM {n}"
        for n in names
    ]
    answer = t.spark.sql(" UNION ALL ".join(texts))
    for name in set(names) - existing:
        t.spark.catalog.dropTempView(name)
    return answer
