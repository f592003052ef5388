"""The documented questions over single tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from assocspark.functions.resources import rules_for
from assocspark.operators import lookups, results
from assocspark.plans.projections import resource_sql
from assocspark.plans.registry import Inputs, query

_CODING = "most_severe IN ('missense_variant', 'frameshift_variant', 'stop_gained')"


@query("filter_coding", "credible_sets", f"SELECT dataset, cs_id, chr, pos, ref, alt, pip, most_severe FROM credible_sets WHERE pip > 5e-1 AND {_CODING}")
def filter_coding(t: Inputs):
    found = lookups.coding_variants(t("credible_sets"))
    return found.select("dataset", "cs_id", "chr", "pos", "ref", "alt", "pip", "most_severe")


@query(
    "genes_multi_coding",
    "credible_sets",
    f"""SELECT gene_most_severe, count(*) AS n FROM credible_sets WHERE pip > 5e-1 AND {_CODING}
GROUP BY gene_most_severe HAVING count(*) > 2 ORDER BY n DESC, gene_most_severe""",
)
def genes_multi_coding(t: Inputs):
    return lookups.genes_with_many_coding(t.view("credible_sets"))


@query("strong_coloc", "colocalization", "SELECT * FROM colocalization WHERE PP_H4_abf > 9e-1")
def strong_coloc(t: Inputs):
    return lookups.strong_colocalizations(t("colocalization"))


@query(
    "coloc_either_side",
    "colocalization",
    "SELECT * FROM colocalization WHERE trait1 = 'G26' OR coalesce(trait2, '') = 'G26'",
)
def coloc_either_side(t: Inputs):
    return lookups.colocalizations_of(t("colocalization"), "G26")


_VARIANTS = ["22:22:G:A", "4:362:G:A", "11:20:A:G", "18:418:G:A", "16:12:A:G", "7:409:C:T", "99:1:A:G"]


@query(
    "variants_in_list",
    "variant_annotation",
    f"SELECT variant, rsid, most_severe, gene_most_severe, AF, INFO FROM variant_annotation WHERE variant IN ({', '.join(repr(v) for v in _VARIANTS)})",
)
def variants_in_list(t: Inputs):
    found = lookups.variants_in_list(t("variant_annotation"), _VARIANTS)
    return found.select("variant", "rsid", "most_severe", "gene_most_severe", "AF", "INFO")


@query(
    "coding_in_gene",
    "variant_annotation",
    f"""SELECT variant, rsid, most_severe, AF FROM variant_annotation WHERE gene_most_severe = 'G20' AND {_CODING}
ORDER BY AF DESC, variant""",
)
def coding_in_gene(t: Inputs):
    found = t("variant_annotation").filter(
        (F.col("gene_most_severe") == "G20") & F.col("most_severe").isin(*lookups.CODING)
    )
    return found.select("variant", "rsid", "most_severe", "AF").orderBy(F.col("AF").desc(), "variant")


_EXOME = "chr, pos, ref, alt, annotation, trait, mlog10p, beta"


@query(
    "coloc_in_region",
    "colocalization",
    """SELECT dataset1, dataset2, trait1, trait2, region_start_min, region_end_max, PP_H4_abf FROM colocalization
WHERE chr = 3 AND region_start_min <= 25000 AND region_end_max >= 5000""",
)
def coloc_in_region(t: Inputs):
    found = lookups.in_region(t("colocalization"), 3, 5_000, 25_000, "region_start_min", "region_end_max")
    return found.select("dataset1", "dataset2", "trait1", "trait2", "region_start_min", "region_end_max", "PP_H4_abf")


@query(
    "variants_in_region",
    "credible_sets",
    "SELECT dataset, cs_id, pos, ref, alt, pip FROM credible_sets WHERE chr = 3 AND pos BETWEEN 5000 AND 25000",
)
def variants_in_region(t: Inputs):
    found = lookups.in_region(t("credible_sets"), 3, 5_000, 25_000, "pos")
    return found.select("dataset", "cs_id", "pos", "ref", "alt", "pip")


@query(
    "peaks_in_region",
    "open_chromatin",
    "SELECT peak_start, peak_end, dataset, tissue FROM open_chromatin WHERE chr = 3 AND peak_start < 200000 AND peak_end >= 10000",
)
def peaks_in_region(t: Inputs):
    found = lookups.peaks_in_region(t("open_chromatin"), 3, 10_000, 200_000)
    return found.select("peak_start", "peak_end", "dataset", "tissue")


@query(
    "exome_gene",
    "exome_variant_results",
    f"""SELECT {_EXOME} FROM exome_variant_results WHERE gene = 'G17'
ORDER BY mlog10p DESC, chr, pos, ref, alt, annotation, trait, beta LIMIT 100""",
)
def exome_gene(t: Inputs):
    found = lookups.exome_of_gene(t("exome_variant_results"), "G17")
    return lookups.top(found, "mlog10p", 100, "chr", "pos", "ref", "alt", "annotation", "trait", "beta")


_BURDEN = "gene, trait, annotation, mlog10p_burden, beta"


@query("burden_significant", "gene_burden_results", f"SELECT {_BURDEN} FROM gene_burden_results WHERE mlog10p_burden > 5")
def burden_significant(t: Inputs):
    return lookups.significant_burden(t("gene_burden_results"))


@query(
    "top_hits",
    "gene_burden_results",
    f"""SELECT {_BURDEN} FROM gene_burden_results WHERE mlog10p_burden > 5
ORDER BY mlog10p_burden DESC NULLS LAST, gene, trait, annotation, beta LIMIT 100""",
)
def top_hits(t: Inputs):
    found = lookups.significant_burden(t("gene_burden_results"))
    return lookups.top(found, "mlog10p_burden", 100, "gene", "trait", "annotation", "beta")


@query("genes_in_group", "gene_annotations", "SELECT symbol, chr, gene_start, gene_end FROM gene_annotations WHERE regexp_matches(gene_group_ids, '\\b12\\b')")
def genes_in_group(t: Inputs):
    return lookups.genes_in_group(t.view("gene_annotations"), 12)


@query(
    "genes_excluding_group",
    "gene_annotations",
    "SELECT symbol, gene_group_names FROM gene_annotations WHERE gene_group_names NOT LIKE '%''ASIA''%'",
)
def genes_excluding_group(t: Inputs):
    found = lookups.genes_outside_group(t.view("gene_annotations"), "ASIA")
    return results.stringify(found.select("symbol", "gene_group_names"))


@query(
    "trait_lookup",
    "credible_sets",
    """SELECT DISTINCT trait, trait_original FROM credible_sets
WHERE lower(trait) LIKE '%g3%' OR lower(trait_original) LIKE '%g3%'""",
)
def trait_lookup(t: Inputs):
    return lookups.traits_matching(t("credible_sets"), "g3")


@query(
    "lead_variant",
    "credible_sets",
    """SELECT dataset, cs_id, chr, pos, ref, alt, pip, mlog10p FROM credible_sets
QUALIFY row_number() OVER (PARTITION BY dataset, cs_id
  ORDER BY pip DESC NULLS LAST, mlog10p DESC NULLS LAST, chr, pos, ref, alt) = 1""",
)
def lead_variant(t: Inputs):
    return lookups.lead_variants(t("credible_sets").select("dataset", "cs_id", "chr", "pos", "ref", "alt", "pip", "mlog10p"))


_HLA = "phenotype, gene, allele, mlogp, info"


@query(
    "phewas_allele",
    "hla_associations",
    f"""SELECT {_HLA} FROM hla_associations WHERE allele = 'B*25:01' AND mlogp > 7.3e0 AND info >= 5e-1
ORDER BY mlogp DESC, phenotype""",
)
def phewas_allele(t: Inputs):
    return lookups.phenotypes_of_allele(t("hla_associations"), "B*25:01").select(*_HLA.split(", "))


@query(
    "alleles_of_trait",
    "hla_associations",
    f"""SELECT {_HLA} FROM hla_associations WHERE phenotype = 'PH7' AND mlogp > 7.3e0 AND info >= 5e-1
ORDER BY mlogp DESC, allele""",
)
def alleles_of_trait(t: Inputs):
    return lookups.alleles_of_phenotype(t("hla_associations"), "PH7").select(*_HLA.split(", "))


@query(
    "reporter_effects",
    "mpra",
    "SELECT variant, emVar, log2Skew FROM mpra WHERE cell_line = 'meta' AND emVar",
)
def reporter_effects(t: Inputs):
    return lookups.reporter_effects(t("mpra"), "meta").filter("emVar").select("variant", "emVar", "log2Skew")


@query(
    "resource_filter",
    "credible_sets",
    f"""SELECT dataset, cs_id, chr, pos, pip FROM (SELECT *, {resource_sql('credible_sets')} AS resource FROM credible_sets)
WHERE resource = 'finngen'""",
)
def resource_filter(t: Inputs):
    rules = rules_for("credible_sets")
    found = lookups.filter_by_resource(t("credible_sets"), rules, "finngen")
    return found.select("dataset", "cs_id", "chr", "pos", "pip")


@query(
    "sample_rows",
    "credible_sets",
    """SELECT count(*) AS n_rows, count(*) AS n_in_view FROM (SELECT * FROM credible_sets LIMIT 10)""",
)
def sample_rows(t: Inputs):
    """Any rows will do, so the answer is how many there are, and how many of them the view has."""
    view = t.view("credible_sets")
    keys = ["dataset", "cs_id", "variant", "pip", "trait_original"]
    sample = results.sample_rows(view.select(*keys), 10).withColumn("row", F.monotonically_increasing_id())
    found = sample.join(view.select(*keys), keys, "left_semi")
    counts = found.agg(F.count_distinct("row").alias("n_in_view"))
    return sample.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", counts.scalar().alias("n_in_view"))


@query(
    "capped_result",
    "colocalization",
    """SELECT dataset1, dataset2, hit1, hit2, PP_H4_abf, (SELECT count(*) FROM colocalization WHERE PP_H4_abf > 5e-1) AS total_rows,
  (SELECT count(*) > 200 FROM colocalization WHERE PP_H4_abf > 5e-1) AS truncated
FROM colocalization WHERE PP_H4_abf > 5e-1 ORDER BY PP_H4_abf DESC, dataset1, dataset2, hit1, hit2 LIMIT 200""",
)
def capped_result(t: Inputs):
    columns = ["dataset1", "dataset2", "hit1", "hit2", "PP_H4_abf"]
    answer = lookups.strong_colocalizations(t("colocalization"), 0.5).select(*columns)
    return results.capped(answer, 200, [F.col("PP_H4_abf").desc(), *columns[:-1]])


@query(
    "empty_answer",
    "colocalization",
    """SELECT CAST(NULL AS VARCHAR) AS dataset1, CAST(NULL AS VARCHAR) AS hit1, count(*) AS total_rows, count(*) > 200 AS truncated
FROM colocalization WHERE PP_H4_abf > 2""",
)
def empty_answer(t: Inputs):
    """No rows, but a total of none."""
    found = lookups.strong_colocalizations(t("colocalization"), 2.0)
    return results.capped(found.select("dataset1", "hit1"), 200)


_GENES_SQL = """SELECT v.resource, v.gene_most_severe, count(*) AS n_variants, count(DISTINCT v.variant) AS n_sites, max(v.maf) AS top_maf,
  g.download_date FROM {credible_sets} v JOIN gene_annotations g ON g.symbol = v.gene_most_severe AND g.chr = v.chr
WHERE v.pip > 5e-1 GROUP BY v.resource, v.gene_most_severe, g.download_date"""
_GENES_ORDER = "n_variants DESC, gene_most_severe, resource"


@query(
    "sql_answer",
    "credible_sets gene_annotations",
    f"""SELECT *, count(*) OVER () AS total_rows, count(*) OVER () > 150 AS truncated
FROM ({_GENES_SQL.format(credible_sets=f"(SELECT *, {resource_sql('credible_sets')} AS resource, least(aaf, 1 - aaf) AS maf, chr || ':' || pos || ':' || ref || ':' || alt AS variant FROM credible_sets)")})
ORDER BY {_GENES_ORDER} LIMIT 150""",
)
def sql_answer(t: Inputs):
    """SQL text over views, by view and by base name, with cap, total and flag."""
    frames = {name: t(name) for name in ("credible_sets", "gene_annotations")}
    order = [F.col("n_variants").desc(), "gene_most_severe", "resource"]
    return results.ask(t.spark, frames, _GENES_SQL.format(credible_sets="credible_sets_v"), 150, order)
