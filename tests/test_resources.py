import itertools
import random

import duckdb
import pytest

from assocspark.functions.resources import Rule, covers, matched_rule, resource, resource_expr, rules_for, shadowed_by
from assocspark.operators import profile


def mapped(spark, names, column):
    df = spark.createDataFrame([(n,) for n in names], "dataset string")
    return dict(df.select("dataset", column).collect())


GOLDEN = {
    "credible_sets": {
        "FinnGen_R13_MVP_UKBB_labs": "finngen_mvp_ukbb", "FINNGEN_r13_ukbb": "finngen_ukbb", "FinnGen_R14": "finngen",
        "UKB_PPP": "ukbb", "Open_Targets_26.06": "open_targets", "COVID19_HGI": "covid_hgi", "PGC": "pgc",
        "PGC_SCZ_2022": "pgc", "PGC_other": "pgc_other", "GP2": "gp2", "GP2b": "gp2b", "IIBDGC": "ibd_gwas", "QTD000001": "qtd000001",
    },
    "exome_variant_results": {"genebass": "genebass", "IBD_exome": "ibd_exome_2026", "IBDxexome": "ibdxexome", "SCHEMA2": "schema2"},
    "gene_burden_results": {"BipEx2": "bipex2", "ibd_EXOME": "ibd_exome_2026"},
    "asm_qtl": {"deCODE_asmQTL_CpG": "decode", "other": "other"},
    "open_chromatin": {
        "marderstein_open_chromatin": "marderstein", "li_brain_open_chromatin": "li_brain_atac", "catlas_x": "catlas",
        "epimap_x": "epimap", "calderon_x": "calderon_immune", "rosmap_x": "rosmap_brain", "New": "new",
    },
    "variant_effect": {"marderstein_flare": "marderstein", "catlas_x": "catlas_x"},
    "mpra": {"siraj_mpra": "siraj_mpra"},
    "peak_to_gene": {"FinnGen_ATACseq": "finngen", "UKB_x": "ukb_x"},
    "hla_associations": {"finngen_hla": "finngen", "FinnGen_R14": "finngen_r14"},
    "gene_annotations": {"anything": "hgnc"},
    "variant_annotation": {"anything": "finngen"},
}


@pytest.mark.parametrize("table", GOLDEN)
def test_resource_of_each_table(spark, table):
    assert mapped(spark, GOLDEN[table], resource(table)) == GOLDEN[table]


def test_rule_order_decides(spark):
    rules = [Rule("a%", "late"), Rule("ab%", "never"), Rule("*", transform="lowercase")]
    assert mapped(spark, ["ABC", "x"], resource_expr(rules)) == {"ABC": "late", "x": "x"}
    assert mapped(spark, ["ABC", "x"], matched_rule(rules)) == {"ABC": "a%", "x": "*"}


def test_without_rest_rule_the_rest_is_null(spark):
    assert mapped(spark, ["a", "b"], resource_expr([Rule("a", "r")])) == {"a": "r", "b": None}
    assert mapped(spark, ["a"], resource_expr([])) == {"a": None}


def test_underscore_is_literal_without_percent_and_a_wildcard_with_it(spark):
    rules = [Rule("a_b", "equal"), Rule("a_c%", "like")]
    assert mapped(spark, ["a_b", "aXb", "aXc"], resource_expr(rules)) == {"a_b": "equal", "aXb": None, "aXc": "like"}


def test_fixed_rest_lowercase_rule_and_table_filter(spark):
    rules = [Rule("K%", transform="lowercase"), Rule("m", "only t", applies_to=("t",)), Rule("empty"), Rule("*", "rest")]
    assert mapped(spark, ["Kx", "m", "empty"], resource_expr(rules_for("t", rules))) == {"Kx": "kx", "m": "only t", "empty": "rest"}
    assert mapped(spark, ["m"], resource_expr(rules_for("u", rules))) == {"m": "rest"}


def test_rest_rule_must_be_last():
    with pytest.raises(ValueError):
        resource_expr([Rule("*", "x"), Rule("a", "b")])


def test_patterns_that_cover_others():
    def taken(pattern, name):
        return name == pattern if "%" not in pattern else duckdb.execute("SELECT ? LIKE ?", [name, pattern]).fetchone()[0]

    rng = random.Random(8)
    names = ["".join(p) for n in range(6) for p in itertools.product("ab_", repeat=n)]
    for _ in range(300):
        wide, narrow = ("".join(rng.choice("ab%%_") for _ in range(rng.randrange(1, 5))) for _ in range(2))
        held = all(taken(wide, n) for n in names if taken(narrow, n))
        assert covers(wide, narrow) <= held, (wide, narrow)
        if held and "_" not in wide + narrow:
            assert covers(wide, narrow), (wide, narrow)
    assert covers("finngen%", "FinnGen%ukbb%") and covers("*", "x") and not covers("x%", "*") and not covers("finngen%ukbb%", "finngen%")


def test_rules_that_never_win(spark):
    rules = [Rule("a%", "x"), Rule("ab%", "y"), Rule("c", "z"), Rule("%b", "w"), Rule("*", transform="lowercase")]
    assert shadowed_by(rules) == [("ab%", "a%")]
    sets = spark.createDataFrame([("AB",)] * 3 + [("c",), ("zb",), ("q",), (None,)], "dataset string")
    found = {r["rule"]: tuple(r)[1:] for r in profile.rule_overlaps(sets, rules).collect()}
    assert found == {
        "a%": (1, 3, 1, "", None), "ab%": (1, 3, 0, "a%", "a%"), "c": (1, 1, 1, "", None), "%b": (2, 4, 1, "a%", None),
        "*": (4, 6, 1, "a% c %b", None),
    }
