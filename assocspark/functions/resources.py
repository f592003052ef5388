"""Ordered dataset-to-resource rules, compiled to one Column."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern`` holds ``%`` for a LIKE match, else it must equal the data set; ``*`` is the rest."""

    pattern: str
    resource: str | None = None
    transform: str | None = None
    applies_to: tuple[str, ...] | None = None

    def matches(self, dataset: Column) -> Column:
        lowered = F.lower(dataset)
        wanted = self.pattern.lower()
        return lowered.like(wanted) if "%" in wanted else lowered == F.lit(wanted)


_MAPPED = ("credible_sets", "colocalization", "coloc_credsets")
_EXOME = ("exome_variant_results", "gene_burden_results")

# Data set pattern, resource, tables. The first match wins, so the order counts.
RULES: tuple[Rule, ...] = (
    Rule("finngen%mvp_ukbb%", "finngen_mvp_ukbb", applies_to=_MAPPED),
    Rule("finngen%ukbb%", "finngen_ukbb", applies_to=_MAPPED),
    Rule("finngen%", "finngen", applies_to=_MAPPED + ("peak_to_gene",)),
    Rule("finngen_hla%", "finngen", applies_to=("hla_associations",)),
    Rule("ukb%", "ukbb", applies_to=_MAPPED),
    Rule("open_targets%", "open_targets", applies_to=_MAPPED),
    Rule("covid19_hgi%", "covid_hgi", applies_to=_MAPPED),
    Rule("pgc", "pgc", applies_to=_MAPPED),
    Rule("pgc_scz%", "pgc", applies_to=_MAPPED),
    Rule("gp2", "gp2", applies_to=_MAPPED),
    Rule("iibdgc", "ibd_gwas", applies_to=_MAPPED),
    Rule("genebass", "genebass", applies_to=_EXOME),
    Rule("IBD_exome", "ibd_exome_2026", applies_to=_EXOME),
    Rule("deCODE%", "decode", applies_to=("asm_qtl",)),
    Rule("marderstein%", "marderstein", applies_to=("open_chromatin", "variant_effect")),
    Rule("li_brain%", "li_brain_atac", applies_to=("open_chromatin",)),
    Rule("catlas%", "catlas", applies_to=("open_chromatin",)),
    Rule("epimap%", "epimap", applies_to=("open_chromatin",)),
    Rule("calderon%", "calderon_immune", applies_to=("open_chromatin",)),
    Rule("rosmap%", "rosmap_brain", applies_to=("open_chromatin",)),
    Rule("siraj_mpra%", "siraj_mpra", applies_to=("mpra",)),
    Rule("*", transform="lowercase"),
)

# Resource of the tables that come from a single source.
CONSTANT_RESOURCES = {"gene_annotations": "hgnc", "variant_annotation": "finngen"}


def rules_for(table: str, rules: Iterable[Rule] = RULES) -> list[Rule]:
    return [r for r in rules if r.applies_to is None or table in r.applies_to]


def _first_match(rules: Iterable[Rule], dataset: Column, value_of) -> Column:
    """CASE over the rules; without a ``*`` rule the rest is NULL."""
    chain, fallback = F, F.lit(None).cast("string")
    for position, rule in enumerate(rules := list(rules)):
        if rule.pattern == "*":
            if position != len(rules) - 1:
                raise ValueError("the * rule must come last")
            fallback = value_of(rule)
        elif rule.resource is not None or rule.transform == "lowercase":
            chain = chain.when(rule.matches(dataset), value_of(rule))
    return fallback if chain is F else chain.otherwise(fallback)


def resource_expr(rules: Iterable[Rule], dataset: Column | str = "dataset") -> Column:
    column = F.col(dataset) if isinstance(dataset, str) else dataset

    def value(rule: Rule) -> Column:
        lowered = rule.resource is None or (rule.pattern == "*" and rule.transform == "lowercase")
        return F.lower(column) if lowered else F.lit(rule.resource)

    return _first_match(rules, column, value)


def matched_rule(rules: Iterable[Rule], dataset: Column | str = "dataset") -> Column:
    """Pattern of the rule that decided, for audits."""
    column = F.col(dataset) if isinstance(dataset, str) else dataset
    return _first_match(rules, column, lambda rule: F.lit(rule.pattern))


def resource(table: str, dataset: Column | str = "dataset", rules: Iterable[Rule] = RULES) -> Column:
    if table in CONSTANT_RESOURCES:
        return F.lit(CONSTANT_RESOURCES[table])
    return resource_expr(rules_for(table, rules), dataset)


def _signs(pattern: str) -> list[tuple[str, str]]:
    """A pattern as signs: any number of characters, any one, or a given one."""
    if pattern == "*":
        return [("many", "")]
    kinds = {"%": "many", "_": "one"} if "%" in pattern else {}
    return [(kinds.get(c, "this"), c) for c in pattern.lower()]


def covers(wider: str, narrower: str) -> bool:
    """Whether every data set that the second pattern takes is taken by the first one, by the patterns alone."""
    wide = _signs(wider)

    def through(places: set[int]) -> set[int]:
        """With the places that follow without taking a character."""
        out = set(places)
        for at in places:
            while at < len(wide) and wide[at][0] == "many":
                at += 1
                out.add(at)
        return out

    reach = through({0})  # places in the wide pattern where a beginning of the narrow one can end
    for kind, character in _signs(narrower):
        stay = {at for at in reach if at < len(wide) and wide[at][0] == "many"}
        fits = {("one", "_"), ("this", character)} if kind == "this" else {("one", "_")} if kind == "one" else set()
        reach = through(stay | {at + 1 for at in reach if at < len(wide) and wide[at] in fits})
    return len(wide) in reach


def shadowed_by(rules: Iterable[Rule]) -> list[tuple[str, str]]:
    """(rule, earlier rule that takes all it could) pairs: such a rule can never win."""
    rules = list(rules)
    pairs = ((rule, next((e for e in rules[:k] if covers(e.pattern, rule.pattern)), None)) for k, rule in enumerate(rules))
    return [(rule.pattern, earlier.pattern) for rule, earlier in pairs if earlier is not None]
