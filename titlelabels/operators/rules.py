"""Stage 1: weighted phrase rules.

Every rule is one literal search inside a single expression: no shuffle, no
Python, and the same expression works in select, filter and on streams.
Intermediate values are bound with ``let``, so the expression grows with the
number of rules only, also when the optimizer copies it into a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelabels.functions.text import fold_title, let, literal, pattern_literal
from titlelabels.rulepack import RULES, Rule, any_pattern, pack_labels, rule_pattern
from titlelabels.taxonomy import DIMS, Settings

# Rules are searched in runs of this many: one pattern tells whether any rule of
# the run can fire, and only then are its members searched one by one.
RUN_LENGTH = 8

WEIGHTS = "array<struct<label:string,weight:double>>"

# The result of a title on which no rule fires.
_NONE = "cast(array() AS array<string>)"
NOTHING = f"""named_struct('roles', {_NONE}, 'note_types', {_NONE}, 'role_confidence', 0.0D, 'type_confidence', 0.0D,
    'rule_hits', {_NONE}, 'fired', cast(array() AS array<struct<rule_id:int,tag:string>>),
    'role_weights', cast(array() AS {WEIGHTS}), 'type_weights', cast(array() AS {WEIGHTS}))"""


def search(text: str, rules: tuple[Rule, ...]) -> str:
    """Array of booleans, one per rule; ``text`` is a folded title."""
    parts = []
    for i in range(0, len(rules), RUN_LENGTH):
        run = rules[i : i + RUN_LENGTH]
        members = ", ".join(f"{text} RLIKE {pattern_literal(rule_pattern(r))}" for r in run)
        none = ", ".join("false" for _ in run)
        parts.append(
            f"CASE WHEN {text} RLIKE {pattern_literal(any_pattern(run))} THEN array({members}) ELSE array({none}) END"
        )
    return f"flatten(array({', '.join(parts)}))"


def fired_rules(hits: str, rules: tuple[Rule, ...]) -> str:
    """``struct<rule_id, tag>`` of the fired rules in rule order."""
    items = [
        f"CASE WHEN {hits}[{n}] THEN named_struct('rule_id', {r.rule_id}, 'tag', {literal(r.tag)}) END"
        for n, r in enumerate(rules)
    ]
    return f"array_compact(array({', '.join(items)}))"


def label_weight(hits: str, rules: tuple[Rule, ...], dim: str, label: str) -> str:
    """Weights of one label added left to right in rule order.

    The order matters: doubles that add up in another order can fall on the
    other side of the band (see tests). A rule that did not fire adds 0.0,
    which changes nothing.
    """
    terms = [f"if({hits}[{n}], {r.weight}D, 0.0D)" for n, r in enumerate(rules) if label in r.labels(dim)]
    return " + ".join(["0.0D", *terms])


def weighed_labels(hits: str, rules: tuple[Rule, ...], dim: str) -> str:
    """``struct<label, weight>`` of the labels that got any weight."""
    items = [
        f"named_struct('label', {literal(x)}, 'weight', {label_weight(hits, rules, dim, x)})"
        for x in pack_labels(rules, dim)
    ]
    return f"filter(cast(array({', '.join(items)}) AS {WEIGHTS}), w -> w.weight > 0)"


def top_weight(weights: str) -> str:
    return f"coalesce(array_max(transform({weights}, w -> w.weight)), 0.0D)"


def confidence(weights: str, settings: Settings) -> str:
    """Largest label weight, capped and rounded; 0.0 when no rule fired."""
    return f"round(least({top_weight(weights)}, {settings.cap}D), {settings.digits})"


def banded(weights: str, settings: Settings) -> str:
    """Labels inside the band below the top weight (before the cap), in alphabetical order."""
    kept = f"array_sort(transform(filter({weights}, w -> w.weight >= floor), w -> w.label))"
    return let("floor", f"{settings.band_ratio}D * {top_weight(weights)}", kept)


def rule_sql(title: str, rules: tuple[Rule, ...] = RULES, settings: Settings = Settings()) -> str:
    """Stage 1 as one SQL expression, see :func:`rule_struct`."""
    weighed = ", ".join(
        ["named_struct('fired', " + fired_rules("hits", rules)]
        + [f"'{dim}', {weighed_labels('hits', rules, dim)}" for dim in DIMS]
    )
    result = f"""named_struct(
        'roles', {banded("s.role", settings)},
        'note_types', {banded("s.type", settings)},
        'role_confidence', {confidence("s.role", settings)},
        'type_confidence', {confidence("s.type", settings)},
        'rule_hits', transform(s.fired, f -> f.tag),
        'fired', s.fired, 'role_weights', s.role, 'type_weights', s.type)"""
    # Most titles of a long tail fire nothing: neither weights nor lists are built for them.
    fired = f"CASE WHEN exists(hits, hit -> hit) THEN {let('s', weighed + ')', result)} ELSE {NOTHING} END"
    scored = let("hits", search("text", rules), fired)
    return let("text", f"coalesce({fold_title(title)}, '')", scored)


def rule_struct(title: str, rules: tuple[Rule, ...] = RULES, settings: Settings = Settings()) -> Column:
    """Stage 1 as one Column; ``title`` is a column name or any SQL expression.

    ``struct<roles, note_types, role_confidence, type_confidence, rule_hits>``
    plus ``fired`` (rule ids and tags) and ``role_weights``, ``type_weights``
    (``label, weight`` of the labels that got any). A null title fires nothing.
    """
    return F.expr(rule_sql(title, rules, settings))


def with_rules(
    df: DataFrame, title_col: str, rules: tuple[Rule, ...] = RULES, settings: Settings = Settings()
) -> DataFrame:
    """Add the struct of :func:`rule_struct` as column ``rules``."""
    return df.withColumn("rules", rule_struct(title_col, rules, settings))


def _taken_apart(df: DataFrame, structs: Column, field: str) -> DataFrame:
    """One row per struct of an array; rows with an empty array are dropped.

    The outer form is used on purpose: for the plain one the optimizer infers a
    filter on the array, which repeats the whole rule stage, below any
    aggregation even for every single row.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    out = df.select(*keep, structs.alias("_structs")).select(*keep, F.inline_outer("_structs"))
    return out.filter(F.col(field).isNotNull())


def rule_hits(df: DataFrame, title_col: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per (row of ``df``, fired rule): the input columns, ``rule_id`` and ``tag``."""
    return _taken_apart(df, rule_struct(title_col, rules)["fired"], "rule_id")


def label_weights(df: DataFrame, title_col: str, dim: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per (row of ``df``, label with weight): the input columns, ``label`` and ``weight``."""
    return _taken_apart(df, rule_struct(title_col, rules)[f"{dim}_weights"], "weight")
