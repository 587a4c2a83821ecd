"""Both stages merged: gates, routing, labels, confidences, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlelabels.functions.text import is_blank, let
from titlelabels.operators.rules import rule_sql
from titlelabels.operators.similarity import score_map, similarity_sql
from titlelabels.rulepack import RULES, Rule
from titlelabels.sources.encoders import Encoder
from titlelabels.taxonomy import UNKNOWN, Settings

_STRINGS = T.ArrayType(T.StringType())
_SCORES = T.MapType(T.StringType(), T.FloatType())

# Names, order and types of the result.
OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("roles", _STRINGS),
        T.StructField("note_types", _STRINGS),
        T.StructField("role_confidence", T.FloatType()),
        T.StructField("note_type_confidence", T.FloatType()),
        T.StructField("classification_source", T.StringType()),
        T.StructField("rule_hits", _STRINGS),
        T.StructField("embedding_role_scores", _SCORES),
        T.StructField("embedding_type_scores", _SCORES),
    ]
)


def role_done(rules: str, settings: Settings = Settings()) -> str:
    """Gate of the role dimension: the rules alone decide it."""
    return f"({rules}.role_confidence >= {settings.rule_conf_thresh}D)"


def type_done(rules: str, settings: Settings = Settings()) -> str:
    return f"({rules}.type_confidence >= {settings.rule_conf_thresh}D)"


def needs_vector(title: str, rules: str, settings: Settings = Settings()) -> str:
    """Whether a title goes to stage 2: it has text and fails a gate."""
    return f"(NOT {is_blank(title)} AND NOT ({role_done(rules, settings)} AND {type_done(rules, settings)}))"


def merged_labels(done: str, by_rules: str, by_vector: str) -> str:
    """Rule labels past the gate; else stage-2 labels; else the rule labels after all."""
    return f"CASE WHEN {done} OR size({by_vector}) = 0 THEN {by_rules} ELSE {by_vector} END"


def merged_confidence(done: str, by_rules: str, by_vector: str) -> str:
    """Unlike the labels, the confidence never falls back to the rules below the gate."""
    return f"CASE WHEN {done} THEN {by_rules} ELSE {by_vector} END"


def source_name(role: str, kind: str) -> str:
    """Provenance, from the two gates alone."""
    return f"CASE WHEN {role} AND {kind} THEN 'RULES' WHEN {role} OR {kind} THEN 'RULES+EMBEDDING' ELSE 'EMBEDDING' END"


def _result(values: list[str]) -> str:
    """Result struct; numbers are narrowed to float here and nowhere before."""
    fields = zip(values, OUTPUT_SCHEMA.fields, strict=True)
    return f"named_struct({', '.join(f"'{f.name}', cast({v} AS {f.dataType.simpleString()})" for v, f in fields)})"


def blank_result() -> str:
    """Result of a title without text."""
    unknown = f"array('{UNKNOWN}')"
    return _result([unknown, unknown, "0.0D", "0.0D", "'EMPTY'", "array()", "map()", "map()"])


def merged(rules: str, found: str, settings: Settings = Settings()) -> str:
    """Result of a title with text, from ``rule_sql`` and ``similarity_sql``."""
    role, kind = role_done(rules, settings), type_done(rules, settings)
    return _result(
        [
            merged_labels(role, f"{rules}.roles", f"{found}.role_labels"),
            merged_labels(kind, f"{rules}.note_types", f"{found}.type_labels"),
            merged_confidence(role, f"{rules}.role_confidence", f"{found}.role_confidence"),
            merged_confidence(kind, f"{rules}.type_confidence", f"{found}.type_confidence"),
            source_name(role, kind),
            f"{rules}.rule_hits",
            score_map(f"{found}.role_scores", settings),
            score_map(f"{found}.type_scores", settings),
        ]
    )


def classification(title: str, rules: str, vector: str, library: str, settings: Settings, sparse: bool) -> str:
    """The result struct of one title; without a vector, stage 2 finds nothing."""
    found = let("found", similarity_sql(vector, library, settings, sparse), merged(rules, "found", settings))
    return f"CASE WHEN {is_blank(title)} THEN {blank_result()} ELSE {found} END"


def with_classification(
    df: DataFrame,
    title_col: str,
    encoder: Encoder,
    library: Column,
    rules: tuple[Rule, ...] = RULES,
    settings: Settings = Settings(),
    out: str = "classification",
    known: str | None = None,
) -> DataFrame:
    """Add the result struct to every row, computed on the row itself.

    Where column ``known`` holds a result, that is taken; neither such rows nor blank titles evaluate any rule.
    """
    work = df.withColumn("__library", library)
    first = rule_sql(title_col, rules, settings)
    if encoder.per_row:
        vector = f"CASE WHEN {needs_vector(title_col, 'rul', settings)} THEN {encoder.sql(title_col)} END"
        found = let("found", similarity_sql("vec", "__library", settings, encoder.sparse), merged("rul", "found", settings))
        lazy = f"WHEN {is_blank(title_col)} THEN {blank_result()} ELSE {let('rul', first, let('vec', vector, found))} END"
        given = f"WHEN {known} IS NOT NULL THEN {known} " if known else ""
        return work.withColumn(out, F.expr(f"CASE {given}{lazy}")).drop("__library")
    work = work.withColumn("__rules", F.expr(first))
    work = encoder.add_vectors(work, title_col, "__vector", needs_vector(title_col, "__rules", settings))
    result = classification(title_col, "__rules", "__vector", "__library", settings, encoder.sparse)
    return work.withColumn(out, F.expr(result)).drop("__library", "__rules", "__vector")
