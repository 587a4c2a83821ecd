"""Queries over labelled notes, and the reports of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlelabels.operators.hybrid import OUTPUT_SCHEMA
from titlelabels.rulepack import RULES, Rule, rule_table
from titlelabels.taxonomy import ROLE, TYPE, Settings, taxonomy_table


def notes_by_role(labelled: DataFrame, role: str) -> DataFrame:
    return labelled.filter(F.array_contains("note_roles", role))


def notes_by_type_source(labelled: DataFrame, note_type: str, source: str) -> DataFrame:
    return labelled.filter(F.array_contains("note_types", note_type) & (F.col("clf_source") == source))


def source_mix(labelled: DataFrame) -> DataFrame:
    """``clf_source, n_notes, share``."""
    per_source = labelled.groupBy("clf_source").agg(F.count(F.lit(1)).alias("n_notes"))
    # The window sees one row per source.
    total = F.sum("n_notes").over(Window.partitionBy())
    return per_source.withColumn("share", F.round(F.col("n_notes") / total, 4))


def rule_audit(labelled: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``rule_id, tag, n_notes`` for every rule, rules that never fired included."""
    # Equal hit lists are counted first, so few rows are taken apart.
    lists = labelled.groupBy("rule_hits").agg(F.count(F.lit(1)).alias("n"))
    # The outer forms below keep the optimizer from filtering the labelled rows by a recomputed array.
    fired = lists.select(F.explode_outer("rule_hits").alias("tag"), "n").groupBy("tag").agg(F.sum("n").alias("n_fired"))
    return (
        rule_table(labelled.sparkSession, rules)
        .select("rule_id", "tag")
        .join(fired, "tag", "left")
        .select("rule_id", "tag", F.coalesce("n_fired", F.lit(0)).alias("n_notes"))
    )


def role_type_matrix(labelled: DataFrame) -> DataFrame:
    """``role, note_type, n_notes``; a note counts once for each of its pairs."""
    lists = labelled.groupBy("note_roles", "note_types").agg(F.count(F.lit(1)).alias("n"))
    pairs = (
        lists.select(F.explode_outer("note_roles").alias("role"), "note_types", "n")
        .select("role", F.explode_outer("note_types").alias("note_type"), "n")
        .filter(F.col("role").isNotNull() & F.col("note_type").isNotNull())
    )
    return pairs.groupBy("role", "note_type").agg(F.sum("n").alias("n_notes"))


def unlabelled_titles(labelled: DataFrame, title_col: str = "note_title") -> DataFrame:
    """``title, no_role, no_type, n_notes`` for titles without a label in some dimension."""
    no_role, no_type = F.size("note_roles") == 0, F.size("note_types") == 0
    return (
        labelled.filter(no_role | no_type)
        .groupBy(F.col(title_col).alias("title"), no_role.alias("no_role"), no_type.alias("no_type"))
        .agg(F.count(F.lit(1)).alias("n_notes"))
    )


def label_use(labelled: DataFrame) -> DataFrame:
    """Taxonomy with the number of notes per label: ``dim, ord, label, n_notes``."""
    lists = labelled.groupBy("note_roles", "note_types").agg(F.count(F.lit(1)).alias("n"))
    both = F.array(
        F.struct(F.lit(ROLE).alias("dim"), F.col("note_roles").alias("labels")),
        F.struct(F.lit(TYPE).alias("dim"), F.col("note_types").alias("labels")),
    )
    used = (
        lists.select("n", F.inline(both))
        .select("n", "dim", F.explode_outer("labels").alias("label"))
        .groupBy("dim", "label")
        .agg(F.sum("n").alias("used"))
    )
    return (
        taxonomy_table(labelled.sparkSession)
        .join(used, ["dim", "label"], "left")
        .select("dim", "ord", "label", F.coalesce("used", F.lit(0)).alias("n_notes"))
    )


def run_manifest(
    labelled: DataFrame, model: str, rules: tuple[Rule, ...] = RULES, settings: Settings = Settings()
) -> DataFrame:
    """One row: the parameters of the run and the number of notes it labelled."""
    spark = labelled.sparkSession
    labels = taxonomy_table(spark)
    count_of = lambda dim: labels.filter(F.col("dim") == dim).agg(F.count(F.lit(1))).scalar()
    return labelled.agg(F.count(F.lit(1)).alias("n_notes")).select(
        F.lit(settings.rule_conf_thresh).alias("rule_conf_thresh"),
        F.lit(settings.emb_conf_thresh).alias("emb_conf_thresh"),
        rule_table(spark, rules).agg(F.count(F.lit(1))).scalar().alias("n_rules"),
        count_of(ROLE).alias("n_role_labels"),
        count_of(TYPE).alias("n_type_labels"),
        F.lit(model).alias("model"),
        "n_notes",
    )


def field_types(labelled: DataFrame) -> DataFrame:
    """``ord, field, type, n_notes``: the fields of the result and how often each is set."""
    names = OUTPUT_SCHEMA.fieldNames()
    value = lambda f: F.col("classification")[f]
    counted = labelled.agg(*[F.count(value(f)).alias(f) for f in names])
    types = dict(labelled.select("classification.*").dtypes)
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("ord"), F.lit(f).alias("field"), F.lit(types[f]).alias("type"), F.col(f).alias("n_notes"))
            for i, f in enumerate(names)
        ]
    )
    return counted.select(F.inline(rows))


def _padded(text: Column, width: int) -> Column:
    """Padded on the right to ``width``; longer text is kept whole."""
    return F.when(F.char_length(text) < width, F.rpad(text, width, " ")).otherwise(text)


def _list_text(labels: Column) -> Column:
    return F.when(F.size(labels) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.array_join(labels, "', '"), F.lit("']"))
    )


def _number(value: Column, width: int) -> Column:
    """Three decimals, rounded from the exact binary value, aligned right."""
    return F.lpad(F.format_number(F.round(value.cast("double"), 4), 3), width, " ")


# Names and widths of the report's columns; texts are aligned left, numbers right.
REPORT_TEXTS = (("TITLE", 45), ("ROLES", 30), ("TYPES", 40), ("SOURCE", 18))
REPORT_NUMBERS = (("R_CONF", 6), ("T_CONF", 6))
REPORT_RULE_WIDTH = 155

REPORT_HEADER = " ".join([name.ljust(n) for name, n in REPORT_TEXTS] + [name.rjust(n) for name, n in REPORT_NUMBERS])
REPORT_RULE = "-" * REPORT_RULE_WIDTH


def report_lines(scored: DataFrame) -> DataFrame:
    """Fixed-width lines (``title, line``) for a frame of scored titles."""
    title_width = REPORT_TEXTS[0][1]
    texts = [
        F.substring(F.coalesce("title", F.lit("")), 1, title_width - 1),
        _list_text(F.col("roles")),
        _list_text(F.col("note_types")),
        F.col("classification_source"),
    ]
    padded = [_padded(text, n) for text, (_, n) in zip(texts, REPORT_TEXTS, strict=True)]
    numbers = [_number(F.col(c), n) for c, (_, n) in zip(("role_confidence", "note_type_confidence"), REPORT_NUMBERS, strict=True)]
    return scored.select("title", F.concat_ws(" ", *padded, *numbers).alias("line"))
