"""Spark side of every registered query: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from querybook import fixtures as fx
from querybook import letters
from titlelabels.anchors import anchor_json, anchor_table
from titlelabels.functions.text import is_blank, upper_title
from titlelabels.functions.vectors import norm
from titlelabels.operators.centroids import centroid_library, label_centroids
from titlelabels.operators.classify import Labeller, Limits, answers, classify_notes, distinct_titles, score_titles
from titlelabels.operators.hybrid import (
    merged_confidence,
    merged_labels,
    needs_vector,
    role_done,
    source_name,
    type_done,
)
from titlelabels.operators.rules import label_weights, rule_hits, rule_struct, with_rules
from titlelabels.operators.similarity import score_map, top_k, with_similarity
from titlelabels.plans import reports
from titlelabels.plans.labelling import clustered_notes, label_notes, layout_weights, run
from titlelabels.rulepack import rule_table
from titlelabels.session import shared_folder
from titlelabels.sources import published
from titlelabels.sources.encoders import HashedTokens, ModelVectors, VectorColumn, VectorTable, normalised
from titlelabels.sources.notes import eligible_notes, has_class, has_status, scan_notes
from titlelabels.sources.sinks import cluster_by_labels, layout_report, write_notes
from titlelabels.taxonomy import DIMS, ROLE, TYPE, Settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VECTOR_SETTINGS = Settings(emb_conf_thresh=fx.VECTOR_THRESHOLD)
SAMPLE_TITLES = (  # fixed values
    "NURSING PROGRESS NOTE",
    "DISCHARGE SUMMARY",
    "PHYSICAL THERAPY EVALUATION",
    "SOCIAL WORK CONSULTATION",
    "PHYSICIAN H&P",
)


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


def joined(labels: str | Column) -> Column:
    return F.array_join(labels, "|")


def rounded(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double"), 4)


def composed_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct composed titles and their number of notes: ``title, n``."""
    return distinct_titles(fx.composed_notes(spark, folder), "note_title")


# --- reading and filtering -------------------------------------------------------------


@query("scan_notes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan_notes(spark, f"{folder}/orders.parquet")
    return fx.as_notes(orders)


@query("filter_status")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fx.notes(spark, folder).filter(has_status()).select("note_id", "status")


@query("filter_inpatient")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fx.notes(spark, folder).filter(has_class()).select("note_id", "patient_class")


@query("eligible_notes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return eligible_notes(fx.notes(spark, folder))


@query("blank_titles")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fx.notes(spark, folder).filter(F.expr(is_blank("note_title"))).select("note_id", "note_title")


@query("title_upper")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fx.composed_notes(spark, folder).select("note_id", F.expr(upper_title("note_title")).alias("title_upper"))


# --- data tables, with their use by the notes -------------------------------------------


@query("rule_catalog")
def _(spark: SparkSession, folder: str) -> DataFrame:
    fired = (
        rule_hits(composed_titles(spark, folder), "title").groupBy("rule_id").agg(F.sum("n").alias("fired"))
    )
    return (
        rule_table(spark)
        .join(fired, "rule_id", "left")
        .select(
            "rule_id",
            "tag",
            joined("phrases").alias("phrases"),
            "veto",
            joined("roles").alias("roles"),
            joined("note_types").alias("note_types"),
            "weight",
            F.coalesce("fired", F.lit(0)).alias("n_notes"),
        )
    )


@query("label_taxonomy")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.label_use(classify_notes(fx.composed_notes(spark, folder)))


@query("anchor_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    phrases = anchor_table(spark).groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n_phrases"))
    vectors = fx.anchor_vectors(spark, folder).groupBy("dim", "label").agg(F.count(F.lit(1)).alias("n"))
    return phrases.join(vectors, ["dim", "label"], "left").select(
        "dim", "label", "n_phrases", F.coalesce("n", F.lit(0)).alias("n_vectors")
    )


@query("anchor_export")
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = fx.anchor_vectors(spark, folder).groupBy("dim").agg(F.count(F.lit(1)).alias("n_vectors"))
    return anchor_json(anchor_table(spark)).join(vectors, "dim").select("dim", "json", "n_vectors")


@query("run_manifest")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.run_manifest(label_notes(fx.notes(spark, folder)), "hashed-tokens-256")


# --- stage 1 ---------------------------------------------------------------------------


@query("rule_hits_long")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rule_hits(composed_titles(spark, folder), "title").select("title", "rule_id", "tag", "n")


@query("rule_hits_array")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ruled = with_rules(composed_titles(spark, folder), "title")
    return ruled.select("title", joined("rules.rule_hits").alias("tags"), F.size("rules.rule_hits").alias("n_tags"))


@query("role_weights")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return label_weights(composed_titles(spark, folder), "title", ROLE).select(
        "title", "label", rounded("weight").alias("weight")
    )


@query("type_weights")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return label_weights(composed_titles(spark, folder), "title", TYPE).select(
        "title", "label", rounded("weight").alias("weight")
    )


@query("rule_confidence")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ruled = with_rules(composed_titles(spark, folder), "title")
    return ruled.select("title", "rules.role_confidence", "rules.type_confidence").toDF(
        "title", "role_conf", "type_conf"
    )


@query("band_labels")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ruled = with_rules(composed_titles(spark, folder), "title")
    return ruled.select("title", joined("rules.roles").alias("roles"), joined("rules.note_types").alias("types"))


@query("apply_rules")
def _(spark: SparkSession, folder: str) -> DataFrame:
    titles = distinct_titles(fx.notes(spark, folder), "note_title")
    s = titles.select("title", "n", rule_struct("title").alias("s"))
    return s.select(
        "title",
        "n",
        joined("s.roles").alias("roles"),
        joined("s.note_types").alias("types"),
        F.col("s.role_confidence").alias("role_conf"),
        F.col("s.type_confidence").alias("type_conf"),
        joined("s.rule_hits").alias("tags"),
    )


# --- stage 2 ---------------------------------------------------------------------------


def vector_library(spark: SparkSession, folder: str) -> Column:
    return centroid_library(label_centroids(fx.anchor_vectors(spark, folder)))


def exploded(df: DataFrame, key: str, value: Callable[[str], Column]) -> DataFrame:
    """One row per entry of the arrays that ``value(dim)`` gives for both dimensions."""
    per_dim = F.array(*[F.struct(F.lit(d).alias("dim"), value(d).alias("entries")) for d in DIMS])
    return df.select(key, F.inline(per_dim)).select(
        key, "dim", F.posexplode_outer("entries").alias("pos", "e")
    ).filter(F.col("pos").isNotNull())


@query("l2_normalize")
def _(spark: SparkSession, folder: str) -> DataFrame:
    vectors = fx.read(spark, folder, "embeddings").select("vec_id", fx.scaled_vector().alias("embedding"))
    length = rounded(F.expr(norm("embedding"))).alias("length")
    unit = normalised(vectors.withColumn("length", length), "embedding")
    return unit.select("vec_id", "length", F.posexplode_outer("embedding").alias("pos", "x")).select(
        "vec_id", "length", "pos", rounded("x").alias("x")
    )


def _centroid_rows(spark: SparkSession, folder: str, renormalise: bool) -> DataFrame:
    c = label_centroids(fx.anchor_vectors(spark, folder), renormalise)
    return c.select("dim", "label", F.posexplode("c").alias("pos", "x")).withColumn("x", rounded("x"))


@query("label_centroids")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _centroid_rows(spark, folder, False)


@query("label_centroids_unit")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _centroid_rows(spark, folder, True)


@query("encode_titles")
def _(spark: SparkSession, folder: str) -> DataFrame:
    encoded = HashedTokens().add_vectors(composed_titles(spark, folder), "title", "v")
    entries = encoded.select("title", F.inline_outer("v")).filter(F.col("i").isNotNull())
    return entries.select("title", F.col("i").alias("bucket"), rounded("x").alias("x"))


def _similar(spark: SparkSession, folder: str) -> DataFrame:
    return with_similarity(normalised(fx.vector_notes(spark, folder)), "v", vector_library(spark, folder), VECTOR_SETTINGS)


@query("cosine_scores")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = exploded(_similar(spark, folder), "vec_id", lambda d: F.col(f"similarity.{d}_scores"))
    return rows.select("vec_id", "dim", "e.label", rounded("e.score").alias("score"))


@query("topk_labels")
def _(spark: SparkSession, folder: str) -> DataFrame:
    best = exploded(
        _similar(spark, folder), "vec_id", lambda d: F.expr(top_k(f"similarity.{d}_scores", VECTOR_SETTINGS.top_k(d)))
    )
    return best.select("vec_id", "dim", (F.col("pos") + 1).alias("place"), "e.label", rounded("e.score").alias("score"))


@query("topk_above_threshold")
def _(spark: SparkSession, folder: str) -> DataFrame:
    kept = exploded(_similar(spark, folder), "vec_id", lambda d: F.col(f"similarity.{d}_kept"))
    return kept.select("vec_id", "dim", (F.col("pos") + 1).alias("place"), "e.label", rounded("e.score").alias("score"))


@query("embedding_confidence")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = _similar(spark, folder).select("vec_id", "similarity.role_confidence", "similarity.type_confidence")
    return found.toDF("vec_id", "role_conf", "type_conf")


@query("score_maps")
def _(spark: SparkSession, folder: str) -> DataFrame:
    maps = exploded(
        _similar(spark, folder),
        "vec_id",
        lambda d: F.map_entries(F.expr(score_map(f"similarity.{d}_scores", VECTOR_SETTINGS))),
    )
    return maps.select("vec_id", "dim", F.col("e.key").alias("label"), F.col("e.value").alias("score"))


@query("embedding_classify")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _similar(spark, folder).select(
        "vec_id",
        joined("similarity.role_labels").alias("roles"),
        joined("similarity.type_labels").alias("types"),
        F.col("similarity.role_confidence").alias("role_conf"),
        F.col("similarity.type_confidence").alias("type_conf"),
        F.size("similarity.role_scores").alias("n_role_scores"),
        F.size("similarity.type_scores").alias("n_type_scores"),
    )


# --- both stages merged ----------------------------------------------------------------


@query("stage_gate")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ruled = with_rules(composed_titles(spark, folder), "title")
    r = "rules"
    return ruled.select("title", F.expr(role_done(r)).alias("role_done"), F.expr(type_done(r)).alias("type_done"))


@query("source_rules")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ruled = with_rules(composed_titles(spark, folder), "title")
    r = "rules"
    return ruled.filter(f"{role_done(r)} AND {type_done(r)}").select(
        "title", joined("rules.roles").alias("roles"), joined("rules.note_types").alias("types"), "n"
    )


@query("needs_embedding")
def _(spark: SparkSession, folder: str) -> DataFrame:
    ruled = with_rules(distinct_titles(fx.notes(spark, folder), "note_title"), "title")
    r = "rules"
    return ruled.filter(needs_vector("title", r)).select(
        "title", F.expr(role_done(r)).alias("role_done"), F.expr(type_done(r)).alias("type_done"), "n"
    )


def vector_labeller(spark: SparkSession, folder: str) -> Labeller:
    return Labeller(encoder=VectorColumn("v", fx.anchor_vectors(spark, folder)), settings=VECTOR_SETTINGS)


def _staged(spark: SparkSession, folder: str) -> DataFrame:
    """Vector notes with text, both stages side by side: ``rules``, ``similarity``."""
    notes = normalised(fx.vector_notes(spark, folder)).filter(~F.expr(is_blank("note_title")))
    both = with_rules(notes, "note_title")
    return with_similarity(both, "v", vector_library(spark, folder), VECTOR_SETTINGS)


@query("merge_labels")
def _(spark: SparkSession, folder: str) -> DataFrame:
    r, e = "rules", "similarity"
    return _staged(spark, folder).select(
        "vec_id",
        joined(F.expr(merged_labels(role_done(r), f"{r}.roles", f"{e}.role_labels"))).alias("roles"),
        joined(F.expr(merged_labels(type_done(r), f"{r}.note_types", f"{e}.type_labels"))).alias("types"),
    )


@query("merge_confidence")
def _(spark: SparkSession, folder: str) -> DataFrame:
    r, e = "rules", "similarity"
    return _staged(spark, folder).select(
        "vec_id",
        F.expr(merged_confidence(role_done(r), f"{r}.role_confidence", f"{e}.role_confidence")).alias("role_conf"),
        F.expr(merged_confidence(type_done(r), f"{r}.type_confidence", f"{e}.type_confidence")).alias("type_conf"),
    )


@query("classification_source")
def _(spark: SparkSession, folder: str) -> DataFrame:
    notes = fx.vector_notes(spark, folder).filter(~F.expr(is_blank("note_title")))
    r = "rules"
    return with_rules(notes, "note_title").select("vec_id", F.expr(source_name(role_done(r), type_done(r))).alias("source"))


def flat(df: DataFrame, *keys: str) -> DataFrame:
    """Classified rows in a form both engines print alike."""
    c = "classification"
    return df.select(
        *keys,
        joined(f"{c}.roles").alias("roles"),
        joined(f"{c}.note_types").alias("types"),
        rounded(f"{c}.role_confidence").alias("role_conf"),
        rounded(f"{c}.note_type_confidence").alias("type_conf"),
        F.col(f"{c}.classification_source").alias("source"),
        joined(f"{c}.rule_hits").alias("tags"),
        F.size(f"{c}.embedding_role_scores").alias("n_role_scores"),
        F.size(f"{c}.embedding_type_scores").alias("n_type_scores"),
    )


@query("hybrid_classify")
def _(spark: SparkSession, folder: str) -> DataFrame:
    out = classify_notes(fx.vector_notes(spark, folder), labeller=vector_labeller(spark, folder))
    return flat(out, "vec_id", "note_title")


@query("empty_result")
def _(spark: SparkSession, folder: str) -> DataFrame:
    out = classify_notes(fx.notes(spark, folder))
    return flat(out.filter(F.col("clf_source") == "EMPTY"), "note_id", "note_title")


# --- entry points ----------------------------------------------------------------------


@query("classify_notes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return flat(classify_notes(fx.composed_notes(spark, folder)), "note_id", "note_title")


@query("classify_hot_cold")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """One title holds two fifths of the notes, the others have a title each; fewer may be looked up than there are."""
    out = classify_notes(fx.numbered_notes(spark, folder), labeller=Labeller(limits=Limits(titles=100)))
    return flat(out, "note_id", "note_title")


@query("classify_by_column")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The titles stand in a column of another name, beside a column of the usual one."""
    notes = fx.composed_notes(spark, folder).withColumnRenamed("note_title", "heading")
    out = classify_notes(notes.withColumn("note_title", F.col("author_name")), title_col="heading")
    return flat(out, "note_id", "heading", "note_title")


@query("classify_vector_table")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors come from a table of titles; one title holds a third of the notes."""
    encoder = VectorTable(fx.title_vectors(spark, folder), fx.anchor_vectors(spark, folder))
    labeller = Labeller(encoder=encoder, settings=VECTOR_SETTINGS, limits=Limits(titles=100))
    return flat(classify_notes(fx.shared_notes(spark, folder), labeller=labeller), "vec_id", "note_title")


@query("classify_model_vectors")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors come from a model on the workers; the most frequent titles are looked up, the others encoded once each."""
    settings = Settings(emb_conf_thresh=fx.LETTERS_THRESHOLD)
    labeller = Labeller(encoder=ModelVectors(letters.load, ""), settings=settings, limits=Limits(titles=200))
    return flat(classify_notes(fx.composed_notes(spark, folder), labeller=labeller), "note_id", "note_title")


@query("classify_notes_flat")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return classify_notes(fx.notes(spark, folder)).select(
        "note_id",
        joined("note_roles").alias("note_roles"),
        joined("note_types").alias("note_types"),
        rounded("role_conf").alias("role_conf"),
        rounded("type_conf").alias("type_conf"),
        "clf_source",
        joined("rule_hits").alias("rule_hits"),
    )


@query("classify_line_notes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The largest note table, counted by result."""
    out = flat(classify_notes(fx.bench_notes(spark, folder)))
    keys = ("roles", "types", "role_conf", "type_conf", "source")
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_notes"))


@query("score_titles")
def _(spark: SparkSession, folder: str) -> DataFrame:
    batch = fx.notes(spark, folder).select(F.col("note_title").alias("title"))
    return score_titles(batch).select(
        "title",
        joined("roles").alias("roles"),
        joined("note_types").alias("note_types"),
        rounded("role_confidence").alias("role_confidence"),
        rounded("note_type_confidence").alias("note_type_confidence"),
        "classification_source",
    )


@query("title_score_rows")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Both score maps of every distinct title that reached stage 2."""
    titles = composed_titles(spark, folder).select("title")
    maps = exploded(
        score_titles(titles), "title", lambda d: F.map_entries(F.col(f"embedding_{d}_scores"))
    )
    return maps.select("title", "dim", F.col("e.key").alias("label"), rounded("e.value").alias("score"))


@query("output_schema")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.field_types(classify_notes(fx.notes(spark, folder)))


@query("signature_sample")
def _(spark: SparkSession, folder: str) -> DataFrame:
    sample = fx.notes(spark, folder).filter(F.col("note_title").isin(*SAMPLE_TITLES))
    return flat(classify_notes(sample), "note_title").groupBy(
        "note_title", "roles", "types", "role_conf", "type_conf", "source", "tags"
    ).agg(F.count(F.lit(1)).alias("n_notes"))


# --- the whole job, its output and the queries on it -------------------------------------


@query("notes_end_to_end")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Eligible notes with their labels; the flagship."""
    labelled = label_notes(fx.notes(spark, folder))
    return labelled.select(
        "note_id",
        "sta3n",
        "status",
        "author_name",
        "reference_date",
        joined("note_roles").alias("note_roles"),
        joined("note_types").alias("note_types"),
        rounded("role_conf").alias("role_conf"),
        rounded("type_conf").alias("type_conf"),
        "clf_source",
        joined("rule_hits").alias("rule_hits"),
    )


@query("sink_roundtrip")
def _(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    write_notes(label_notes(fx.notes(spark, folder)), path=path)
    return spark.read.parquet(path).select(
        "note_id", "role_key", "type_key", rounded("role_conf").alias("role_conf"), "clf_source"
    )


@query("clustered_layout")
def _(spark: SparkSession, folder: str) -> DataFrame:
    labelled = classify_notes(fx.composed_notes(spark, folder))
    laid = cluster_by_labels(labelled).select("role_key", "type_key", "clf_source")
    return laid.groupBy("role_key", "type_key", "clf_source").agg(F.count(F.lit(1)).alias("n_notes"))


@query("z_ordered_layout")
def _(spark: SparkSession, folder: str) -> DataFrame:
    labelled = classify_notes(fx.notes(spark, folder))
    return cluster_by_labels(labelled, z_order=True).select("note_id", "role_key", "type_key", "clf_source")


def _written(spark: SparkSession, notes: DataFrame, z_order: bool) -> DataFrame:
    """How the files of labelled notes lie, read back from them."""
    path, labeller = shared_folder(spark), Labeller()
    known = answers(notes, "note_title", labeller)
    weights = layout_weights(notes, "note_title", labeller, known, z_order)
    write_notes(clustered_notes(notes, "note_title", labeller, known, 8, z_order, weights), path=path, cluster=False)
    laid = layout_report(spark, path, z_order)
    return laid.select(
        "n_notes",
        F.col("n_files").cast("int").alias("n_files"),
        F.col("n_overlaps").cast("int").alias("n_overlaps"),
        (F.col("largest_share") <= 2).alias("balanced"),
    )


@query("clustered_files")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _written(spark, fx.composed_notes(spark, folder), False)


@query("z_ordered_files")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _written(spark, fx.notes(spark, folder), True)


@query("published_run")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job; what it published, read back: the manifest beside counts of the notes and the anchors."""
    source, path = shared_folder(spark), shared_folder(spark)
    fx.notes(spark, folder).write.parquet(source)
    run(spark, source, path=path, files=8, model="hashed-tokens-256")
    n_read = spark.read.parquet(path).agg(F.count(F.lit(1))).scalar()
    n_labels = published.read_anchors(spark, path=path).agg(F.sum(F.size(F.json_object_keys("value"))).cast("bigint")).scalar()
    manifest = published.read_manifest(spark, path=path)
    return manifest.select("*", n_read.alias("n_read"), n_labels.alias("n_anchor_labels"))


@query("smoke_report")
def _(spark: SparkSession, folder: str) -> DataFrame:
    titles = distinct_titles(fx.notes(spark, folder), "note_title").select("title")
    return reports.report_lines(score_titles(titles)).select("title", "line")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return classify_notes(fx.composed_notes(spark, folder))


@query("notes_by_role")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.notes_by_role(_labelled(spark, folder), "NURSING")
    return found.select("note_id", "note_title", joined("note_roles").alias("note_roles"))


@query("notes_by_type_source")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.notes_by_type_source(_labelled(spark, folder), "DISCHARGE", "RULES")
    return found.select("note_id", "note_title", joined("note_types").alias("note_types"))


@query("source_mix")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.source_mix(classify_notes(fx.notes(spark, folder)))


@query("rule_audit")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.rule_audit(_labelled(spark, folder))


@query("role_type_matrix")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.role_type_matrix(_labelled(spark, folder))


@query("unlabelled_titles")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return reports.unlabelled_titles(classify_notes(fx.notes(spark, folder)))
