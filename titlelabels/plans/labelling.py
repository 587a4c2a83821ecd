"""The whole job: read, filter, label, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelabels.anchors import anchor_table
from titlelabels.operators.classify import FLAT_COLUMNS, FOUND, Answers, Labeller, answers, classify_arranged, classify_notes, lookup_key
from titlelabels.plans.reports import run_manifest
from titlelabels.session import scratch
from titlelabels.sources import published
from titlelabels.sources.notes import NOTE_COLUMNS, PATIENT_CLASSES, STATUSES, eligible_notes, scan_notes
from titlelabels.sources.sinks import arrange, layout_key, with_layout_keys, write_anchors, write_notes

#: About so many rows without an answer are scored beforehand to see how their labels are spread.
SAMPLED_ROWS = 20_000


def label_notes(
    notes: DataFrame,
    title_col: str = "note_title",
    columns: Sequence[str] = NOTE_COLUMNS,
    labeller: Labeller | None = None,
    statuses: Sequence[str] = STATUSES,
    classes: Sequence[str] = PATIENT_CLASSES,
) -> DataFrame:
    """Eligible notes with their labels."""
    return classify_notes(eligible_notes(notes, columns, statuses, classes), title_col, labeller)


def layout_weights(
    notes: DataFrame, title_col: str, labeller: Labeller, known: Answers, z_order: bool = False
) -> list[tuple[str | int, float]]:
    """How many rows each :func:`~titlelabels.sources.sinks.layout_key` will have, without labelling the table.

    Repeated titles have their counts already. For the rest about ``SAMPLED_ROWS`` rows are read (their titles
    only) and scored. Weights decide where rows lie, never which labels they get. One row a key
    reaches the driver, at most as many as there are repeated titles and sampled rows.
    """
    flat = [F.col(FOUND)[FLAT_COLUMNS[c]].alias(c) for c in ("note_roles", "note_types", "clf_source")]
    parts, cold = [], known.rows
    if known.lookup is not None:
        parts.append(known.lookup.select(*flat, F.col("n").cast("double").alias("n")))
        cold -= known.lookup.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if cold > 0:
        share = min(1.0, SAMPLED_ROWS / cold)
        titles = notes.select(F.col(title_col).alias("title")).sample(share, seed=7)
        if known.lookup is not None:
            titles = titles.join(F.broadcast(known.lookup.select("__t")), lookup_key("title") == F.col("__t"), "left_anti")
        scored = labeller.score(titles.groupBy("title").agg(F.count(F.lit(1)).alias("n")), "title", FOUND)
        parts.append(scored.select(*flat, (F.col("n") / share).alias("n")))
    if not parts:
        return []
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    keyed = rows.select(layout_key(z_order).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n"))
    return [(r.key, r.n) for r in keyed.collect()]


def clustered_notes(
    notes: DataFrame,
    title_col: str,
    labeller: Labeller,
    known: Answers | None,
    files: int | None = None,
    z_order: bool = False,
    weights: Sequence[tuple[str | int, float]] | None = None,
) -> DataFrame:
    """Labelled notes clustered by labels and source, with their layout keys; a task sorts rows without the results of known titles."""
    laid = classify_arranged(notes, title_col, labeller, known, lambda rows: arrange(rows, files, z_order, weights))
    return with_layout_keys(laid)


def run(
    spark: SparkSession,
    source: str,
    *,
    table: str | None = None,
    path: str | None = None,
    title_col: str = "note_title",
    columns: Sequence[str] = NOTE_COLUMNS,
    labeller: Labeller | None = None,
    fmt: str = "parquet",
    files: int | None = None,
    z_order: bool = False,
    statuses: Sequence[str] = STATUSES,
    classes: Sequence[str] = PATIENT_CLASSES,
    model: str | None = None,
) -> None:
    """Label a note table and write it, clustered by labels and source; what is kept on the way is deleted.

    Notes, manifest and anchors are published as one set (:mod:`titlelabels.sources.published`). Where the
    encoder works by title, ranges come from the counts of titles and the notes are labelled once. Formats other than
    Parquet have a log of their own; they get the notes alone.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    labeller = labeller or Labeller()
    with scratch(spark):
        notes = eligible_notes(scan_notes(spark, source), columns, statuses, classes)
        known = weights = None
        if labeller.encoder.by_title:
            known = answers(notes, title_col, labeller)
            weights = layout_weights(notes, title_col, labeller, known, z_order)
        labelled = clustered_notes(notes, title_col, labeller, known, files, z_order, weights)
        if fmt != "parquet":
            write_notes(labelled, table=table, path=path, fmt=fmt, cluster=False)
            return

        def write(folder: str) -> None:
            write_notes(labelled, path=folder, cluster=False)
            # The manifest counts the notes that were written, from the footers of their files.
            manifest = run_manifest(spark.read.parquet(folder), model or type(labeller.encoder).__name__, labeller.rules, labeller.settings)
            manifest.coalesce(1).write.parquet(f"{folder}/{published.MANIFEST}")
            anchors = labeller.anchors if labeller.anchors is not None else anchor_table(spark)
            write_anchors(anchors, f"{folder}/{published.ANCHORS}")

        if path is not None:
            published.publish_path(spark, path, write)
        else:
            published.publish_table(spark, table, write)
