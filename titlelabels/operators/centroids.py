"""Centroids: the renormalised mean vector of each label's anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelabels.functions.text import literal
from titlelabels.functions.vectors import unit
from titlelabels.taxonomy import DIMS, LABELS

OWN_LABEL = 1_000  # place of labels outside the taxonomy


def label_means(anchor_vectors: DataFrame) -> DataFrame:
    """Element-wise mean per label, long form ``dim, label, pos, x``.

    The sums are combined before the shuffle, so a label with very many
    anchors moves one number per position and task.
    """
    return (
        anchor_vectors.select("dim", "label", F.posexplode_outer("v").alias("pos", "x"))
        .filter(F.col("pos").isNotNull())
        .groupBy("dim", "label", "pos")
        .agg(F.avg("x").alias("x"))
    )


def label_centroids(anchor_vectors: DataFrame, renormalise: bool = True) -> DataFrame:
    """One row per label: ``dim, label, c array<double>``."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"])
    means = label_means(anchor_vectors).groupBy("dim", "label").agg(ordered.alias("c"))
    return means.withColumn("c", F.expr(unit("c"))) if renormalise else means


def label_order() -> str:
    """Place of a label in its taxonomy; labels of the user's own come last."""
    places = " ".join(
        f"WHEN dim = '{d}' THEN nullif(array_position(array({', '.join(map(literal, LABELS[d]))}), label), 0)"
        for d in DIMS
    )
    return f"cast(coalesce(CASE {places} END, {OWN_LABEL}) AS int)"


def centroid_library(centroids: DataFrame) -> Column:
    """All centroids as one value, a struct with one array per dimension.

    It is a scalar subquery: computed once per query and handed to every task,
    without a join. Its size is the number of labels times the vector length.
    """
    entry = f"named_struct('ord', {label_order()}, 'label', label, 'c', c)"
    arrays = ", ".join(f"'{d}', array_sort(collect_list(CASE WHEN dim = '{d}' THEN {entry} END))" for d in DIMS)
    return centroids.agg(F.expr(f"named_struct({arrays})").alias("library")).scalar()
