"""Stage 2: cosine of a title's vector with every label's centroid, and the best labels.

All of it happens inside the row (arrays of at most one entry per label), so no
step shuffles. Arguments are SQL expressions (see functions.text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelabels.functions.text import let
from titlelabels.functions.vectors import dot, sparse_dot
from titlelabels.taxonomy import DIMS, Settings

SCORES = "array<struct<ord:int,label:string,score:double>>"


def cosines(vector: str, centroids: str, sparse: bool = False) -> str:
    """Array of ``struct<ord, label, score>``, one entry per centroid, in taxonomy order."""
    product = sparse_dot(vector, "cen.c") if sparse else dot(vector, "cen.c")
    return f"transform({centroids}, cen -> named_struct('ord', cen.ord, 'label', cen.label, 'score', {product}))"


def top_k(scores: str, k: int) -> str:
    """The k best scores, best first; equal scores keep taxonomy order."""
    ranked = f"transform({scores}, r -> named_struct('neg', -r.score, 'ord', r.ord, 'label', r.label, 'score', r.score))"
    return f"slice(array_sort({ranked}), 1, {k})"


def above(ranked: str, threshold: float) -> str:
    """Those at or above the threshold; compared before any rounding."""
    return f"filter({ranked}, r -> r.score >= {threshold}D)"


def best_score(kept: str, settings: Settings) -> str:
    """Halves round to the even digit, here and in the map."""
    return f"coalesce(bround(get({kept}, 0).score, {settings.digits}), 0.0D)"


def score_map(scores: str, settings: Settings) -> str:
    """Label to rounded score, labels below the threshold included."""
    return f"map_from_entries(transform({scores}, r -> struct(r.label, bround(r.score, {settings.digits}))))"


def similarity_sql(vector: str, library: str, settings: Settings = Settings(), sparse: bool = False) -> str:
    """Stage 2 as one SQL expression.

    Per dimension the struct holds ``<dim>_scores`` (all, in taxonomy order),
    ``<dim>_kept`` (the survivors, best first), ``<dim>_labels`` and
    ``<dim>_confidence``. Without a vector the arrays are empty.
    """
    scored = ", ".join(
        f"'{d}', CASE WHEN {vector} IS NULL THEN cast(array() AS {SCORES}) "
        f"ELSE {cosines(vector, f'{library}.{d}', sparse)} END"
        for d in DIMS
    )
    kept = ", ".join(f"'{d}', {above(top_k(f'sc.{d}', settings.top_k(d)), settings.emb_conf_thresh)}" for d in DIMS)
    fields = ", ".join(
        f"'{d}_scores', sc.{d}, '{d}_kept', kp.{d}, '{d}_labels', transform(kp.{d}, r -> r.label), "
        f"'{d}_confidence', {best_score(f'kp.{d}', settings)}"
        for d in DIMS
    )
    return let("sc", f"named_struct({scored})", let("kp", f"named_struct({kept})", f"named_struct({fields})"))


def with_similarity(
    df: DataFrame, vector_col: str, library: Column, settings: Settings = Settings(), sparse: bool = False
) -> DataFrame:
    """Add the struct of :func:`similarity_sql` as column ``similarity``."""
    out = df.withColumn("__library", library)
    found = F.expr(similarity_sql(vector_col, "__library", settings, sparse))
    return out.withColumn("similarity", found).drop("__library")
