"""SQL expressions over vectors.

A dense vector is ``array<double>``; a sparse one is an array of
``struct<i int, x double>`` in ascending ``i``.
"""

from __future__ import annotations

from titlelabels.functions.text import let


def dot(v: str, c: str) -> str:
    """Product of two vectors; unequal lengths are an error."""
    product = f"aggregate(zip_with({v}, {c}, (a, b) -> a * b), 0.0D, (acc, x) -> acc + x)"
    wrong = "cast(raise_error('a vector and a centroid differ in length') AS double)"
    return f"CASE WHEN size({v}) = size({c}) THEN {product} ELSE {wrong} END"


def sparse_dot(entries: str, c: str) -> str:
    """Sparse against dense; entries outside the dense vector count as zero."""
    return f"aggregate({entries}, 0.0D, (acc, e) -> acc + e.x * coalesce(get({c}, e.i), 0.0D))"


def norm(v: str) -> str:
    return f"sqrt(aggregate({v}, 0.0D, (acc, x) -> acc + x * x))"


def unit(v: str) -> str:
    """Vector of length 1; a zero vector stays as it is."""
    return let("len", norm(v), f"CASE WHEN len > 0 THEN transform({v}, x -> x / len) ELSE {v} END")
