"""A model that needs no files: a text's vector is how often it has each of the letters a to z."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def load(path: str) -> Callable[[list[str]], np.ndarray]:
    """The model; ``path`` is where the files of another one would be."""
    return lambda texts: np.array([[text.lower().count(c) for c in LETTERS] for text in texts], dtype="float64").reshape(-1, len(LETTERS))
