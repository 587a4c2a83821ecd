"""A stand-in for a local model, importable on the workers."""

import os
from uuid import uuid4

import numpy as np

LOADS = []


def load(path: str):
    LOADS.append(path)

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), 26))
        for n, text in enumerate(texts):
            for ch in text.lower():
                if "a" <= ch <= "z":
                    out[n, ord(ch) - 97] += 1
        return out

    return encode


def counted(path: str):
    """The same; leaves a file named by its process in the folder ``path`` for each load."""
    with open(f"{path}/{os.getpid()}-{uuid4().hex}", "w"):
        return load(path)
