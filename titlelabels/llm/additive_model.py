"""Quality score: a generalised additive model with pairwise interactions.

Every statistic is cut into bins by its quantiles. Boosting goes round the statistics in
turn and adds a shallow tree over one statistic's bins, so that each ends as one lookup
table; the pairs with the strongest remaining interaction get tables over two statistics in
the same way. A score is the sum of table entries through the logistic function.

Null and empty texts have all statistics zero and so a score like any other text. Without
labels of both kinds the score is the share of ones (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlelabels.llm.common import FIT_ROWS, SLICE, labelled, map_rows, remainder
from titlelabels.llm.statistics import COUNTS, SHARES, measure, schema

BINS = 48
PAIR_BINS = 12
ROUNDS = 160
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.12
LEAVES = 3
#: Added to every leaf's curvature, so that small leaves stay near zero.
DAMPING = 6.0
THRESHOLD = 0.3


@dataclass
class Model:
    start: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows of statistics (rows x statistics)."""
        out = np.full(len(x), self.start)
        if self.tables:
            bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.cuts)]
            for table, b in zip(self.tables, bins, strict=True):
                out += table[b]
            for i, j, table in self.pairs:
                a = np.searchsorted(self.pair_cuts[i], x[:, i], side="right")
                b = np.searchsorted(self.pair_cuts[j], x[:, j], side="right")
                out += table[a, b]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(x)
    if len(values) < 2:
        return values[:0]
    q = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
    at = np.clip(np.searchsorted(values, q), 0, len(values) - 2)
    return np.unique((values[at] + values[at + 1]) / 2)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of every bin: a tree of at most ``LEAVES`` leaves over ordered bins."""
    edges = [0, len(g)]
    worth = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + DAMPING)
    while len(edges) <= LEAVES:
        best, gain = None, 1e-12
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gains = left_g**2 / (left_h + DAMPING) + (all_g - left_g) ** 2 / (all_h - left_h + DAMPING) - worth(a, b)
            k = int(gains.argmax())
            if gains[k] > gain:
                best, gain = a + k + 1, gains[k]
        if best is None:
            break
        edges = sorted([*edges, best])
    out = np.zeros(len(g))
    for a, b in zip(edges, edges[1:], strict=False):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + DAMPING)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a two-way table cut once along either side, and their worth over the uncut table."""
    G, H = np.zeros((g.shape[0] + 1, g.shape[1] + 1)), np.zeros((g.shape[0] + 1, g.shape[1] + 1))
    G[1:, 1:], H[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    i, j = np.arange(1, g.shape[0])[:, None], np.arange(1, g.shape[1])[None, :]
    if not i.size or not j.size:
        return np.zeros_like(g), 0.0

    def parts(C):
        a = C[i, j]
        return a, C[i, -1:].reshape(-1, 1) - a, C[-1:, j].reshape(1, -1) - a, C[-1, -1] - C[i, -1].reshape(-1, 1) - C[-1, j].reshape(1, -1) + a

    cells = list(zip(parts(G), parts(H), strict=True))
    gains = sum(x**2 / (y + DAMPING) for x, y in cells)
    a, b = np.unravel_index(int(gains.argmax()), gains.shape)
    v = [x[a, b] / (y[a, b] + DAMPING) for x, y in cells]
    out = np.empty_like(g)
    out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = v
    return out, float(gains[a, b] - G[-1, -1] ** 2 / (H[-1, -1] + DAMPING))


def learn(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of rows of statistics and 0/1 labels; the same rows give the same model."""
    y = np.asarray(y, float)
    n = len(y)
    if not n or y.min() == y.max():
        share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
        return Model(float(np.log(share / (1 - share))))
    width = x.shape[1]
    model = Model(float(np.log(y.mean() / (1 - y.mean()))), [_cuts(x[:, k], BINS) for k in range(width)])
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(model.cuts)]
    raw = np.full(n, model.start)

    def slopes():
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            g, h = slopes()
            size = len(model.tables[k])
            step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size))
            model.tables[k] += step
            raw += step[b]
    model.pair_cuts = [_cuts(x[:, k], PAIR_BINS) for k in range(width)]
    coarse = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(model.pair_cuts)]
    shape = [len(c) + 1 for c in model.pair_cuts]

    def cells(i, j):
        g, h = slopes()
        at = coarse[i] * shape[j] + coarse[j]
        size = shape[i] * shape[j]
        return np.bincount(at, g, size).reshape(shape[i], -1), np.bincount(at, h, size).reshape(shape[i], -1)

    ranked = sorted(((-_quarters(*cells(i, j))[1], i, j) for i, j in combinations(range(width), 2)))[:PAIRS]
    tables = {(i, j): np.zeros((shape[i], shape[j])) for worth, i, j in ranked if worth < 0}
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in tables.items():
            step = RATE * _quarters(*cells(i, j))[0]
            table += step
            raw += step[coarse[i], coarse[j]]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str, learn_from, bound: int = FIT_ROWS) -> Model:
    """The model of at most about ``bound`` labelled documents that ``learn_from`` (a condition on the id) admits."""
    rows = map_rows(labelled(docs, labels, label, learn_from, bound), ["text"], schema(), lambda: measure, ("_id", "label"))
    rows = rows.toArrow().sort_by("_id")
    return learn(np.stack([rows[c].to_numpy() for c in SHARES], axis=1), rows["label"].to_numpy())


def score(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the score of every row's text; statistics by text, table entries added for a whole slice at once."""
    first = len(COUNTS)
    keep = tuple(c for c in keep if c != "score")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                x = np.array([measure(text)[first:] for text in batch.column(len(keep)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(model.score(x))], names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; ids whose checksum leaves remainder 0 modulo 5 are never learnt from."""
    held = remainder("doc_id", 5) == 0
    model = fit(docs, labels, "quality", ~held)
    out = score(docs, model)
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
