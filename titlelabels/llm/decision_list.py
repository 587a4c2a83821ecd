"""Quality rules as a learned decision list.

Sequential covering in the manner of incremental reduced error pruning: from labelled
statistics, a rule for the rejected class grows by the condition of greatest information
gain on two thirds of the rows, is cut back to the front part that does best on the other
third, and takes the rows it covers away; this repeats while a pruned rule is right in most of its rows.
The rules come out as one ordered Spark conditional expression over statistic columns.

A row with a null in a statistic passes no condition. Without labels, or with labels of one
kind, the list is empty and keeps everything.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelabels.llm.common import FIT_ROWS, labelled, map_rows
from titlelabels.llm.statistics import COUNTS, SHARES, measure, schema

#: A rule has at most so many conditions; a list at most so many rules.
MAX_CONDITIONS = 4
MAX_RULES = 24
#: Thresholds tried per statistic in a step.
THRESHOLDS = 48
#: A rule stays where it covers so many rows of either part and is right in so large a share of the held-back ones.
LEAST_ROWS = 3
LEAST_RIGHT = 0.75


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x > self.threshold if self.above else x <= self.threshold

    def column(self) -> Column:
        c = F.col(self.name)
        return c > self.threshold if self.above else c <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions])


def _thresholds(x: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring distinct values, at most ``THRESHOLDS`` of them by rank."""
    values = np.unique(x)
    if len(values) < 2:
        return values[:0]
    at = np.unique(np.linspace(0, len(values) - 2, THRESHOLDS).astype(int))
    ranks = np.unique(np.quantile(np.arange(len(x)), np.linspace(0, 1, THRESHOLDS)).astype(int))
    by_rank = np.searchsorted(values, np.sort(x)[ranks])
    at = np.unique(np.concatenate([at, np.clip(by_rank, 0, len(values) - 2)]))
    return (values[at] + values[at + 1]) / 2


def _gain(hit: np.ndarray, bad: np.ndarray, before: float) -> float:
    p, n = (hit & bad).sum(), (hit & ~bad).sum()
    return p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - before) if p else -np.inf


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, names: tuple[str, ...]) -> list[Condition]:
    live = np.ones(len(bad), bool)
    out: list[Condition] = []
    while len(out) < MAX_CONDITIONS and (live & ~bad).any():
        before = np.log2((live & bad).sum() / live.sum())
        best, gain = None, 1e-9
        for name in names:
            values = x[name]
            for t in _thresholds(values[live]):
                for above in (True, False):
                    c = Condition(name, above, float(t))
                    hit = live & c.holds(values)
                    if hit.sum() >= LEAST_ROWS and (g := _gain(hit, bad, before)) > gain:
                        best, gain = c, g
        if best is None:
            break
        out.append(best)
        live &= best.holds(x[best.name])
    return out


def _covered(conditions: list[Condition], x: dict[str, np.ndarray]) -> np.ndarray:
    return reduce(lambda a, b: a & b, [c.holds(x[c.name]) for c in conditions])


def learn(x: dict[str, np.ndarray], good: np.ndarray, names: tuple[str, ...] = SHARES) -> list[Rule]:
    """Rules for the rows that are not good. ``x``: statistics by name; ``good``: 0/1 labels."""
    bad = np.asarray(good) == 0
    rest = np.arange(len(bad))
    rng = np.random.default_rng(11)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and bad[rest].sum() >= LEAST_ROWS and (~bad[rest]).any():
        mixed = rng.permutation(rest)
        cut = len(mixed) * 2 // 3
        one, two = mixed[:cut], mixed[cut:]
        grown = _grow({c: x[c][one] for c in names}, bad[one], names) if bad[one].any() else []
        if not grown:
            break
        held = {c: x[c][two] for c in names}
        worth = []
        for k in range(1, len(grown) + 1):
            hit = _covered(grown[:k], held)
            p, n = (hit & bad[two]).sum(), (hit & ~bad[two]).sum()
            worth.append(((p - n) / (p + n) if p + n else -1.0, p, k))
        value, hits, k = max(worth)
        if hits < LEAST_ROWS or (value + 1) / 2 < LEAST_RIGHT:
            break
        rules.append(Rule(tuple(grown[:k])))
        rest = rest[~_covered(grown[:k], {c: x[c][rest] for c in names})]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where no rule rejects the row."""
    out = F.when(F.lit(False), False)
    for rule in rules:
        out = out.when(F.coalesce(rule.column(), F.lit(False)), False)
    return out.otherwise(True)


def statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return map_rows(df, [text_col], schema(), lambda: measure, keep)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = FIT_ROWS) -> list[Rule]:
    """The list learnt from at most about ``bound`` labelled documents."""
    rows = statistics(labelled(docs, labels, label, F.lit(True), bound), keep=("_id", "label")).toArrow()
    rows = rows.sort_by("_id")
    if not rows.num_rows:
        return []
    return learn({c: rows[c].to_numpy() for c in SHARES}, rows["label"].to_numpy())


def apply(df: DataFrame, rules: list[Rule], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the counts, ``base_failed`` and ``kept`` of every row.

    The base rules reject texts under 50 words and those with over half their words in repeated windows; the list decides the others.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = statistics(df, text_col, keep).withColumn("base_failed", base).withColumn("kept", ~base & verdict(rules))
    return out.select(*keep, *COUNTS, "base_failed", "kept")
