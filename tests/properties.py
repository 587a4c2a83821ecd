"""What every result must satisfy, told from the result and the tables of rules and labels alone."""

from __future__ import annotations

import re
from decimal import Decimal

import pandas as pd
import pytest

from titlelabels.rulepack import RULES, Dialect, rule_pattern
from titlelabels.taxonomy import DIMS, LABELS, Settings

PYTHON = Dialect(
    space=r"\s",
    space_or_hyphen=r"[\s-]",
    digit=r"\d",
    start=r"\b",
    end_after_word=r"\b",
    end_after_other=r"\b",
    veto=r"(?!.*%s)",
)
PATTERNS = pd.Series({r.tag: re.compile(rule_pattern(r, PYTHON), re.IGNORECASE) for r in RULES})
#: One row per rule and label, weights as exact decimals.
WEIGHTS = pd.DataFrame(
    [(r.rule_id, r.tag, d, x, Decimal(str(r.weight))) for r in RULES for d in DIMS for x in r.labels(d)],
    columns=["rule_id", "tag", "dim", "label", "weight"],
)
RULE_ID = {r.tag: r.rule_id for r in RULES}
LISTS = dict(zip(DIMS, ("roles", "note_types"), strict=True))
#: Nearer to the edge of the band than this, doubles decide; hand-made cases cover the edge.
EDGE = Decimal("1e-9")


def assert_hits(title: str, hits: list[str]) -> None:
    """Exactly the rules whose pattern Python finds, in the order of the pack."""
    found = PATTERNS[[bool(p.search(title.upper())) for p in PATTERNS]]
    assert set(hits) == set(found.index), title
    assert [RULE_ID[t] for t in hits] == sorted(RULE_ID[t] for t in hits), title


def label_sums(hits: list[str], dim: str) -> pd.Series:
    """Weight per label of the rules that fired, by a join with the table of weights."""
    fired = WEIGHTS.merge(pd.DataFrame({"tag": hits}), on="tag")
    return fired[fired.dim == dim].groupby("label").weight.sum()


def assert_rule_labels(title: str, labels: list[str], confidence: float, hits: list[str], dim: str, settings: Settings) -> None:
    """Kept labels lie inside the band, the others outside; the confidence is the greatest sum, capped."""
    sums = label_sums(hits, dim)
    greatest = sums.max() if len(sums) else Decimal(0)
    edge = Decimal(str(settings.band_ratio)) * greatest
    assert labels == sorted(set(labels)) and set(labels) <= set(sums.index), title
    for label, weight in sums.items():
        if abs(weight - edge) > EDGE:
            assert (label in labels) == (weight > edge), (title, label)
    assert confidence == pytest.approx(float(min(greatest, Decimal(str(settings.cap)))), abs=1e-4), title


def assert_empty(got: dict) -> None:
    assert got["classification_source"] == "EMPTY" and got["rule_hits"] == []
    for dim, labels in LISTS.items():
        assert got[labels] == ["UNKNOWN"] and got[f"embedding_{dim}_scores"] == {}
    assert got["role_confidence"] == got["note_type_confidence"] == 0


def assert_best(title: str, labels: list[str], confidence: float, scores: dict[str, float], dim: str, settings: Settings) -> bool:
    """Labels by falling score, none below the threshold, none better left out; false if no score reaches it."""
    reach = {x for x, s in scores.items() if s >= settings.emb_conf_thresh}
    if not reach:
        assert confidence == 0, title
        return False
    assert len(labels) == min(settings.top_k(dim), len(reach)) and set(labels) <= reach, title
    falling = [(-scores[x], LABELS[dim].index(x)) for x in labels]
    assert falling == sorted(falling), title
    for x in reach - set(labels):
        assert (-scores[x], LABELS[dim].index(x)) > falling[-1], (title, x)
    assert confidence == pytest.approx(max(scores[x] for x in reach), abs=2e-4), title
    return True


def assert_result(title: str | None, got: dict, scores: dict[str, dict[str, float]] | None, settings: Settings = Settings()) -> None:
    """``scores``: per dimension label to cosine; None if the title has no vector."""
    if title is None or title.strip() == "":
        assert_empty(got)
        return
    hits = got["rule_hits"]
    assert_hits(title, hits)
    gate = Decimal(str(settings.rule_conf_thresh))
    passed = {d: len(s := label_sums(hits, d)) > 0 and min(s.max(), Decimal(str(settings.cap))) >= gate for d in DIMS}
    names = {0: "EMBEDDING", 1: "RULES+EMBEDDING", 2: "RULES"}
    assert got["classification_source"] == names[sum(passed.values())], title
    for dim, confidence in zip(DIMS, (got["role_confidence"], got["note_type_confidence"]), strict=True):
        given = {} if all(passed.values()) or scores is None else scores[dim]
        assert got[f"embedding_{dim}_scores"] == pytest.approx(given, abs=2e-4), title
        labels = got[LISTS[dim]]
        if passed[dim]:
            assert_rule_labels(title, labels, confidence, hits, dim, settings)
        elif not assert_best(title, labels, confidence, given, dim, settings):
            sums = label_sums(hits, dim)  # the rules' labels after all, with no confidence
            assert_rule_labels(title, labels, float(sums.max()) if len(sums) else 0.0, hits, dim, settings)
