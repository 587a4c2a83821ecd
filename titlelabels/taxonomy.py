"""Label taxonomy and run settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

ROLE = "role"
TYPE = "type"
DIMS = (ROLE, TYPE)

# Label names in taxonomy order (the order decides score ties).
ROLE_LABELS = (
    "CLINICAL",
    "NURSING",
    "SOCIAL_WORK",
    "ALLIED_HEALTH",
    "ADMINISTRATIVE",
)
TYPE_LABELS = (
    "ADMISSION",
    "PROGRESS",
    "ASSESSMENT",
    "PLAN",
    "PROCEDURE",
    "CONSULT",
    "HANDOFF",
    "DISCHARGE",
    "ADDENDUM",
    "ORDER",
    "EDUCATION",
    "ADMINISTRATIVE",
)
UNKNOWN = "UNKNOWN"

LABELS = {ROLE: ROLE_LABELS, TYPE: TYPE_LABELS}


@dataclass(frozen=True)
class Settings:
    """Tunable numbers of a run; the defaults are fixed values."""

    rule_conf_thresh: float = 0.72
    emb_conf_thresh: float = 0.45
    band_ratio: float = 0.60
    top_k_role: int = 2
    top_k_type: int = 3
    cap: float = 1.0
    digits: int = 4

    def top_k(self, dim: str) -> int:
        return self.top_k_role if dim == ROLE else self.top_k_type


def taxonomy_table(spark: SparkSession) -> DataFrame:
    """One row per label: ``dim, ord, label``."""
    rows = [(dim, i, label) for dim in DIMS for i, label in enumerate(LABELS[dim])]
    return spark.createDataFrame(rows, "dim string, ord int, label string")
