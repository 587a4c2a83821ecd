"""Role and note-type labels for short document titles, as Spark DataFrame jobs."""

from titlelabels.operators.classify import Labeller, Limits, classify_notes, score_titles
from titlelabels.operators.hybrid import OUTPUT_SCHEMA
from titlelabels.operators.rules import rule_struct, with_rules
from titlelabels.plans.labelling import label_notes, run
from titlelabels.rulepack import RULES, Rule, load_rules, rule_table
from titlelabels.sources.encoders import Encoder, HashedTokens, ModelVectors, VectorColumn, VectorTable
from titlelabels.taxonomy import ROLE_LABELS, TYPE_LABELS, Settings

__all__ = [
    "OUTPUT_SCHEMA",
    "ROLE_LABELS",
    "RULES",
    "TYPE_LABELS",
    "Encoder",
    "HashedTokens",
    "Labeller",
    "Limits",
    "ModelVectors",
    "Rule",
    "Settings",
    "VectorColumn",
    "VectorTable",
    "classify_notes",
    "label_notes",
    "load_rules",
    "rule_struct",
    "rule_table",
    "run",
    "score_titles",
    "with_rules",
]
