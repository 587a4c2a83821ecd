"""Reading the note table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What counts as an eligible note.
STATUSES = ("COMPLETED", "AMENDED", "UNCOSIGNED")
PATIENT_CLASSES = ("INPATIENT",)

NOTE_COLUMNS = ("sta3n", "note_id", "note_title", "reference_date", "status", "author_name")


def scan_notes(spark: SparkSession, source: str) -> DataFrame:
    """A note table by name, or by path when the source holds a slash."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def has_status(statuses: Sequence[str] = STATUSES) -> Column:
    return F.col("status").isin(*statuses)


def has_class(classes: Sequence[str] = PATIENT_CLASSES) -> Column:
    return F.col("patient_class").isin(*classes)


def eligible_notes(
    notes: DataFrame,
    columns: Sequence[str] = NOTE_COLUMNS,
    statuses: Sequence[str] = STATUSES,
    classes: Sequence[str] = PATIENT_CLASSES,
) -> DataFrame:
    """Signed notes of inpatients, reduced to ``columns``; a null on either side drops the row."""
    return notes.filter(has_status(statuses) & has_class(classes)).select(*columns)
