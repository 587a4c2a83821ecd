"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Toxicity, near duplicates, personal data, mixing of sources, BPE encoding. The stages before
the last return the columns of ``documents``; the last one returns ids of tokens.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlelabels.llm import byte_pairs, jaccard_join, mixing, private_data, toxicity
from titlelabels.llm.common import table
from titlelabels.llm.queries import tokenizer_path
from titlelabels.session import keeping, kept_at, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def kept(stage: Stage) -> Stage:
    """The stage's rows, kept in the shared folder: few texts at a time pass between the JVM and Python then."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        with keeping(spark):
            return kept_at(stage(spark, docs, folder), shared_folder(spark))

    return run


@kept
def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    scored = toxicity.toxicity(docs, table(spark, folder, "labels"), keep=tuple(docs.columns))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of every component of near duplicates the document with the smallest id; documents without words stay."""
    return jaccard_join.one_per_component(docs)


@kept
def without_private_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return private_data.mask(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of the mix, each as often as it is taken."""
    return mixing.mixed(docs)


@kept
def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, the number of tokens and their ids; the ids decode to the text."""
    return byte_pairs.encode(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near duplicates", one_of_each_group),
    ("personal data", without_private_data),
    ("mixing", mixed_sources),
    ("encoding", encoded),
]

#: A trained score and a merge table are no SQL; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder."""
    docs = table(spark, folder, "documents")
    shared = shared_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{shared}/stage-{number}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
