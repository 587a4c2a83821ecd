"""The registered queries ``opN_<name>`` and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from titlelabels.llm import (
    additive_model,
    archive,
    byte_pairs,
    conversation,
    decision_list,
    jaccard_join,
    main_text,
    mixing,
    order_minhash,
    passages,
    private_data,
    spelling,
    toxicity,
)
from titlelabels.llm.common import table


def tokenizer_path() -> str:
    """The public byte-level vocabulary, where the installed package has it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes, targets and words taken of every document of the mix."""
    return mixing.word_counts(table(spark, folder, "documents"))


def op2_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return order_minhash.compare_edited(table(spark, folder, "documents"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Shingle set sizes and near-duplicate components of every document."""
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return main_text.main_text(table(spark, folder, "pages"))


def op5_additive_model(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of every document, learnt outside the held-out fold."""
    return additive_model.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of every document, learnt outside the held-out fold."""
    return toxicity.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_private_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts, a hash of the base spans, all spans."""
    return private_data.digest(table(spark, folder, "documents"))


def op8_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of every document."""
    return byte_pairs.round_trip(table(spark, folder, "documents"), tokenizer_path())


def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs and passages that repeat across documents."""
    return passages.repeats(table(spark, folder, "documents"))


def op10_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and the learnt decision list over every document."""
    docs = table(spark, folder, "documents")
    return decision_list.apply(docs, decision_list.fit(docs, table(spark, folder, "labels")))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, some misspelt, with the form each goes to."""
    return spelling.grouped(table(spark, folder, "documents"))


def op12_conversation(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged conversations: faults, cost and initials of the cheapest edits, digest of the repaired rows."""
    return conversation.audited(table(spark, folder, "conversations"))


def op13_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as it is read back from a content-addressed WARC archive."""
    return archive.archived(table(spark, folder, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_order_minhash": op2_order_minhash,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_main_text": op4_main_text,
    "op5_additive_model": op5_additive_model,
    "op6_toxicity": op6_toxicity,
    "op7_private_data": op7_private_data,
    "op8_byte_pairs": op8_byte_pairs,
    "op9_passages": op9_passages,
    "op10_decision_list": op10_decision_list,
    "op11_spelling": op11_spelling,
    "op12_conversation": op12_conversation,
    "op13_archive": op13_archive,
}

ORACLE: dict[str, str] = {
    "op1_mixing": mixing.sql(),
    "op13_archive": archive.sql(),
}
