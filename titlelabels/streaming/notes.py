"""Labelling notes as they arrive.

The rule stage is a stateless projection, so it runs on a stream as it stands.
The full labelling uses a join of distinct titles and therefore works per
micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from titlelabels.operators.classify import Labeller, classify_notes
from titlelabels.operators.rules import rule_struct
from titlelabels.rulepack import RULES, Rule
from titlelabels.session import scratch


def with_rule_struct(stream: DataFrame, title_col: str = "note_title", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the rule-stage struct ``rules`` to a streaming (or batch) frame."""
    return stream.withColumn("rules", rule_struct(title_col, rules))


def label_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    title_col: str = "note_title",
    labeller: Labeller | None = None,
) -> StreamingQuery:
    """Label every micro-batch and hand it to ``write(batch, batch_id)``.

    A batch can come again after a failure, so ``write`` must replace what it
    wrote for the same ``batch_id``. It must write before it returns: what the
    batch kept on the way is deleted then.
    """

    def label(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            write(classify_notes(batch, title_col, labeller), number)

    return (
        stream.writeStream.foreachBatch(label)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
