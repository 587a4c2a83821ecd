"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, and the whole mix is one line in
virtual time: a document finishes when the words of its source up to and with it, divided by
the source's weight, have passed; a second round of the source follows the first. The mix is
cut at the virtual time at which the total budget is spent. A source that has ended by then
(two rounds) leaves its share to the others, which is the resharing by weight; the document
that runs over the cut gives the words before it.

The cut comes from one sum per source; places in a queue come from sums per slice of the
shuffled order, so that a source with a third of all rows is spread over the tasks. Only
DataFrame functions are used, and no order depends on the partitioning.

Null texts have no words, null sources form one source (the last), null ids count as the
empty id; equal rows share one place and are interchangeable. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlelabels.llm.common import WORD
from titlelabels.session import checkpointed

#: Weights of the sources in order of their names, over and over.
WEIGHTS = (5, 2, 1)
#: The mix in terms of all words, and how often a document may be taken.
BUDGET = 1.5
ROUNDS = 2


def sized(df: DataFrame, keep: list[str], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``keep`` columns, the words of each text, and a key that shuffles the rows the same way in every run."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text))
    return df.select(*keep, F.regexp_count(text, F.lit(WORD)).cast("long").alias("__mix_size"), key.alias("__mix_key"))


def targets(totals: DataFrame) -> DataFrame:
    """Weight, target and cut of every source; ``totals`` has one row a source: __mix_none, __mix_source, __mix_total."""
    rank = F.row_number().over(Window.orderBy("__mix_none", "__mix_source"))
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank - 1) % len(WEIGHTS) + 1).cast("double")
    most = F.col("__mix_total") * F.lit(float(ROUNDS))
    rows = totals.withColumn("__mix_weight", weights).withColumn("__mix_ends", most / F.col("__mix_weight"))
    # Sources end in the order of __mix_ends; before the k-th ends, those from it on share what the others left.
    # The levels fall once they lie below the end of their source, so the first such level is the highest.
    order = Window.orderBy("__mix_ends", "__mix_none", "__mix_source")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum(most).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    sharing = F.sum("__mix_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    cut = (F.sum("__mix_total").over(every) * F.lit(BUDGET) - before) / sharing
    rows = rows.withColumn("__mix_cut", cut)
    cut = F.max(F.when(F.col("__mix_cut") <= F.col("__mix_ends"), F.col("__mix_cut"))).over(every)
    target = F.least(most, F.col("__mix_weight") * F.coalesce("__mix_cut", F.lit(0.0)))
    return rows.withColumn("__mix_cut", cut).select("__mix_none", "__mix_source", "__mix_total", "__mix_weight", target.alias("__mix_target"))


def mix(rows: DataFrame, source_col: str = "source") -> DataFrame:
    """``rows`` (from ``sized``) with size, source_size, target, taken and virtual_finish in one column ``__mix``.

    ``taken`` counts the words of a document in the mix, at most ``ROUNDS`` times its size.
    """
    # About as many slices as each has rows: neither the sums nor a slice outgrow a task.
    slices = 1 << max(0, (max(rows.count(), 1).bit_length() + 1) // 2)
    slice_ = F.floor(F.conv(F.substring("__mix_key", 1, 8), 16, 10).cast("long") * slices / (1 << 32)).cast("int")
    rows = rows.withColumns(
        {"__mix_none": F.col(source_col).isNull(), "__mix_source": F.coalesce(F.col(source_col), F.lit("")), "__mix_slice": slice_}
    )
    keys = ["__mix_none", "__mix_source"]
    sums = rows.groupBy(*keys, "__mix_slice").agg(F.sum("__mix_size").alias("__mix_sum"))
    known = targets(sums.groupBy(*keys).agg(F.sum("__mix_sum").alias("__mix_total")))
    ahead = F.sum("__mix_sum").over(Window.partitionBy(*keys).orderBy("__mix_slice").rowsBetween(Window.unboundedPreceding, -1))
    heads = sums.withColumn("__mix_sum", F.coalesce(ahead, F.lit(0))).join(known, keys)
    # Each slice's head goes first in its window and brings what the rows need; no join with the rows.
    brought = ["__mix_total", "__mix_weight", "__mix_target"]
    heads = heads.withColumnRenamed("__mix_sum", "__mix_size").withColumn("__mix_key", F.lit(""))
    line = Window.partitionBy(*keys, "__mix_slice").orderBy("__mix_key", "__mix_size")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = rows.unionByName(heads, allowMissingColumns=True)
    placed = placed.withColumns(
        {c: F.max(c).over(whole) for c in brought}
        | {"__mix_done": F.sum("__mix_size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))}
    ).where("__mix_key <> ''")
    cut = F.floor(F.col("__mix_target") + 0.5)
    start = F.col("__mix_done") - F.col("__mix_size")
    rounds = [F.greatest(F.lit(0), F.least(F.col("__mix_size"), cut - start - F.col("__mix_total") * k)) for k in range(ROUNDS)]
    result = F.struct(
        F.col("__mix_size").alias("size"),
        F.col("__mix_total").alias("source_size"),
        F.col("__mix_target").alias("target"),
        sum(rounds[1:], rounds[0]).cast("long").alias("taken"),
        (F.col("__mix_done") / F.col("__mix_weight")).alias("virtual_finish"),
    )
    return placed.select(*[c for c in rows.columns if not c.startswith("__mix_")], result.alias("__mix"))


def word_counts(df: DataFrame) -> DataFrame:
    """Every document's size and the words of it that the mix takes, in the order of the mix."""
    out = mix(checkpointed(sized(df, ["doc_id", "source"]))).select("doc_id", "__mix.*")
    return out.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish").orderBy("virtual_finish", "doc_id")


def mixed(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """The documents of the mix, each as often as it is taken; whole ones only.

    A document at the cut is in where at least half its words lie before it, so that a
    source stays within half a document of its target. Documents without words are not in the mix.
    """
    rows = mix(sized(df, df.columns, text_col, id_col), source_col)
    copies = F.floor(F.col("__mix.taken") / F.col("__mix.size") + 0.5).cast("int")
    return rows.where("__mix.size > 0").select(*df.columns, copies.alias("__mix_copies")).where("__mix_copies > 0").select(
        *df.columns, F.explode(F.array_repeat(F.lit(1), F.col("__mix_copies"))).alias("__mix_copy")
    ).drop("__mix_copy")


def sql(documents: str = "documents") -> str:
    """``word_counts`` in DuckDB's SQL."""
    return f"""
    WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
             md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS k
      FROM {documents}
    ), totals AS (
      SELECT source, sum(size)::DOUBLE AS total, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM sized GROUP BY source
    ), weighed AS (
      SELECT source, total, CASE (r - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, r FROM totals
    ), shared AS (
      SELECT *, (sum(total) OVER () * 1.5::DOUBLE
                 - coalesce(sum(2 * total) OVER (ORDER BY 2 * total / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY 2 * total / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM weighed
    ), targets AS (
      SELECT source, total, weight,
             least(2 * total, weight * (SELECT max(level) FROM shared WHERE level <= 2 * total / weight)) AS target
      FROM shared
    ), placed AS (
      SELECT d.*, t.total, t.weight, t.target,
             sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS done
      FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size::BIGINT AS size, total::BIGINT AS source_size, target,
           (greatest(0, least(size, floor(target + 0.5) - (done - size)))
            + greatest(0, least(size, floor(target + 0.5) - (done - size) - total)))::BIGINT AS taken,
           done / weight AS virtual_finish
    FROM placed
    """
