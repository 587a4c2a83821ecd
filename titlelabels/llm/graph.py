"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelabels.session import checkpointed

#: Rows that a task of a small table takes.
TASK_ROWS = 50_000


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def compact(df: DataFrame) -> DataFrame:
    """The rows kept in the shared folder, read back by as many tasks as their number asks for.

    A small table in very many partitions costs files and tasks in every shuffle that follows.
    """
    kept = checkpointed(df)
    return kept.coalesce(tasks_for(kept.count()))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes in ``links`` (columns a and b).

    Stars in turn: every node hands its larger neighbours to the smallest one it knows, then
    its smaller ones. Paths halve in every round; a group of any size costs one row a node,
    and a node with very many neighbours is a skewed join, which Spark splits.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, before = compact(edges), None
    while True:
        tasks = tasks_for(2 * edges.count())
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        others = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = compact(others.unionByName(least.select("a", F.col("m").alias("b"))).coalesce(tasks).distinct().coalesce(tasks))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
