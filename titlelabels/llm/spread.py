"""Joins of rows with one row per key, where one key may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with at least 1/HOT of all rows is hot, so that at most HOT keys are.
HOT = 256
#: Parts that the rows of a hot key are dealt into.
PARTS = 64


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], count: str, spread: Sequence[Column | str], how: str = "inner"
) -> DataFrame:
    """``rows`` joined to ``groups`` on ``keys``, hot keys in parts.

    ``groups`` has one row per key, is kept on disk (it is read three times), and ``count`` says
    how many rows have the key. Hot keys are at most ``HOT`` whatever the data, so they are
    broadcast to tell their rows; a hash of ``spread`` deals those rows to ``PARTS`` tasks and
    the group's row goes to each of them. No null may be in ``keys``.
    """
    total = groups.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    hot = F.col(count) * HOT >= F.lit(max(total, HOT)).cast("long")
    keys = list(keys)
    names = groups.where(hot & (F.col(count) > PARTS)).select(*keys, F.lit(True).alias("__hot"))
    part = F.when(F.col("__hot"), F.pmod(F.xxhash64(*spread), F.lit(PARTS)).cast("int")).otherwise(0)
    dealt = rows.join(F.broadcast(names), keys, "left").withColumn("__part", part).drop("__hot")
    parts = F.when(hot & (F.col(count) > PARTS), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    copies = groups.withColumn("__part", F.explode(parts))
    return dealt.join(copies, [*keys, "__part"], how).drop("__part")
