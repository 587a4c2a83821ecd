"""Which titles repeat: one pass over the titles, with a sketch in every task.

A frequent-items sketch holds a fixed number of titles whatever the table holds, so that nothing is
shuffled by title: tasks hand over one sketch each, a few reducers merge them, the last one
names the titles that repeat. A title with more than ``4 / tracked`` of the rows is
always among them; a title that is missed, or counted too low, is only scored where it stands.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelabels.session import checkpointed

#: Longer titles are tracked by their hash, so that a sketch is bounded in bytes.
TRACKED_BYTES = 256
#: Reducers that merge the sketches of the tasks.
MERGERS = 256
#: Titles that a task scores.
TASK_TITLES = 2_000


@dataclass(frozen=True)
class Repeated:
    """``titles`` (``title, n``): repeated titles with about their number of rows, ``count`` of them; ``rows`` of the table."""

    titles: DataFrame
    count: int
    rows: int


def tracked_items(most: int) -> int:
    """Size of the sketch for ``most`` titles: a power of two of which three quarters are used."""
    return min(1 << max(6, ceil(log2(most / 0.75))), 1 << 19)


def _sketched(df: DataFrame, title_col: str, most: int) -> DataFrame:
    """One row (none for an empty table): ``rows``, and the most frequent ``short`` titles and hashes of ``long`` ones, with counts."""
    size = tracked_items(most)
    is_short = F.octet_length("t") <= TRACKED_BYTES
    titles = df.select(F.col(title_col).alias("t")).select(
        F.when(is_short, F.col("t")).alias("short"),
        F.when(~is_short, F.xxhash64("t")).alias("long"),
        (F.spark_partition_id() % MERGERS).alias("part"),
    )
    # Null stands for "not of this kind" and for titles without text, which need no lookup.
    each = titles.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k_accumulate({c}, {size})").alias(c) for c in ("short", "long")],
    )
    # Grouped, so that an empty table gives no row: there is no sketch of nothing.
    whole = each.groupBy(F.lit(0).alias("all")).agg(
        F.sum("rows").alias("rows"),
        *[F.expr(f"approx_top_k_combine({c}, {size})").alias(c) for c in ("short", "long")],
    )
    found = {c: F.expr(f"filter(approx_top_k_estimate({c}, {min(most + 1, size)}), i -> i.item IS NOT NULL AND i.count > 1)") for c in ("short", "long")}
    return whole.drop("all").withColumns({c: F.slice(v, 1, most) for c, v in found.items()})


def repeated_titles(df: DataFrame, title_col: str, most: int) -> Repeated:
    """The titles of ``df`` that repeat, the most frequent ``most`` of them at most.

    The title column is read once, and a second time only where long titles repeat, to fetch their texts.
    """
    found = checkpointed(_sketched(df, title_col, most))
    sizes = found.select("rows", F.size("short").alias("short"), F.size("long").alias("long")).first()
    sizes = sizes or {"rows": 0, "short": 0, "long": 0}
    titles = found.select(F.inline("short")).toDF("title", "n")
    if sizes["long"]:
        hashes = found.select(F.inline("long")).toDF("__h", "__n")
        texts = df.select(F.col(title_col).alias("title")).where(F.octet_length("title") > TRACKED_BYTES)
        texts = texts.join(F.broadcast(hashes), F.xxhash64("title") == F.col("__h"))
        titles = titles.unionByName(texts.groupBy("title").agg(F.count(F.lit(1)).alias("n")))
        titles = titles.orderBy(F.col("n").desc(), "title").limit(most)
    count = min(sizes["short"] + sizes["long"], most)
    return Repeated(titles.repartition(max(1, ceil(count / TASK_TITLES))), count, sizes["rows"])
