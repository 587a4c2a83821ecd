"""Writing labelled notes."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlelabels.anchors import anchor_json
from titlelabels.functions.text import literal
from titlelabels.taxonomy import ROLE, ROLE_LABELS, TYPE, TYPE_LABELS

# Scalar columns by which a reader can skip files; arrays have no useful minimum and maximum.
ROLE_KEY, TYPE_KEY = "role_key", "type_key"

# Fixed values.
SOURCES = ("EMPTY", "RULES", "RULES+EMBEDDING", "EMBEDDING")


def with_layout_keys(df: DataFrame) -> DataFrame:
    """Add ``role_key`` and ``type_key``, the label lists as text."""
    return df.withColumns(
        {ROLE_KEY: F.array_join("note_roles", "|"), TYPE_KEY: F.array_join("note_types", "|")}
    )


def label_mask(labels: Column, dim: str) -> Column:
    """Bit n is set if the list holds the n-th label of the taxonomy, the bit above them if it holds any other."""
    names = ROLE_LABELS if dim == ROLE else TYPE_LABELS
    mask = F.lit(0).cast("bigint")
    for n, name in enumerate(names):
        mask = mask + F.when(F.array_contains(labels, name), F.lit(1 << n)).otherwise(F.lit(0))
    others = F.size(F.array_except(labels, F.array(*map(F.lit, names)))) > 0
    return mask + F.when(others, F.lit(1 << len(names))).otherwise(F.lit(0))


def z_value(roles: Column, note_types: Column, source: Column) -> Column:
    """Interleaved bits of the three keys, highest bits first."""
    keys = [
        (label_mask(roles, ROLE), len(ROLE_LABELS) + 1),
        (label_mask(note_types, TYPE), len(TYPE_LABELS) + 1),
        (F.array_position(F.array(*map(F.lit, SOURCES)), source), 3),
    ]
    bits: list[Column] = []
    for depth in range(max(width for _, width in keys)):
        for value, width in keys:
            if depth < width:
                bits.append(F.shiftright(value, width - 1 - depth).bitwiseAND(F.lit(1)))
    out = F.lit(0).cast("bigint")
    for bit in bits:
        out = out * 2 + bit
    return out


def layout_key(z_order: bool = False) -> Column:
    """What rows are laid out by: the label lists and the source as one text, or their interleaved bits."""
    if z_order:
        return z_value(F.col("note_roles"), F.col("note_types"), F.col("clf_source"))
    # The separator sorts below every letter, so that texts are in the order of the three keys.
    return F.concat_ws("\x01", F.array_join("note_roles", "|"), F.array_join("note_types", "|"), "clf_source")


def range_bounds(weights: Sequence[tuple[str | int, float]], files: int) -> list[str | int]:
    """The ``files - 1`` keys at which equal shares of the weight begin; a heavy key stands more than once."""
    weights = sorted(weights)
    total = sum(w for _, w in weights)
    bounds, below = [], 0.0
    for key, weight in weights:
        below += weight
        while len(bounds) < files - 1 and below > total * (len(bounds) + 1) / files:
            bounds.append(key)
    return bounds


def _below(key: str, bounds: list[str | int], equal: bool) -> str:
    """How many bounds lie below ``key`` (or are equal to it), by binary search in a literal."""
    if not bounds:
        return "0"
    kind = "string" if isinstance(bounds[0], str) else "bigint"
    listed = f"from_json({literal(json.dumps(bounds))}, 'array<{kind}>')"
    steps = ", ".join(str(1 << k) for k in reversed(range(len(bounds).bit_length())))
    sign = "<=" if equal else "<"
    return f"aggregate(array({steps}), 0, (at, s) -> if(at + s <= {len(bounds)} AND get({listed}, at + s - 1) {sign} {key}, at + s, at))"


def arrange(
    df: DataFrame, files: int | None = None, z_order: bool = False, weights: Sequence[tuple[str | int, float]] | None = None
) -> DataFrame:
    """Rows with equal labels and source side by side: a range shuffle and a sort inside each task.

    ``weights`` (a :func:`layout_key` and its share of the rows, as :func:`layout_weights` gives them) set
    the ranges, so that ``df`` is computed once; without them Spark samples it first. One combination of labels may hold a
    large part of all rows, also of one task's: it gets several ranges, and a hash of the row's own columns and its task
    deals its rows to them; the hash stays the same when a task is run again.
    """
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "struct", "array", "variant")]
    cut = F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.spark_partition_id())
    out = df.withColumns({"__key": layout_key(z_order), "__task": cut})
    if weights is None:
        ranged = out.repartitionByRange(*([files] if files else []), "__key", "__task")
    else:
        files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bounds = range_bounds(weights, files)
        first, last = (F.expr(_below("__key", bounds, equal)) for equal in (False, True))
        out = out.withColumns({"__first": first, "__last": last})
        file = F.col("__first") + F.pmod(F.col("__task"), F.col("__last") - F.col("__first") + 1)
        ranged = out.repartitionById(files, file.cast("int")).drop("__first", "__last")
    return ranged.sortWithinPartitions("__key").drop("__key", "__task")


def cluster_by_labels(
    df: DataFrame, files: int | None = None, z_order: bool = False, weights: Sequence[tuple[str | int, float]] | None = None
) -> DataFrame:
    """Labelled notes as :func:`arrange` lays them out, with their layout keys, which are made behind the sort."""
    return with_layout_keys(arrange(df, files, z_order, weights))


def write_notes(
    df: DataFrame,
    *,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    files: int | None = None,
    cluster: bool = True,
    z_order: bool = False,
    weights: Sequence[tuple[str | int, float]] | None = None,
) -> None:
    """Write labelled notes to a table or a path, replacing its rows and its schema."""
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    out = cluster_by_labels(df, files, z_order, weights) if cluster else df
    writer = out.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if table is not None:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def file_ranges(spark: SparkSession, path: str, z_order: bool = False) -> DataFrame:
    """Of every file of written notes: ``file, n_notes`` and its least and greatest :func:`layout_key`."""
    notes = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("__file"))
    keyed = notes.select(F.col("__file").alias("file"), layout_key(z_order).alias("key"))
    # Keys are few; the least of a text over all rows would sort them.
    counted = keyed.groupBy("file", "key").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("file").agg(F.sum("n").alias("n_notes"), F.min("key").alias("least"), F.max("key").alias("most"))


def layout_report(spark: SparkSession, path: str, z_order: bool = False) -> DataFrame:
    """One row on written notes: ``n_notes``, ``n_files``, ``n_overlaps`` (files whose keys reach beyond the first key of
    the next file) and ``largest_share`` (the largest file's rows by the mean)."""
    # One row a file; the window orders files, not rows.
    files = file_ranges(spark, path, z_order)
    following = F.lead("least").over(Window.orderBy("least", "most"))
    marked = files.withColumn("overlaps", F.coalesce(F.col("most") > following, F.lit(False)).cast("int"))
    return marked.agg(
        F.coalesce(F.sum("n_notes"), F.lit(0)).alias("n_notes"),
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("overlaps"), F.lit(0)).alias("n_overlaps"),
        (F.max("n_notes") / F.avg("n_notes")).alias("largest_share"),
    )


def write_anchors(anchors: DataFrame, path: str) -> None:
    """One JSON object (label to phrases) per dimension, below ``path/dim=...``."""
    anchor_json(anchors).write.mode("overwrite").partitionBy("dim").text(path)
