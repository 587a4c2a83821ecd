"""What the operators share: table reading, Arrow row functions, words, labelled samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: What separates words: space and the control characters 9 to 13, as ``bytes.split()`` has it.
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows of an Arrow batch that are Python objects at the same time.
SLICE = 512
#: The most labelled rows that a model is fitted on.
FIT_ROWS = 20_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_rows(
    df: DataFrame,
    inputs: Sequence[str],
    outputs: T.StructType | str,
    build: Callable[[], Callable[..., tuple | None]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """A row function over Arrow batches.

    ``build()`` runs once per task and returns a function of the values of ``inputs`` that
    gives one tuple for ``outputs``, or ``None`` where the row goes. ``keep`` names columns
    that go through as they are; an output of the same name takes a column's place.
    """
    if isinstance(outputs, str):
        outputs = T.StructType.fromDDL(outputs)
    keep = [c for c in keep if c not in outputs.names]
    wanted = list(dict.fromkeys([*keep, *inputs]))
    schema = T.StructType([df.schema[c] for c in keep] + outputs.fields)
    types = to_arrow_schema(outputs).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = build()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                values = [batch.column(wanted.index(c)).to_pylist() for c in inputs]
                made = [function(*row) for row in zip(*values, strict=True)]
                there = [row is not None for row in made]
                kept = [batch.column(wanted.index(c)) for c in keep]
                if not all(there):
                    mask = pa.array(there, pa.bool_())
                    kept, made = [c.filter(mask) for c in kept], [row for row in made if row is not None]
                columns = list(zip(*made, strict=True)) if made else [()] * len(types)
                kept += [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(kept, names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in wanted]).mapInArrow(run, schema)


def remainder(column: str, parts: int) -> F.Column:
    """crc32 of a value's text modulo ``parts``; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, learn: F.Column, bound: int = FIT_ROWS, id_col: str = "doc_id"
) -> DataFrame:
    """Documents with a 0/1 label that may be learnt from: columns ``text`` and ``label``.

    At most about ``bound`` rows, picked by a hash of the id, so that the set is the same in
    every run; ids with two different labels, null labels and null ids are left out. The
    bounded side is broadcast.
    """
    seen = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & learn)
    seen = seen.groupBy(id_col).agg(F.min(label).alias("label"), F.max(label).alias("_most"))
    seen = seen.where("label = _most").select(F.col(id_col).alias("_id"), "label")
    rows = seen.count()
    if rows > bound:
        seen = seen.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(bound / rows * (1 << 30)))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(seen), "_id").select("_id", "text", "label")
