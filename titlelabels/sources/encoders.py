"""Encoders: from a title to its vector.

An encoder adds a vector column to a frame of titles. Three are given: hashed
tokens (pure expressions), a table of known vectors (a join), and a local model
behind an Arrow iterator UDF. ``per_row`` says whether encoding a title again
for every row that carries it is cheap; if not, distinct titles are encoded.
"""

from __future__ import annotations

from abc import ABC
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelabels.functions.text import let
from titlelabels.functions.vectors import unit

BATCH = 64  # fixed value: titles per call of a model


class Encoder(ABC):
    sparse = False
    per_row = False
    by_title = True  # equal titles have equal vectors

    def renamed(self, names: dict[str, str]) -> Encoder:
        """The encoder for a frame whose columns were renamed."""
        return self

    def sql(self, title: str) -> str:
        """The vector as an SQL expression of the row, for encoders that are cheap per row."""
        raise NotImplementedError

    def add_vectors(self, df: DataFrame, title: str, out: str, wanted: str | None = None) -> DataFrame:
        """Add the vector of ``title`` as column ``out``; null where ``wanted`` is false."""
        return df.withColumn(out, F.expr(_where(wanted, self.sql(title))))

    def anchor_vectors(self, anchors: DataFrame) -> DataFrame:
        """Dense vectors of an anchor table: ``dim, label, v``."""
        return self.add_vectors(anchors, "phrase", "v").select("dim", "label", "v")


def _where(wanted: str | None, value: str) -> str:
    return value if wanted is None else f"CASE WHEN {wanted} THEN {value} END"


@dataclass(frozen=True)
class HashedTokens(Encoder):
    """Counts of hashed tokens, normalised to length 1; needs no model."""

    buckets: int = 256
    sparse = True
    per_row = True

    def bucket_list(self, title: str) -> str:
        """Ascending bucket numbers of all tokens, repeats included."""
        tokens = f"filter(split(upper({title}), '[^\\\\p{{L}}\\\\p{{N}}]+'), tok -> tok != '')"
        number = "cast(conv(substr(md5(cast(tok AS binary)), 1, 8), 16, 10) AS bigint)"
        return f"array_sort(transform({tokens}, tok -> cast(pmod({number}, {self.buckets}) AS int)))"

    def sql(self, title: str) -> str:
        """Sparse unit vector."""
        counts = "transform(array_distinct(bs), b -> named_struct('i', b, 'n', cast(size(filter(bs, o -> o = b)) AS double)))"
        length = "sqrt(aggregate(cs, 0.0D, (acc, e) -> acc + e.n * e.n))"
        scaled = let("ln", length, "transform(cs, e -> named_struct('i', e.i, 'x', e.n / ln))")
        return let("bs", self.bucket_list(title), let("cs", counts, scaled))

    def dense_sql(self, title: str) -> str:
        spread = f"transform(sequence(0, {self.buckets - 1}), i -> coalesce(try_element_at(m, i), 0.0D))"
        return let("m", f"map_from_entries({self.sql(title)})", spread)

    def anchor_vectors(self, anchors: DataFrame) -> DataFrame:
        return anchors.select("dim", "label", F.expr(self.dense_sql("phrase")).alias("v"))


class VectorTable(Encoder):
    """Vectors computed elsewhere: a table of titles with one vector each, of any length.

    ``anchors`` holds the vectors of the anchor phrases, ``dim, label, v``. A
    title that is not in the table is an error, or, with ``missing="rules"``,
    gets no scores and so what the rules say.
    """

    def __init__(
        self,
        vectors: DataFrame,
        anchors: DataFrame,
        title_col: str = "title",
        vector_col: str = "v",
        missing: str = "raise",
    ):
        if missing not in ("raise", "rules"):
            raise ValueError("missing must be 'raise' or 'rules'")
        found = vectors.select(F.col(title_col).alias("__vt_title"), F.col(vector_col).alias("__vt_v"))
        self.vectors = normalised(found, "__vt_v")
        self.anchors = anchors
        self.missing = missing

    def add_vectors(self, df: DataFrame, title: str, out: str, wanted: str | None = None) -> DataFrame:
        keyed = df.withColumn("__vt_key", F.expr(_where(wanted, title)))
        # Rows that want no vector stay out of the join, where they would share one key.
        asking = keyed.filter(F.col("__vt_key").isNotNull())
        titles = asking.select(F.col("__vt_key").alias("__vt_title")).distinct()
        # Only wanted vectors are brought together: one row per title, so that the join cannot multiply rows.
        known = self.vectors.join(titles, "__vt_title", "left_semi").groupBy("__vt_title").agg(F.min("__vt_v").alias("__vt_v"))
        joined = asking.join(known, F.col("__vt_key") == F.col("__vt_title"), "left")
        vector = F.col("__vt_v")
        if self.missing == "raise":
            vector = F.coalesce(vector, F.raise_error(F.concat(F.lit("no vector for title "), "__vt_key")).cast("array<double>"))
        joined = joined.withColumn(out, vector).drop("__vt_title", "__vt_v")
        rest = keyed.filter(F.col("__vt_key").isNull()).withColumn(out, F.lit(None).cast("array<double>"))
        return joined.unionByName(rest).drop("__vt_key")

    def anchor_vectors(self, anchors: DataFrame) -> DataFrame:
        return normalised(self.anchors.select("dim", "label", "v"))


@dataclass(frozen=True)
class VectorColumn(Encoder):
    """The vector stands beside the title already, in column ``vector_col``, of any length."""

    vector_col: str
    anchors: DataFrame
    per_row = True
    by_title = False

    def renamed(self, names: dict[str, str]) -> Encoder:
        return VectorColumn(names[self.vector_col], self.anchors)

    def sql(self, title: str) -> str:
        return let("raw", f"cast({self.vector_col} AS array<double>)", unit("raw"))

    def anchor_vectors(self, anchors: DataFrame) -> DataFrame:
        return normalised(self.anchors.select("dim", "label", "v"))


@lru_cache(maxsize=4)
def loaded_model(load: Callable, path: str) -> Callable[[list[str]], np.ndarray]:
    """The model of this Python worker, loaded on first use and kept for later tasks."""
    return load(path)


def unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=m.astype("float64"), where=length > 0)


@dataclass(frozen=True)
class ModelVectors(Encoder):
    """A local model. ``load(path)`` gives a function from texts to a matrix.

    ``load`` must be importable on the workers; it is called once per worker.
    """

    load: Callable
    path: str

    def add_vectors(self, df: DataFrame, title: str, out: str, wanted: str | None = None) -> DataFrame:
        load, path = self.load, self.path

        @F.pandas_udf("array<double>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = loaded_model(load, path)
            for titles in batches:
                vectors = pd.Series([None] * len(titles), index=titles.index, dtype="object")
                known = titles[titles.notna()]
                for at in range(0, len(known), BATCH):
                    part = known.iloc[at : at + BATCH]
                    m = unit_rows(np.asarray(model(part.tolist()), dtype="float64"))
                    vectors.loc[part.index] = pd.Series(list(m), index=part.index, dtype="object")
                yield vectors

        return df.withColumn(out, encode(F.expr(_where(wanted, title))))


def normalised(vectors: DataFrame, vector_col: str = "v") -> DataFrame:
    """Vectors cast to double and scaled to length 1."""
    return vectors.withColumn(vector_col, F.expr(let("vec", f"cast({vector_col} AS array<double>)", unit("vec"))))
