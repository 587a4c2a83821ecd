"""Document fingerprints by order MinHash.

A text is the sequence of its pieces of ``WORDS`` words, each numbered by how often it came before.
For each of ``HASHES`` hash functions the ``PICKED`` least numbered pieces are selected, put
back into text order and hashed together. Two texts agree in a value only where both share
the pieces and their order, so that the share of equal values falls with the edit distance,
also where only the order of parts changed.

Null texts, empty ones and those without words have the fingerprint of no pieces (all zeros);
a text of fewer words than ``WORDS`` is one piece. Equal texts have equal fingerprints at any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelabels.llm.common import SLICE, map_rows
from titlelabels.llm.words import mix, shingles, word_hashes

WORDS = 2
PICKED = 2
HASHES = 64
#: Pieces hashed at a time, so that a block of all hash functions stays in the cache.
BLOCK = 4096

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MASKS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_ROWS = np.arange(HASHES)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def numbered_pieces(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pieces with their occurrence numbers, and their places in the text.

    A piece's hash depends on the piece and its number alone, not on the text around it.
    """
    pieces = shingles(word_hashes(text.encode())[0], WORDS)
    n = len(pieces)
    places = np.argsort(pieces, kind="stable")  # by piece, then place
    keyed = pieces[places]
    first = np.flatnonzero(np.concatenate([[True], keyed[1:] != keyed[:-1]])) if n else np.zeros(0, np.int64)
    number = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return mix(keyed + number.astype(np.uint64) * _BASE), places


def signature(text: str | None) -> np.ndarray:
    """``HASHES`` values of 16 bits."""
    pieces, places = numbered_pieces(text or "")
    if not len(pieces):
        return np.zeros(HASHES, np.uint16)
    short = (pieces >> np.uint64(32)).astype(np.uint32)
    best, at = [], []
    for start in range(0, len(short), BLOCK):
        values = (short[start : start + BLOCK] ^ _MASKS[:, None]) * _FACTORS[:, None]
        for _ in range(min(PICKED, values.shape[1])):
            least = values.argmin(axis=1)
            best.append(values[_ROWS, least])
            at.append(least + start)
            values[_ROWS, least] = 0xFFFFFFFF
    at = np.array(at)
    if len(at) > PICKED:  # the least of the blocks' least
        order = np.argsort(np.array(best), axis=0, kind="stable")[:PICKED]
        at = np.take_along_axis(at, order, axis=0)
    at = np.take_along_axis(at, np.argsort(places[at], axis=0), axis=0)
    value = np.zeros(HASHES, np.uint64)
    for row in at:
        value = mix(value * _BASE + pieces[row])
    return (value >> np.uint64(48)).astype(np.uint16)


def written(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values, 0 to 1."""
    return float((a == b).mean())


def fingerprints(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the fingerprint of every row's text."""
    return map_rows(df, [text_col], "fingerprint string", lambda: lambda t: (written(signature(t)),), keep)


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows in blocks of neighbouring ids, each block with the first row of the next one.

    Blocks run by descending id (nulls last, as one block) and in a circle, so that a row and the one after it
    meet in one task while each text is shuffled once. Cuts come from the ids alone. Returns
    ``_id``, ``_text``, ``_block`` and ``_guest`` (true for the first row of the next block),
    sorted in each partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    shares = [k / parts for k in range(1, parts)]
    cuts = sorted(set(rows.stat.approxQuantile("_id", shares, 0.1 / parts))) if shares else []
    block = F.lit(0).cast("int")
    if cuts:
        # Binary search: how many cuts lie below the id.
        steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
        found = ",".join(f"{int(c)}L" for c in cuts)
        block = F.expr(
            f"aggregate(array({','.join(map(str, steps))}), 0, (a, s) -> "
            f"if(a + s <= {len(cuts)} and get(array({found}), a + s - 1) < _id, a + s, a))"
        )
    rows = rows.withColumn("_block", F.when(F.col("_id").isNull(), -1).otherwise(block))
    heads = {r[0]: r[1] for r in rows.groupBy("_block").agg(F.max("_id")).collect()}  # one row a block
    order = sorted(heads)
    to = {b: order[(k + 1) % len(order)] for k, b in enumerate(order)}
    here = F.struct(F.col("_block").alias("block"), F.lit(False).alias("guest"))
    places = F.array(here)
    if order:
        host = F.element_at(F.create_map(*[F.lit(x) for b in order for x in (b, to[b])]), F.col("_block"))
        head = F.element_at(F.create_map(*[F.lit(x) for b in order for x in (b, heads[b])]), F.col("_block"))
        there = F.struct(host.alias("block"), F.lit(True).alias("guest"))
        places = F.when(F.col("_id").eqNullSafe(head), F.array(here, there)).otherwise(places)
    dealt = rows.select("_id", "_text", F.explode(places).alias("_at"))
    dealt = dealt.select("_id", "_text", F.col("_at.block").alias("_block"), F.col("_at.guest").alias("_guest"))
    index = F.element_at(F.create_map(*[F.lit(x) for k, b in enumerate(order) for x in (b, k)]), F.col("_block")) if order else F.lit(0)
    return dealt.repartitionById(max(len(order), 1), index).sortWithinPartitions(
        F.col("_guest"), F.col("_id").desc_nulls_last(), F.col("_text")
    )


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last half (rounded down) replaced by as many first letters of the
    next document by descending id; after the last comes the first. Rows of equal id follow
    each other by text; null ids come last.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64())]
        + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [(c, pa.float64()) for c in ("near_edited", "near_next")]
    )

    def row(one, two):
        (i, text, own), (_, after, next_own) = one, two
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        changed = own if edited == text else signature(edited)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return i, n, digest, written(own), written(changed), likeness(own, changed), likeness(own, next_own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, closed = None, False
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                out = []
                batch = whole.slice(start, SLICE).to_pydict()
                for i, text, guest in zip(batch["_id"], batch["_text"], batch["_guest"], strict=True):
                    if closed:
                        break
                    here = (i, text, signature(text))
                    if waiting:
                        out.append(row(waiting, here))
                    waiting, closed = here, guest
                columns = list(zip(*out, strict=True)) if out else [()] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

    return with_next(df, id_col, text_col).select("_id", "_text", "_guest").mapInArrow(run, schema)
