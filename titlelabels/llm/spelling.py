"""Spelling variants: words one inserted, deleted or replaced letter apart, and the form each goes to.

Words of the vocabulary are held in bit sets, one bit a word: for a place and a letter, which
words have that letter there. A word is looked up in all of them at a time: the set of words
equal so far (no error) and the sets of words with one error so far, one for a replaced letter
(same place) and one for a letter more (places shifted by one), go from letter to letter by word-parallel
and, or and not. Bits of the right length left at the end are its neighbours, exactly.

Words one error apart share the first half or the rest of the shorter one's letters, so words meet only
under these; an index holds at most ``BLOCK`` words, words beyond that under the same half
are in further indexes, and each word is looked up in all of them. No pair is lost or found twice.

Null texts have no words and a null id is written as nothing in the number that chooses misspellings. Runs of
letters are counted in each task before they are shuffled; extra columns do not take part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelabels.llm.common import SLICE
from titlelabels.session import checkpointed, scratch, shared_folder

# Fixed values of the query.
LETTERS = "a-zÀ-ÿ"
MISSPELT = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form has at least so many times the occurrences of its variant.
RATIO = 5

#: Words of one index.
BLOCK = 8_192

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Words


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", misspelt: int | None = MISSPELT) -> DataFrame:
    """``word, n``: runs of at least ``LEAST_LENGTH`` letters, A to Z in lower case, and how often they occur.

    With ``misspelt``, runs whose number (a crc32 of id and run) it divides lose the letter that the number names.
    """
    runs = F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("run"))
    word = F.col("run")
    if misspelt is not None:
        rows = rows.withColumn("h", F.crc32(F.concat("_id", F.lit(":"), "run")))
        at = (F.col("h") % F.length("run")).cast("int")
        less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
        word = F.when(F.col("h") % misspelt == 0, less).otherwise(word)
    rows = rows.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# The index


class BitIndex:
    """Bit sets by place and letter over a list of words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.letters: dict[tuple[int, str], int] = defaultdict(int)
        self.lengths: dict[int, int] = defaultdict(int)
        at: dict[tuple[int, str], bytearray] = {}
        size = len(words) // 8 + 1
        for k, word in enumerate(words):
            byte, bit = k >> 3, 1 << (k & 7)
            for key in (*enumerate(word), (len(word), "")):
                if key not in at:
                    at[key] = bytearray(size)
                at[key][byte] |= bit
        for (place, letter), bits in at.items():
            (self.letters if letter else self.lengths)[place if not letter else (place, letter)] = int.from_bytes(bits, "little")
        self.all = (1 << len(words)) - 1

    def near(self, word: str) -> int:
        """Words of the index one replaced letter away, or with one letter more, as bits."""
        get = self.letters.get
        same = self.all  # no error so far
        other = 0  # one replaced letter so far
        more = 0  # one more letter so far: their places are one ahead
        for place, letter in enumerate(word):
            here = get((place, letter), 0)
            more = (more | same) & get((place + 1, letter), 0)
            other = (other & here) | (same & ~here)
            same &= here
        n = len(word)
        # A longer word may end with its one more letter.
        return (other & self.lengths.get(n, 0)) | ((more | same) & self.lengths.get(n + 1, 0))

    def found(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low


def _common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def meetings(words: DataFrame) -> DataFrame:
    """Rows that words are dealt by: ``half`` (which letters, of which length, they share), ``asks``, ``block``, ``word``, ``n``.

    A word asks under the halves of its own length and is in the index under these and those of
    the words one letter shorter.
    """
    own, less = F.length("word"), F.length("word") - 1

    def halves(size, asks: bool):
        head = F.floor(size / 2).cast("int")
        first = F.substring("word", 1, head)
        rest = F.substr("word", F.length("word") - (size - head) + 1)
        return [
            F.struct(F.concat_ws(" ", size.cast("string"), F.lit(side), part).alias("half"), F.lit(asks).alias("asks"))
            for side, part in (("<", first), (">", rest))
        ]

    dealt = words.select("word", "n", F.inline(F.array(*halves(own, True), *halves(less, False))))
    sizes = dealt.groupBy("half").agg(F.count("*").alias("size"), F.max("asks").alias("asked")).where("size > 1 AND asked")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = dealt.join(sizes.select("half", blocks.alias("blocks")), "half")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    held = dealt.select("half", block.alias("block"), F.lit(False).alias("asks"), "word", "n")
    ask = dealt.where("asks").select("half", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"), "word", "n")
    return held.unionByName(ask)


def links(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every pair of words one error apart, in both directions."""
    fields = [("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, index, out = None, [], None, []
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                columns = [c.to_pylist() for c in whole.slice(start, SLICE).columns]
                for half, block, asks, word, n in zip(*columns, strict=True):
                    if (half, block) != group:
                        group, held, index = (half, block), [], None
                    if not asks:
                        held.append((word, n))
                        continue
                    if index is None:
                        index = BitIndex([w for w, _ in held])
                    size = len(word)
                    for k in index.found(index.near(word)):
                        other, m = held[k]
                        # Words that share the first half meet there; here only the others count.
                        if " > " in half and _common_prefix(word, other) >= size // 2:
                            continue
                        if len(other) > size:
                            out.append((other, word, n))
                        out.append((word, other, m))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)], schema=schema)
                    out = []
        yield pa.RecordBatch.from_arrays([pa.array([], t) for _, t in fields], schema=schema)

    dealt = meetings(words).repartition("half", "block").sortWithinPartitions("half", "block", "asks")
    return dealt.select("half", "block", "asks", "word", "n").mapInArrow(run, "word string, near string, near_n long")


# Forms


def variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary (``word, n``), written to the shared folder.

    A form has ``RATIO`` times its variant's occurrences or more, so that a chain of forms is as long as a
    logarithm of the largest count; roots double their steps in every round.
    """
    spark = words.sparkSession
    path = shared_folder(spark)
    with scratch(spark):
        words = checkpointed(words)
        # Most occurrences first, then code-point order, which is the order of UTF-8.
        near = links(words).groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form"))).alias("best")
        )
        known = words.join(near, "word", "left")
        wins = -F.col("best.m") >= RATIO * F.col("n")
        known = checkpointed(
            known.select(
                "word",
                F.when(wins, F.col("best.form")).alias("form"),
                "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(wins, -F.col("best.m")).alias("form_n"),
            )
        )
        most = known.agg(F.max("form_n")).first()[0] or 0
        steps = checkpointed(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
        hops = 1 + int(log(max(most, 1), RATIO))
        for _ in range(ceil(log2(hops)) if hops > 1 else 0):
            ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
            steps = checkpointed(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        out = known.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
        out.select("word", "form", "root", "n", "n_near", "form_n").write.parquet(path)
    return spark.read.parquet(path)


def grouped(docs: DataFrame, misspelt: int | None = MISSPELT) -> DataFrame:
    """The words of ``docs`` with at least ``LEAST_COUNT`` occurrences, their forms and roots."""
    return variants(occurrences(docs, misspelt=misspelt).where(F.col("n") >= LEAST_COUNT))
