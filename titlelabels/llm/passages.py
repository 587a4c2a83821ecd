"""Substring dedup: paragraphs by MinHash banding, and repeated passages inside paragraphs.

A paragraph is a line, or a block of consecutive lines under ``LEAST_WORDS`` words, as a set of
word shingles. Equal sets are one; a set of under ``LEAST_SET`` shingles is near no other. Its
MinHash is cut into bands tuned for recall (at similarity 0.8 a pair shares a band with
probability 0.998); paragraphs that collide in a band are compared, most often colliding one first, then
the nearest of different components, then all that no link connects yet, and linked where the exact
Jaccard similarity is 0.8 or more. Pairs that parity bits put out of reach need no sets. Connected
paragraphs are one cluster: its first occurrence stays, the others are removals.

A passage that repeats inside otherwise different paragraphs is found through windows of
``UNIT`` words that begin where a 5-gram has the least hash among its ``REACH`` neighbours.
Whatever the text around, any passage of over 50 words that two documents share holds such
a window, the same in both. These are seeds only: within ``REACH`` words of a seed that
repeats, every run of ``UNIT`` words is looked up, so that a shared run is found with its
real ends, and no word of it is between two windows. Repeated runs that touch in a document are one span.

Texts are read once for paragraphs, their bands and bits, and windows, by array operations over many texts; again only
where sets are compared and near seeds. Runs travel in pieces of neighbours: equal pieces have equal runs, and one of them is
looked up run by run.

Null texts and empty ones take no part. Repeats inside one
document are not repeats across documents and stay. Spans are in code points, ends exclusive. Rows
with equal ids count as one document; null ids are no document and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlelabels.llm.graph import compact, components
from titlelabels.llm.jaccard_join import BROADCAST_ROWS, FRAGMENTS, SIZE, connected, parity_bits_of, set_key, set_keys  # noqa: F401  set_key: of one set
from titlelabels.llm.words import LOWER, mix, shingles, shingles_at, word_hashes
from titlelabels.session import checkpointed, kept_at, scratch, shared_folder

LEAST_WORDS = 20
#: Two different sets of similarity 0.8 or more have so many shingles at least.
LEAST_SET = 4
UNIT = 20
REACH = 27
BANDS = 9
ROWS = 3
#: Bytes of text that are worked on at a time.
LETTERS = 1 << 18
#: Runs of a piece in the mean, and at most.
PIECE = 8
MOST = 64

_rng = np.random.default_rng(99)
_SEEDS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PLACES = _rng.integers(0, 1 << 63, UNIT, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PIECES = _rng.integers(0, 1 << 63, MOST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0xD6E8FEB86659FD93)


class Texts:
    """Words of many texts with their borders in code points, their paragraphs as word ranges and windows, all as arrays over all texts."""

    def __init__(self, coded: Sequence[bytes]):
        data = b"\n".join([*coded, b""]).translate(LOWER)
        self.words, starts, ends = word_hashes(data)
        letters = np.frombuffer(data, np.uint8)
        edges = np.cumsum([0, *(len(text) + 1 for text in coded)])
        if data.isascii():
            self.starts, self.ends, self.origin = starts, ends, edges[:-1]
        else:
            points = np.zeros(len(data) + 1, np.int64)
            np.cumsum((letters & 0xC0) != 0x80, out=points[1:])
            self.starts, self.ends, self.origin = points[starts], points[ends], points[edges[:-1]]
        #: The first word of every text, and the end of the last.
        self.borders = np.searchsorted(starts, edges)
        breaks = np.flatnonzero(letters == 10)
        self.lines = np.concatenate([[0], np.searchsorted(starts, breaks)])
        self.line_doc = np.searchsorted(edges, breaks, side="right") - 1
        self.grams = shingles(self.words, SIZE)

    def doc(self, word: np.ndarray) -> np.ndarray:
        """The text of every word."""
        return np.searchsorted(self.borders, word, side="right") - 1

    def ranges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end word and text of every line, and of every block of two or more short lines in a row."""
        a, b, doc = self.lines[:-1], self.lines[1:], self.line_doc
        short = (b > a) & (b - a < LEAST_WORDS)
        goes_on = np.concatenate([[False], short[1:] & short[:-1] & (doc[1:] == doc[:-1])])
        follows = np.append(goes_on[1:], False)
        first, last = np.flatnonzero(~goes_on & follows), np.flatnonzero(goes_on & ~follows)
        there = np.flatnonzero(b > a)
        return np.concatenate([a[there], a[first]]), np.concatenate([b[there], b[last]]), np.concatenate([doc[there], doc[first]])

    def sets(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted shingle sets of word ranges, one behind the other, and their sizes."""
        n = np.maximum(b - a - SIZE + 1, 1)
        offsets = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(a - offsets, n)
        found = self.grams[np.minimum(at, len(self.grams) - 1)] if len(n) else np.zeros(0, np.uint64)
        for used in range(1, SIZE):  # a range of fewer words is one shingle
            few = np.flatnonzero(b - a == used)
            if len(few):
                found[offsets[few]] = shingles_at(self.words, a[few], used)
        for x, y in zip(offsets.tolist(), (offsets + n).tolist(), strict=True):
            if y - x > 1:
                found[x:y].sort()
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        new[offsets] = True
        sizes = np.add.reduceat(new, offsets, dtype=np.int64) if len(n) else n
        return found[new], sizes

    def runs(self, first: np.ndarray) -> np.ndarray:
        """Keys of the runs of ``UNIT`` words that begin at the words ``first``."""
        key = np.zeros(len(first), np.uint64)
        for k in range(UNIT):
            key += self.words[first + k] * _PLACES[k]
        return mix(key)

    def anchors(self) -> np.ndarray:
        """First words of the windows."""
        begin, end = self.borders[:-1], self.borders[1:]
        last = len(self.grams) - REACH
        found = [np.zeros(0, np.int64)]
        if last >= 0:
            # The first least gram among so many from a gram on, for twice as many in every step.
            least, at, width = self.grams, np.arange(len(self.grams)), 1
            while width < REACH:
                step = min(width, REACH - width)
                less = least[step:] < least[:-step]
                least, at = np.where(less, least[step:], least[:-step]), np.where(less, at[step:], at[:-step])
                width += step
            # Of them those that lie in one text.
            whole = np.zeros(len(at) + 1, np.int64)
            full = np.flatnonzero(end - begin >= SIZE - 1 + REACH)
            np.add.at(whole, begin[full], 1)
            np.add.at(whole, end[full] - SIZE - REACH + 2, -1)
            at = at[np.cumsum(whole[:-1]) > 0]
            found.append(at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at)
        few = np.flatnonzero((end - begin >= UNIT) & (end - begin < SIZE - 1 + REACH))
        if len(few):
            count = end[few] - begin[few] - SIZE + 1
            offsets = np.cumsum(count) - count
            grams = self.grams[np.arange(count.sum()) + np.repeat(begin[few] - offsets, count)]
            least = np.flatnonzero(grams == np.repeat(np.minimum.reduceat(grams, offsets), count))
            own = np.searchsorted(offsets, least, side="right") - 1
            first = np.concatenate([[True], own[1:] != own[:-1]])
            found.append(least[first] - offsets + begin[few])
        first = np.sort(np.concatenate(found))
        return first[first + UNIT <= end[self.doc(first)]]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, begins, ends and texts of the windows."""
        return self.placed(first := self.anchors(), first + UNIT, self.runs(first))

    def placed(self, a: np.ndarray, b: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The keys, with begins and ends of the word ranges in their text, and the texts."""
        doc = self.doc(a)
        return keys, self.starts[a] - self.origin[doc], self.ends[b - 1] - self.origin[doc], doc

    def around(self, begins: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of the runs within ``REACH`` words of the windows with these begins in these texts, and whether each is such a window."""
        begins = begins + self.origin[doc]
        at = np.searchsorted(self.starts, begins)
        low, high = self.borders[doc], self.borders[doc + 1] - UNIT + 1
        there = (low <= at) & (at < high)
        there &= self.starts[np.minimum(at, len(self.starts) - 1)] == begins if len(self.starts) else False
        at, low, high = at[there], low[there], high[there]
        steps = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(steps, np.maximum(at - REACH, low), 1)
        np.add.at(steps, np.minimum(at + REACH + 1, high), -1)
        seed = np.zeros(len(self.words), bool)
        seed[at] = True
        first = np.flatnonzero(np.cumsum(steps[:-1]))
        return first, seed[first]


class Text(Texts):
    """One text."""

    def __init__(self, text: str | None):
        super().__init__([(text or "").encode()])

    def paragraphs(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Begin, end and shingle set of each."""
        a, b, _ = self.ranges()
        found, sizes = self.sets(a, b)
        pieces = np.split(found, np.cumsum(sizes)[:-1])
        _, begins, ends, _ = self.placed(a, b, a)
        yield from zip(begins.tolist(), ends.tolist(), pieces, strict=False)


def bands(found: np.ndarray) -> np.ndarray:
    """``BANDS`` hashes of the MinHash of a shingle set."""
    return bands_of(found, np.array([len(found)]))[0]


def bands_of(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of ``BANDS`` hashes for every set; the sets stand one behind the other."""
    offsets = np.cumsum(sizes) - sizes
    mixed = np.empty_like(found)
    out = np.empty((len(sizes), BANDS), np.uint64)
    if not len(sizes):
        return out
    for band in range(BANDS):
        value = np.full(len(sizes), band, np.uint64)
        for seed in _SEEDS[band * ROWS : (band + 1) * ROWS]:
            np.bitwise_xor(found, seed, out=mixed)
            np.multiply(mixed, _ODD, out=mixed)
            value = mix(value * _ODD + np.minimum.reduceat(mixed, offsets))
        out[:, band] = value
    return out


def _groups(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices whose texts have ``LETTERS`` bytes together, or one text."""
    for whole in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(whole.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < whole.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + LETTERS, side="right")))
            yield whole.slice(start, end - start)
            start = end


def _texts(batch: pa.RecordBatch) -> Texts:
    return Texts(batch.column("text").cast(pa.binary()).to_pylist())


def _packed(values: np.ndarray, sizes: np.ndarray, there: np.ndarray | None = None) -> pa.Array:
    """The values cut into rows of these sizes, as bytes; null in rows that are not ``there``."""
    there = np.ones(len(sizes), bool) if there is None else there
    edges = np.zeros(len(there) + 1, np.int32)
    edges[1:][there] = sizes * values.itemsize
    valid = pa.py_buffer(np.packbits(there, bitorder="little"))
    return pa.Array.from_buffers(pa.binary(), len(there), [valid, pa.py_buffer(np.cumsum(edges, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of such rows, none of them null, and the row of each."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.zeros(0, np.uint8)
    return values.view(kind), np.repeat(np.arange(len(column)), np.diff(edges) // np.dtype(kind).itemsize)


def _whole(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Sorted rows again, those with equal ``keys`` in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        other = np.zeros(batch.num_rows, bool)  # than the batch's last row
        for column in (batch.column(c).to_numpy(zero_copy_only=False) for c in keys):
            other |= column != column[-1]
        start = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if held and (start or any(held[0].column(c)[0] != batch.column(c)[0] for c in keys)):
            yield from pa.Table.from_batches([*held, batch.slice(0, start)]).combine_chunks().to_batches()
            held = []
        elif start:
            yield batch.slice(0, start)
        held.append(batch.slice(start))
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def units(docs: DataFrame) -> DataFrame:
    """Of ``id`` and ``text``: key, id, begin, end, n, bands and bits of all paragraphs (n shingles) and windows (n null).

    A set of ``LEAST_SET`` shingles or more has its bands and parity bits, packed, where a task meets it first.
    """
    names = ["key", "id", "begin", "end", "n", "bands", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _groups(batches):
            own, ids = _texts(batch), batch.column("id").to_numpy()
            a, b, _ = own.ranges()
            found, sizes = own.sets(a, b)
            keys, begins, ends, doc = own.placed(a, b, set_keys(found, sizes))
            fresh = sizes >= LEAST_SET
            for k in np.flatnonzero(fresh).tolist():
                fresh[k] = (key := int(keys[k])) not in seen
                seen.add(key)
            found, few = found[np.repeat(fresh, sizes)], sizes[fresh]
            bits, words = parity_bits_of(found, few)
            columns = [keys.view(np.int64), ids[doc], begins.astype(np.int32), ends.astype(np.int32), sizes.astype(np.int32)]
            columns = [*map(pa.array, columns), _packed(bands_of(found, few).ravel(), np.full(len(few), BANDS), fresh), _packed(bits, words, fresh)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            keys, begins, ends, doc = own.windows()
            columns = [keys.view(np.int64), ids[doc], begins.astype(np.int32), ends.astype(np.int32)]
            columns = [*map(pa.array, columns), pa.nulls(len(keys), pa.int32()), pa.nulls(len(keys), pa.binary()), pa.nulls(len(keys), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, "key long, id long, begin int, end int, n int, bands binary, bits binary")


def colliding(sets: DataFrame) -> DataFrame:
    """Of ``node`` and ``bands``: distinct rows (band, node) of the bands that two nodes or more have."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                band, row = _unpacked(batch.column("bands"), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(band), pa.array(batch.column("node").to_numpy()[row])], names=["band", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, met = np.zeros((2, 0), np.int64), False  # the last row, and whether one of its band is before it
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            rows = rows[:, np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))]
            same = rows[0, 1:] == rows[0, :-1]
            keep = np.append(met, same) | np.append(same, False)
            held, met = rows[:, -1:], bool(keep[-1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[:, :-1][:, keep[:-1]]], names=["band", "node"])
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=["band", "node"])

    rows = sets.select("node", "bands").mapInArrow(cut, "band long, node long")
    return rows.repartition("band").sortWithinPartitions("band", "node").mapInArrow(run, "band long, node long")


def _beside(docs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """id, text and ``name`` of the documents of ``values``: all values (columns id and ``name``) of the document, sorted."""
    few = values.count() <= BROADCAST_ROWS
    lists = values.groupBy(F.col("id").alias("_id")).agg(F.sort_array(F.collect_set(name)).alias(name))
    return docs.join(F.broadcast(lists) if few else lists, F.col("id") == F.col("_id")).select("id", "text", name)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists without nulls, and the row of each."""
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())


def parts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle sets of the wanted paragraphs (node, id of a document that has it), cut into fragments."""
    edges = np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)
    names = ["node", "fragment", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            own = _texts(batch)
            found, sizes = own.sets(*own.ranges()[:2])
            keys = set_keys(found, sizes).view(np.int64)
            keep = (sizes >= LEAST_SET) & np.isin(keys, _flat(batch.column("node"))[0])
            keep[keep] &= np.isin(np.arange(keep.sum()), np.unique(keys[keep], return_index=True)[1])
            found, sizes, keys = found[np.repeat(keep, sizes)], sizes[keep], keys[keep]
            # Sets are sorted, so that a fragment of a set is a stretch of it.
            fragment = np.searchsorted(edges, found, side="right") + FRAGMENTS * np.repeat(np.arange(len(sizes)), sizes)
            places, lengths = np.unique(fragment, return_counts=True)
            part = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(found.view(np.int64)))
            columns = [pa.array(keys[places // FRAGMENTS]), pa.array((places % FRAGMENTS).astype(np.int32)), part]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    made = _beside(docs, wanted, "node").mapInArrow(run, "node long, fragment int, part array<long>")
    return made.dropDuplicates(["node", "fragment"])


def _with_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with ``bits`` as lists."""
    for batch in batches:
        if batch.num_rows:
            words, row = _unpacked(batch.column("bits"), np.int64)
            edges = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))).astype(np.int32)
            yield batch.set_column(batch.schema.get_field_index("bits"), "bits", pa.ListArray.from_arrays(pa.array(edges), pa.array(words)))


def linked(docs: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Pairs (a, b) of different paragraphs of similarity 0.8 or more that connect all such paragraphs that collide in a band.

    Bands are the buckets of :func:`connected`: every paragraph meets one leader a round, then the nearest pairs between
    components are compared, then all pairs of a band that are still in different components and within reach by parity bits.
    ``paragraphs`` are rows of :func:`units`; without bands and bits these are made from the texts.
    """
    sets = paragraphs if "bands" in paragraphs.columns else units(docs).where("n is not null")
    sets = sets.where("bands is not null").withColumnRenamed("key", "node")
    held = compact(colliding(sets))
    # The paragraph that collides most is nearest to what the others were made from: it leads.
    size = held.groupBy("band").agg(F.count("*").alias("_size"))
    ranked = held.join(size, "band").groupBy("node").agg(F.sum("_size").alias("shared"))
    about = sets.select("node", "id", "n", "bits").join(ranked, "node").dropDuplicates(["node"])
    about = compact(about.mapInArrow(_with_lists, "node long, id long, n int, bits array<long>, shared long"))
    # A band says nothing of what two sets share: no prefix, so only sizes and bits sift its pairs.
    none = {"length": F.lit(0), "met": F.lit(1), "hot": F.lit(False)}
    held = compact(held.withColumnRenamed("band", "shingle").join(about.select("node", "n", "shared"), "node").withColumns(none))
    wanted = about.select("node", "id")
    return connected(held, about.select("node", "bits"), lambda live: parts(docs, compact(wanted.join(live, "node", "left_semi"))))[0]


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs in two documents or more, with ``removed``: false for the first occurrence."""
    place = F.struct("id", "begin")
    out = _shared(rows, key, F.min(place).alias("_first"), F.col("_first.id"))
    return out.withColumn("removed", place != F.col("_first")).drop("_first")


def _shared(rows: DataFrame, key: str, first: F.Column, least: F.Column) -> DataFrame:
    """Rows whose ``key`` occurs in two documents or more, with ``first`` over the key's rows, whose ``least`` is the first document."""
    seen = rows.groupBy(key).agg(first, F.max("id").alias("_last")).where(least < F.col("_last"))
    return rows.join(compact(seen.drop("_last")), key)  # on its own, so that Spark can split a hot key


#: A run of a piece: its key, begin and end, and whether it is a window that repeats.
RUN = np.dtype([("key", "<i8"), ("begin", "<i4"), ("end", "<i4"), ("mark", "?")])
#: Where a repeated run of a piece is in it, the first document that has the run, and the run's end there.
FIRST = np.dtype([("at", "<i4"), ("id", "<i8"), ("end", "<i4")])


def _records(kind: np.dtype, *columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(columns[0]), kind)
    for name, column in zip(kind.names, columns, strict=True):
        out[name] = column
    return out


def seeded(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """All runs of ``UNIT`` words within ``REACH`` of the windows of ``seeds`` (id, begin), some neighbours a row: piece, id, again, runs (packed).

    ``piece`` is a hash of the runs' keys, ``again`` says that the document had the piece before. A piece ends before a run
    that its key picks, so that equal passages fall into equal pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            own = _texts(batch)
            first, seed = own.around(*_flat(batch.column("begin")))
            if not len(first):
                continue
            keys, begins, ends, doc = own.placed(first, first + UNIT, own.runs(first))
            place = np.arange(len(first))
            cut = (keys >> np.uint64(40)) % np.uint64(PIECE) == 0
            cut |= np.append(True, first[1:] != first[:-1] + 1)
            cut |= (place - np.maximum.accumulate(np.where(cut, place, 0))) % MOST == 0
            offsets = np.flatnonzero(cut)
            sizes = np.diff(np.append(offsets, len(first)))
            piece = np.add.reduceat(keys * _PIECES[place - np.repeat(offsets, sizes)], offsets)
            piece = mix(piece + sizes.astype(np.uint64) * _ODD)
            doc = doc[offsets]
            order = np.lexsort((offsets, piece, doc))
            again = np.zeros(len(piece), bool)
            again[order[1:]] = (piece[order[1:]] == piece[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
            runs = _packed(_records(RUN, keys.view(np.int64), begins, ends, seed), sizes)
            columns = [pa.array(piece.view(np.int64)), batch.column("id").take(pa.array(doc)), pa.array(again), runs]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "id", "again", "runs"])

    return _beside(docs, seeds, "begin").mapInArrow(run, "piece long, id long, again boolean, runs binary")


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every run of the pieces: key, piece, id, place (begin and end in one number), at (its number in the piece, the last bit is ``more``)."""
    for batch in batches:
        if batch.num_rows:
            runs, row = _unpacked(batch.column("runs"), RUN)
            at = np.arange(len(row)) - np.searchsorted(row, row)
            piece, ids, more = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("piece", "id", "more"))
            columns = [np.ascontiguousarray(runs["key"]), piece, ids, (runs["begin"].astype(np.int64) << 32) + runs["end"], (2 * at + more).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["key", "piece", "id", "place", "at"])


def _by_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece, spot, id) in order, the spot with a run's number and end, as one row a piece: piece, firsts (packed)."""
    for batch in _whole(batches, ["piece"]):
        piece, spot, ids = (c.to_numpy() for c in batch.columns)
        at = spot >> 32
        new = np.append(True, (piece[1:] != piece[:-1]) | (at[1:] != at[:-1]))
        piece, firsts = piece[new], _records(FIRST, at[new], ids[new], (spot & 0xFFFFFFFF)[new])
        offsets = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        columns = [pa.array(piece[offsets]), _packed(firsts, np.diff(np.append(offsets, len(piece))))]
        yield pa.RecordBatch.from_arrays(columns, names=["piece", "firsts"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of piece, id, runs and firsts: repeated runs that touch within a piece as one: id, removed, begin, end, seeds, others.

    A run of the document that has it first is removed only behind that first occurrence,
    so that of runs that repeat at each word one stays whole. ``seeds`` are the keys of windows, ``others`` all keys where there are none.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        runs, of_run = _unpacked(batch.column("runs"), RUN)
        firsts, row = _unpacked(batch.column("firsts"), FIRST)
        runs, ids = runs[firsts["at"] + np.searchsorted(of_run, row)], batch.column("id").to_numpy()
        removed = (ids[row] != firsts["id"]) | (runs["begin"] >= firsts["end"])
        order = np.lexsort((firsts["at"], removed, row))
        row, removed, runs = row[order], removed[order], runs[order]
        begin, end, key, mark = (np.ascontiguousarray(runs[c]) for c in ("begin", "end", "key", "mark"))
        new = np.append(True, (row[1:] != row[:-1]) | (removed[1:] != removed[:-1]) | (begin[1:] > end[:-1]))
        offsets = np.flatnonzero(new)
        sizes = np.diff(np.append(offsets, len(row)))
        windows = np.add.reduceat(mark, offsets, dtype=np.int64)
        columns = [ids[row[offsets]], removed[offsets], begin[offsets], np.maximum.reduceat(end, offsets)]
        columns = [*map(pa.array, columns), _packed(key[mark], windows), _packed(key[np.repeat(windows == 0, sizes)], np.where(windows == 0, sizes, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "removed", "begin", "end", "seeds", "others"])


def shared_runs(pieces: DataFrame, folder: str) -> DataFrame:
    """Repeated runs of ``pieces``, as :func:`_stretches` returns them; ``folder`` keeps what is known of the pieces."""
    with scratch(pieces.sparkSession):
        # Equal pieces have equal runs: the first document's stands for all, so that a run comes as often as there are different pieces around it.
        known = pieces.where("not again").groupBy("piece").agg(F.min("id").alias("id"), F.max("id").alias("_last"))
        one = pieces.where("not again").join(known, ["piece", "id"]).select("piece", "id", (F.col("_last") > F.col("id")).alias("more"), "runs")
        one = checkpointed(one).mapInArrow(_single, "key long, piece long, id long, place long, at int")
        by_key = Window.partitionBy("key")
        first = F.min(F.struct("id", "place")).over(by_key)
        one = one.withColumns({"_first": first, "_last": F.max("id").over(by_key), "_more": F.max(F.col("at").bitwiseAND(1)).over(by_key)})
        one = one.where("_first.id < _last or _more = 1").select("piece", F.expr("shiftleft(cast(at div 2 as long), 32) + (_first.place & 4294967295)").alias("spot"), "_first.id")
        firsts = one.repartition("piece").sortWithinPartitions("piece", "spot").mapInArrow(_by_piece, "piece long, firsts binary")
        firsts = kept_at(firsts, f"{folder}/firsts")
    both = pieces.drop("again").join(firsts, "piece")  # on its own, so that Spark can split a hot piece
    return both.mapInArrow(_stretches, "id long, removed boolean, begin int, end int, seeds binary, others binary")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches in order; those that touch in a document as one span: id, removed, begin, end, node, names.

    Spans with a window in common are one cluster; those without any, by all their runs: ``names`` are their keys, ``node`` is the least.
    """
    for batch in _whole(batches, ["id", "removed"]):
        ids, begin, end = (batch.column(c).to_numpy() for c in ("id", "begin", "end"))
        removed = batch.column("removed").to_numpy(zero_copy_only=False)
        other = np.append(True, (ids[1:] != ids[:-1]) | (removed[1:] != removed[:-1]))
        group = np.cumsum(other) << 32
        before = np.maximum.accumulate(group + end)[:-1]
        offsets = np.flatnonzero(other | np.append(True, group[1:] + begin[1:] > before))
        span = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets, len(ids))))
        pairs = []
        bare = np.ones(len(offsets), bool)
        for column in ("seeds", "others"):
            key, row = _unpacked(batch.column(column), np.int64)
            own = span[row]
            key, own = key[bare[own]], own[bare[own]]
            pairs.append(np.stack([own, key]))
            bare[own] = False
        own, key = np.concatenate(pairs, axis=1)
        own, key = (x[order] for order in [np.lexsort((key, own))] for x in (own, key))
        new = np.append(True, (own[1:] != own[:-1]) | (key[1:] != key[:-1]))
        own, key = own[new], key[new]
        edges = np.searchsorted(own, np.arange(len(offsets) + 1))
        columns = [ids[offsets], removed[offsets], begin[offsets], np.maximum.reduceat(end, offsets), key[edges[:-1]]]
        columns = [*map(pa.array, columns), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(key))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "removed", "begin", "end", "node", "names"])


def _spans(runs: DataFrame) -> DataFrame:
    """Stretches of repeated runs that touch in a document as one span: id, removed, begin, end, cluster."""
    spans = runs.repartition("id").sortWithinPartitions("id", "removed", "begin", "end")
    spans = compact(spans.mapInArrow(_joined, "id long, removed boolean, begin int, end int, node long, names array<long>"))
    touching = spans.select(F.col("node").alias("a"), F.explode("names").alias("b"))
    together = compact(components(compact(touching.where("a <> b").distinct())))
    spans = spans.join(together, "node", "left").withColumn("cluster", F.coalesce("component", "node"))
    return spans.select("id", "removed", "begin", "end", "cluster")


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every span of a document that repeats in another: id, kind, begin, end, cluster, removed.

    Of a cluster of paragraphs, and of every repeated window, the first occurrence by id and place has ``removed`` false.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    folder = shared_folder(spark)
    columns = [F.col("id").alias(id_col), "kind", "begin", "end", "cluster", "removed"]
    # Every step's tables go with it; what the next one needs is kept beside them.
    with scratch(spark):
        found = checkpointed(units(docs))
        paragraphs = found.where("n is not null")
        with scratch(spark):
            member = kept_at(components(linked(docs, paragraphs)), f"{folder}/member")
        placed = paragraphs.join(member.withColumnRenamed("node", "key"), "key", "left")
        placed = placed.withColumn("cluster", F.coalesce("component", "key")).select("id", "begin", "end", "cluster")
        lines = _repeated(placed, "cluster").withColumn("kind", F.lit("paragraph"))
        lines = kept_at(lines.select(*columns), f"{folder}/lines")
        seeds = _shared(found.where("n is null").select("key", "id", "begin"), "key", F.min("id").alias("_first"), F.col("_first")).select("id", "begin")
        seeds = kept_at(seeds, f"{folder}/seeds")
    with scratch(spark) as own:
        runs = kept_at(shared_runs(checkpointed(seeded(docs, seeds)), own), f"{folder}/runs")
    with scratch(spark):
        spans = _spans(runs).withColumn("kind", F.lit("passage"))
        spans = kept_at(spans.select(*columns), f"{folder}/spans")
    return lines.unionByName(spans)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns, removed spans cut out of the texts; a text without repeats stays as it is.

    Every row is a document of its own, also where ids are null or the same: rows are numbered by id (nulls last), then by
    the text's hash, and spans belong to a row's number.
    """
    order = [F.col(f"`{id_col}`").asc_nulls_last(), F.xxhash64(f"`{text_col}`"), F.col("__at")]
    rows = df.withColumn("__at", F.monotonically_increasing_id()).orderBy(*order).drop("__at")
    rows = checkpointed(rows.withColumn("__row", F.monotonically_increasing_id()))
    gone = repeats(rows, "__row", text_col).where("removed")
    gone = gone.groupBy("__row").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("__gone"))
    # Pieces between the spans: from the furthest end so far to the next begin.
    kept = F.expr(
        f"aggregate(__gone, named_struct('at', 0, 'out', ''), (s, g) -> named_struct('at', greatest(s.at, g.end), "
        f"'out', concat(s.out, if(g.begin > s.at, substring(`{text_col}`, s.at + 1, g.begin - s.at), ''))))"
    )
    out = rows.join(gone, "__row", "left").withColumn("__kept", kept)
    text = F.concat(F.col("__kept.out"), F.expr(f"substring(`{text_col}`, __kept.at + 1, {2**31 - 1})"))
    whole = F.col("__gone").isNull() | F.col(f"`{text_col}`").isNull()
    return out.withColumn(text_col, F.when(whole, F.col(f"`{text_col}`")).otherwise(text)).select(*[F.col(f"`{c}`") for c in df.columns])
