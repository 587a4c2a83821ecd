"""N-gram Jaccard join with vertical partitioning.

A text is the set of its word shingles. All shingles stand in one global order: rare ones
first, then those that many texts share, by how many. Two texts of Jaccard similarity 0.8
or more share one of the first fifth of either's shingles, so only these prefixes are
shuffled to find candidates. A candidate pair is decided by its overlap: the global order
is cut into fragments, the overlap in each is counted on its own, and the counts are
summed per pair, so that the sets of very long texts never meet whole in one task.

What keeps large groups from costing the square of their size, without losing a link:

* texts of equal sets are one node;
* in every bucket (a shingle and the nodes with it in their prefix) the node with most
  shared shingles is compared with the others first; what it links is one component;
* only nodes of different components are compared after that, block by block: first the nearest pairs that
  would connect a block's components, then all pairs that no link has brought together;
* a pair's sets are read only where the prefix shingles that either shares with anyone, and then a few parity
  bits of both sets, leave 0.8 within reach. Bits that differ are a lower bound of the shingles that do.

Words are lower-cased A-Z and split at white space. A text of fewer words than a shingle is
one shingle; without words, or null, it has the empty set and no links. Shingles and sets are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlelabels.llm.common import SLICE
from titlelabels.llm.graph import compact, components
from titlelabels.llm.words import LOWER, shingles, word_hashes
from titlelabels.session import checkpointed, kept_at, scratch, shared_folder

SIZE = 5
#: A shingle is common where so many prefixes by hash order hold it.
COMMON_LEAST = 4
#: The most common shingles that are sent to every task; the threshold doubles until they fit.
COMMON_ROWS = 1 << 17
#: Fragments of the global order.
FRAGMENTS = 8
#: Rows whose ids are broadcast at most (16 bytes each); above, the join is shuffled.
BROADCAST_ROWS = 1 << 20
#: Rounds in which a bucket's nodes meet one leader, before all remaining pairs.
STAR_ROUNDS = 2
#: Rounds after these in which only the nearest pairs between components are compared, before all that remain.
FOREST_ROUNDS = 2
#: Bits a shingle that are compared before sets are.
SPREAD = 4
#: Nodes of a bucket that is joined with itself.
SMALL = 16
#: Nodes of a larger bucket that are compared with as many others in one task at a time.
TILE = 2_048


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = word_hashes((text or "").encode().translate(LOWER))[0]
    found = np.sort(shingles(words, SIZE))
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def set_key(found: np.ndarray) -> int:
    """A hash of the set."""
    places = np.arange(1, len(found) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (found ^ (found >> np.uint64(29))) * (places | np.uint64(1))
    # The sum is taken over other bits than the parity that the xor has already.
    total = int(np.bitwise_xor.reduce(mixed)) ^ (int((mixed >> np.uint64(7)).sum(dtype=np.uint64)) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    return int(np.uint64((total * 0xBF58476D1CE4E5B9 + len(found)) & (1 << 64) - 1).astype(np.int64))


def set_keys(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """:func:`set_key` of many sets that stand one behind the other."""
    if not len(sizes):
        return np.zeros(0, np.uint64)
    offsets = np.cumsum(sizes) - sizes
    places = (np.arange(len(found)) - np.repeat(offsets - 1, sizes)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (found ^ (found >> np.uint64(29))) * (places | np.uint64(1))
    total = np.bitwise_xor.reduceat(mixed, offsets) ^ (np.add.reduceat(mixed >> np.uint64(7), offsets) * np.uint64(0xD6E8FEB86659FD93))
    return total * np.uint64(0xBF58476D1CE4E5B9) + sizes.astype(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def parity_bits(found: np.ndarray) -> np.ndarray:
    """For every remainder of a shingle modulo a power of two, whether an odd number of shingles has it; as words of 64 bits.

    Two sets differ in as many shingles as their bits differ at least. There are some ``SPREAD`` bits a shingle; halves
    put together by exclusive or are the bits for half as many remainders.
    """
    words = 1 << max(0, (SPREAD * len(found) - 1) // 64).bit_length()
    places = (found & np.uint64(64 * words - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=64 * words).astype(np.uint8) & 1, bitorder="little").view(np.int64)


def parity_bits_of(found: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`parity_bits` of many sets that stand one behind the other, and how many words of bits each has."""
    words = np.ones(len(sizes), np.int64)
    asked = np.maximum(0, SPREAD * sizes - 1) // 64
    while (less := words <= asked).any():
        words[less] *= 2
    begins = np.repeat(64 * (np.cumsum(words) - words), sizes)
    places = begins + (found & (np.repeat(64 * words, sizes) - 1).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(places, minlength=64 * int(words.sum()))
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64), words


def survey(df: DataFrame) -> DataFrame:
    """Of ``id`` and ``text``: id, set size n, node (null without words), its bits and mark (a hash of the text) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                sets = [shingle_set(text) for text in batch.column(1).to_pylist()]
                nodes = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
                bits = pa.array([parity_bits(s) if len(s) else None for s in sets], pa.list_(pa.int64()))
                columns = [batch.column(0), pa.array(map(len, sets), pa.int64()), nodes, bits, batch.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "node", "bits", "mark"])

    return df.select("id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, "id long, n long, node long, bits array<long>, mark long")


def prefix_length(n: int) -> int:
    """So many of a set's ``n`` shingles, in any order that all sets share, meet every set of similarity 0.8 or more."""
    return n - -(-4 * n // 5) + 1


def first_shingles(df: DataFrame) -> DataFrame:
    """The shingles of all prefixes by hash order; equal sets within a task come once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                out = []
                for text in whole.slice(start, SLICE).column(0).to_pylist():
                    found = shingle_set(text)
                    node = set_key(found) if len(found) else None
                    if node is not None and node not in seen:
                        seen.add(node)
                        out.append(found[: prefix_length(len(found))])
                if out:
                    yield pa.RecordBatch.from_arrays([_signed(np.concatenate(out))], names=["shingle"])

    return df.select("text").mapInArrow(run, "shingle long")


def common_shingles(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that ``COMMON_LEAST`` prefixes or more hold, sorted, and the class of each: the logarithm of its count.

    At most ``COMMON_ROWS``: the least count doubles until they fit. The order of the
    shingles only decides how many candidates there are; links are the same in any.
    """
    least = COMMON_LEAST
    totals = found.groupBy("shingle").agg(F.count("*").alias("count")).where(F.col("count") >= least)
    totals = checkpointed(totals)
    rows = totals.count()
    while rows > COMMON_ROWS:
        least *= 2
        rows = totals.where(F.col("count") >= least).count()
    kept = totals.where(F.col("count") >= least).toArrow()
    keys = kept["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log2(kept["count"].to_numpy()[order]).astype(np.int64) + 1


def prefixes(df: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """A row for every text's set: node, n, shared (how many of its shingles are common), rare and often (its prefix in two parts).

    Equal sets within a task come once.
    """
    sent = df.sparkSession.sparkContext.broadcast(common)
    names = ["node", "n", "shared", "rare", "often"]
    arrays = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, classes = sent.value
        seen = set()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                out: list[tuple] = []
                for text in whole.slice(start, SLICE).column(0).to_pylist():
                    found = shingle_set(text)
                    n = len(found)
                    node = set_key(found) if n else None
                    if n == 0 or node in seen:
                        continue
                    seen.add(node)
                    kind = np.zeros(n, np.int64)
                    if len(keys):
                        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                        kind = np.where(keys[at] == found, classes[at], 0)
                    first = np.argsort(kind, kind="stable")[: prefix_length(n)]  # found is sorted: by class, then hash
                    often = kind[first] > 0
                    ids = found[first].view(np.int64)
                    out.append((node, n, int((kind > 0).sum()), ids[~often], ids[often]))
                if out:
                    types = [pa.int64(), pa.int32(), pa.int32(), arrays, arrays]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return df.select("text").mapInArrow(run, "node long, n int, shared int, rare array<long>, often array<long>")


def buckets(sets: DataFrame) -> DataFrame:
    """(shingle, node, hot) for every shingle that is in the prefix of two nodes or more; hot where the shingle is a common one.

    Rare shingles are shuffled once, for the count and the rows alike. Common ones are few
    but may have very many rows: these are counted with a map-side combine and joined, so that Spark can split them.
    """
    plural = [F.min("node").alias("_low"), F.max("node").alias("_high")]
    bucket = Window.partitionBy("shingle")
    rare = sets.select(F.explode("rare").alias("shingle"), "node")
    rare = rare.withColumns({"_low": F.min("node").over(bucket), "_high": F.max("node").over(bucket)})
    rare = rare.where("_low < _high").select("shingle", "node")
    often = sets.select(F.explode("often").alias("shingle"), "node")
    counted = often.groupBy("shingle").agg(*plural).where("_low < _high").select("shingle")
    often = often.join(checkpointed(counted), "shingle", "left_semi")  # on its own, so that Spark can split a hot one
    return rare.withColumn("hot", F.lit(False)).unionByName(often.withColumn("hot", F.lit(True))).distinct()


def near(a: str, b: str, overlap: F.Column) -> F.Column:
    """Whether an overlap of two sets of sizes ``a`` and ``b`` means 0.8 or more."""
    return 5 * overlap >= 4 * (F.col(a) + F.col(b) - overlap)


def segments(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The shingle sets of the documents of ``ids``, cut into fragments: node, fragment, part (array of long)."""
    few = ids.count() <= BROADCAST_ROWS
    wanted = ids.select(F.col("id").alias("_wanted"))
    texts = df.join(F.broadcast(wanted) if few else wanted, F.col("id").eqNullSafe(F.col("_wanted")), "left_semi")
    names = ["node", "fragment", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)).astype(np.uint64)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE // 4):
                nodes, places, parts = [], [], []
                for text in whole.slice(start, SLICE // 4).column(0).to_pylist():
                    found = shingle_set(text)
                    if len(found):
                        node = set_key(found)
                        for k, part in enumerate(np.split(found, np.searchsorted(found, edges))):
                            if len(part):
                                nodes.append(node)
                                places.append(k)
                                parts.append(part.view(np.int64))
                columns = [pa.array(nodes, pa.int64()), pa.array(places, pa.int32()), pa.array(parts, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    made = texts.select("text").mapInArrow(run, "node long, fragment int, part array<long>")
    return made.dropDuplicates(["node", "fragment"])


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """a, b, n_a, n_b and the overlap of every pair: counted in each fragment, summed per pair."""
    # Parts are dealt by node and fragment once; a pair's first part moves to its second one.
    keyed = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))))
    left = parts.select(F.col("node").alias("a"), "fragment", F.col("part").alias("part_a"))
    right = parts.select(F.col("node").alias("b"), "fragment", F.col("part").alias("part_b"))
    both = keyed.join(left, ["a", "fragment"]).join(right, ["b", "fragment"])
    shared = F.size(F.array_intersect("part_a", "part_b"))
    return both.groupBy("a", "b", "n_a", "n_b").agg(F.sum(shared).cast("long").alias("overlap"))


def within_reach(x: str, y: str, common: F.Column) -> F.Column:
    """Whether ``common`` shared prefix shingles leave 0.8 within reach.

    The prefixes hold all shingles of either set up to the earlier end of the two; behind it,
    at most what that set has left can be shared.
    """
    left = F.greatest(F.col(f"n_{x}") - F.col(f"length_{x}"), F.col(f"n_{y}") - F.col(f"length_{y}"))
    most = F.least(common + left, F.col(f"n_{x}"), F.col(f"n_{y}"))
    return near(f"n_{x}", f"n_{y}", most)


_OF_NODE = ("node", "n", "length", "met", "shared")


def _named(rows: DataFrame, side: str, *more: str) -> DataFrame:
    return rows.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in (*_OF_NODE, *more)])


def _pairs(both: DataFrame) -> DataFrame:
    """Distinct pairs of the sides x and y, the smaller node as a; those within reach by how many prefix shingles either shares at all."""
    both = both.where((F.col("node_x") != F.col("node_y")) & within_reach("x", "y", F.least("met_x", "met_y")))
    swap = F.col("node_x") > F.col("node_y")
    pick = [
        F.when(swap, F.col(f"{c}_{v}")).otherwise(F.col(f"{c}_{u}")).alias(name + side)
        for c, name in (("node", ""), ("n", "n_"), ("length", "length_"))
        for u, v, side in (("x", "y", "a"), ("y", "x", "b"))
    ]
    return both.select(*pick).distinct()


def _apart(x: str, y: str) -> F.Column:
    """How many bits of ``bits_x`` and ``bits_y`` differ, halves of the longer ones put together."""
    half = lambda x, y: f"if(size({x}) > size({y}), zip_with(slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), (p, q) -> p ^ q), {x})"
    x, y = f"bits_{x}", f"bits_{y}"
    return F.expr(f"aggregate(zip_with({half(x, y)}, {half(y, x)}, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c)")


def _with_bits(pairs: DataFrame, bits: DataFrame, sides: tuple[str, str], node: str = "") -> DataFrame:
    """Pairs with the bits of both nodes; those that leave 0.8 within reach: such sets differ in a ninth of their sizes' sum at most."""
    for side in sides:
        pairs = pairs.join(bits.select(F.col("node").alias(f"{node}{side}"), F.col("bits").alias(f"bits_{side}")), f"{node}{side}")
    pairs = pairs.withColumn("differ", _apart(*sides)).drop(*[f"bits_{side}" for side in sides])
    return pairs.where(9 * F.col("differ") <= sum(F.col(f"n_{side}") for side in sides))


def _alike(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    return _with_bits(pairs, bits, ("a", "b")).select("a", "b", "n_a", "n_b")


def _stars(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """Every node of a bucket with one leader of its buckets, the one nearest by bits; a leader is its bucket's node with most common shingles.

    So there are at most as many pairs as nodes. What another leader would have linked is left for later rounds.
    """
    tops = rows.groupBy("shingle").agg(F.max(F.struct("shared", *[c for c in _OF_NODE if c != "shared"])).alias("_top"))
    tops = tops.select("shingle", *[F.col(f"_top.{c}").alias(f"{c}_y") for c in _OF_NODE])
    both = _named(rows, "x").join(tops, "shingle")
    both = both.where((F.col("node_x") != F.col("node_y")) & within_reach("x", "y", F.least("met_x", "met_y")))
    both = _with_bits(both.select("node_x", "n_x", "node_y", "n_y").distinct(), bits, ("x", "y"), "node_")
    far = F.struct((F.col("differ") / (F.col("n_x") + F.col("n_y"))).alias("far"), F.col("node_y").alias("node"))
    nearest = both.groupBy("node_x", "n_x").agg(F.min_by(F.struct("node_y", "n_y"), far).alias("_y")).select("node_x", "n_x", "_y.*")
    swap = F.col("node_x") > F.col("node_y")
    pick = [(F.when(swap, F.col(f"{c}_{v}")).otherwise(F.col(f"{c}_{u}"))).alias(name) for c, u, v, name in (("node", "x", "y", "a"), ("node", "y", "x", "b"), ("n", "x", "y", "n_a"), ("n", "y", "x", "n_b"))]
    return nearest.select(*pick).distinct()


#: Pairs of a tile looked at in one step.
STEP = 1 << 17


def forest(pairs: np.ndarray) -> np.ndarray:
    """Of pairs (a, b, n_a, n_b, component of a, of b, bits that differ) the nearest ones that connect the same components as all."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for k in np.lexsort((pairs[1], pairs[0], pairs[6] / (pairs[2] + pairs[3]))).tolist():
        x, y = root(int(pairs[4, k])), root(int(pairs[5, k]))
        if x != y:
            parent[x] = y
            kept.append(k)
    return pairs[:, kept]


def tile_pairs(about: np.ndarray, bits: np.ndarray, begins: np.ndarray, words: np.ndarray, alone: bool, sparse: bool = False) -> list[np.ndarray]:
    """Pairs of a tile whose components differ and whose sizes, shared shingles and bits leave 0.8 within reach: arrays of a, b, n_a, n_b.

    With ``sparse`` only the nearest ones that connect the same components as all of them. ``about`` has node, n, length, met, component and side of every row, ``bits`` all bits, those of a row from ``begins`` on, ``words`` long.
    """
    order = np.argsort(about[1], kind="stable")
    node, n, length, met, component, side = about[:, order]
    begins, words = begins[order], words[order]
    ends = np.searchsorted(n, n * 5 // 4, side="right")
    step = max(1, STEP // len(n))
    out: list[np.ndarray] = []
    for first in range(0, len(n), step):
        last = min(first + step, len(n))
        x, y = np.arange(first, last)[:, None], np.arange(first + 1, max(ends[last - 1], first + 1))[None, :]
        fits = (y > x) & (y < ends[first:last, None]) & (component[y] != component[x])
        if not alone:
            fits &= side[y] != side[x]
        x, y = np.nonzero(fits)
        x, y = x + first, y + first + 1
        left = np.maximum(n[x] - length[x], n[y] - length[y])
        most = np.minimum(np.minimum(met[x], met[y]) + left, n[x])
        near_enough = 9 * most >= 4 * (n[x] + n[y])
        x, y = x[near_enough], y[near_enough]
        for size in np.unique(words[x]).tolist():
            places = np.arange(size)
            here = np.flatnonzero(words[x] == size)
            for at in range(0, len(here), STEP // 8):
                i, j = x[here[at : at + STEP // 8]], y[here[at : at + STEP // 8]]
                other = bits[begins[j][:, None] + places]
                twice = words[j] > size  # halves put together
                other[twice] ^= bits[begins[j][twice][:, None] + size + places]
                differ = bits[begins[i][:, None] + places] ^ other
                differ = np.bitwise_count(differ.view(np.uint64)).sum(axis=1, dtype=np.int64)  # of signed numbers it would count their amount
                alike = 9 * differ <= n[i] + n[j]
                i, j, differ = i[alike], j[alike], differ[alike]
                swap = node[i] > node[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                if len(i):
                    pairs = np.stack([node[i], node[j], n[i], n[j], component[i], component[j], differ])
                    out.append(forest(pairs) if sparse else pairs)
    if sparse and len(out) > 1:
        out = [forest(np.concatenate(out, axis=1))]
    return [np.unique(pairs[:4], axis=1) for pairs in out]


def _batch(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if found:
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], names=["a", "b", "n_a", "n_b"])


def _rest(rows: DataFrame, bits: DataFrame, sparse: bool = False) -> DataFrame:
    """Pairs of a bucket's nodes in different components that their bits leave within reach; with ``sparse``, of each tile a forest of them.

    Pairs share as many of these buckets as their prefixes have in common. Buckets of up to ``SMALL`` nodes are joined with
    themselves. Nodes of a larger bucket are cut into blocks, and every two blocks meet in a task, which compares the bits of all
    its nodes at once; only what is left comes out. A bucket of any size costs one row a node and block.
    """
    met = rows.groupBy("node").agg(F.count("*").cast("int").alias("met"))
    sizes = rows.groupBy("shingle").agg(F.count("*").alias("size"))
    rows = compact(rows.drop("met").join(met, "node").join(sizes, "shingle"))
    small = rows.where(F.col("size") <= SMALL)
    x, y = _named(small, "x", "component"), _named(small, "y", "component")
    fits = (F.col("node_x") < F.col("node_y")) & (F.col("component_x") != F.col("component_y"))
    few = _alike(_pairs(x.join(y, "shingle").where(fits)), bits)

    rows = rows.where(F.col("size") > SMALL).withColumn("blocks", F.ceil(F.col("size") / TILE).cast("int")).join(bits, "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", "shingle"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    side = (F.col("block") > F.col("other")).cast("int").alias("side")
    about = ["node", "n", "length", "met", "component", "side", "bits"]
    dealt = rows.select("shingle", low, high, "node", "n", "length", "met", "component", side, "bits")
    dealt = dealt.repartition("shingle", "low", "high").sortWithinPartitions("shingle", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []  # the tile that goes on, in pieces

        def done(found: list[np.ndarray]) -> None:
            about, lists = (np.concatenate([piece[k] for piece in held], axis=-1) for k in (0, 1))
            words = np.concatenate([piece[2] for piece in held])
            if len(words) > 1:
                found += tile_pairs(about, lists, np.cumsum(words) - words, words, group[1] == group[2], sparse)

        for whole in batches:
            if not whole.num_rows:
                continue
            keys = np.stack([c.to_numpy() for c in whole.columns[:3]])
            rows = np.stack([c.to_numpy().astype(np.int64) for c in whole.columns[3:9]])
            lists = whole.column(9)
            bits, edges = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            found: list[np.ndarray] = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows], strict=True):
                key = tuple(keys[:, a].tolist())
                if key != group:
                    if held:
                        done(found)
                    group, held = key, []
                held.append((rows[:, a:b], bits[edges[a] : edges[b]], np.diff(edges[a : b + 1])))
            yield from _batch(found)
        if held:
            found = []
            done(found)
            yield from _batch(found)

    many = dealt.select("shingle", "low", "high", *about).mapInArrow(run, "a long, b long, n_a long, n_b long")
    return few.select("a", "b", F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b")).unionByName(many).distinct()


def _open(rows: DataFrame, member: DataFrame) -> DataFrame:
    """Bucket rows with their node's component, in buckets that hold more than one."""
    placed = F.coalesce("component", "node").alias("component")
    narrow = rows.select("shingle", "node").join(member, "node", "left").select("shingle", placed)
    mixed = narrow.groupBy("shingle").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    mixed = checkpointed(mixed.where("_low < _high").select("shingle"))
    rows = rows.join(mixed, "shingle", "left_semi").join(member, "node", "left")
    return rows.select("shingle", "hot", *_OF_NODE, placed)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` of every row: the smallest id that links reach, itself included.

    Null ids never name a component unless it has no other.
    """
    placed = _placed(df, id_col, text_col)
    least = placed.where("_key is not null").groupBy("_key").agg(F.min("id").alias("_least"))
    out = placed.join(least, "_key", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("id")).alias("component_id"),
    )


def _placed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n, node, mark and _key (its component; null without words) of every row, kept in the shared folder; all tables on the way are deleted."""
    spark = df.sparkSession
    path = shared_folder(spark)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    with scratch(spark):
        nodes = checkpointed(survey(docs))
        member = _members(docs, nodes)
        out = nodes.drop("bits").join(member, "node", "left").withColumn("_key", F.coalesce("component", "node"))
        kept_at(out, path)
    return spark.read.parquet(path)


def _members(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``component`` of all nodes with links."""
    folder = shared_folder(spark := docs.sparkSession)
    with scratch(spark):  # prefixes go as soon as the buckets are there
        sets = checkpointed(prefixes(docs, common_shingles(first_shingles(docs))))
        found = compact(buckets(sets))
        met = found.groupBy("node").agg(F.count("*").cast("int").alias("met"))
        length = (F.size("rare") + F.size("often")).alias("length")
        about = compact(sets.select("node", "n", "shared", length).join(met, "node").dropDuplicates(["node"]))
        kept_at(found.join(about, "node"), f"{folder}/held")
        kept_at(about.select("node"), f"{folder}/about")
    held, about = (compact(spark.read.parquet(f"{folder}/{name}")) for name in ("held", "about"))
    bits = compact(nodes.select("node", "bits").join(about.select("node"), "node", "left_semi").dropDuplicates(["node"]))

    def parts(live: DataFrame) -> DataFrame:
        ids = nodes.join(live, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id")).select("id").distinct()
        return segments(docs, compact(ids))

    links, member = connected(held, bits, parts)
    return member if member is not None else compact(components(links))


def connected(held: DataFrame, bits: DataFrame, parts: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """Links (a, b) that connect all nodes of similarity 0.8 or more that meet in a bucket, and their components where these are up to date.

    ``held`` has the buckets' rows as :func:`_open` returns them, without components; ``parts`` gives the sets of a table of nodes in fragments.
    """
    links = decided = member = left = None
    last = STAR_ROUNDS + FOREST_ROUNDS
    for turn in range(last + 1):
        if turn == 0:
            pairs = _stars(held, bits)
        else:
            if member is None:  # there are links that components do not have yet
                member = compact(components(links))
                left = compact(_open(held, member))
            if left.isEmpty():
                break
            if turn < STAR_ROUNDS:
                # The component of the bucket's leader steps back, and the best of the others leads.
                tops = left.groupBy("shingle").agg(F.max(F.struct("shared", "node", "component")).alias("_top"))
                others = left.join(tops.select("shingle", F.col("_top.component").alias("_first")), "shingle")
                pairs = _stars(others.where("component <> _first"), bits)
            else:
                pairs = compact(_rest(left, bits, sparse=turn < last))
                if pairs.isEmpty():  # a forest is empty only where no pair is left
                    break
            pairs = pairs.join(decided.select("a", "b"), ["a", "b"], "left_anti")
        pairs = compact(pairs)
        if turn and pairs.isEmpty():
            continue
        live = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        new = compact(overlaps(pairs, parts(live)))
        found_links = new.where(near("n_a", "n_b", F.col("overlap"))).select("a", "b")
        decided = new if decided is None else decided.unionByName(new)
        if links is None:
            links = found_links
        elif not found_links.isEmpty():
            links, member = compact(links.unionByName(found_links)), None
    return links, member


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns; of every component one row: of the smallest id (null ids last), then of the smallest text hash. Rows without words stay."""
    rows = _placed(df, id_col, text_col).where("_key is not null").groupBy("_key", "id", "mark").agg(F.count("*").alias("_rows"))
    rows = checkpointed(rows)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "mark")
    rows = rows.join(rows.groupBy("_key").agg(F.min(place).alias("_first")), "_key")
    rows = checkpointed(rows.select(F.col("id").alias("_other"), F.col("mark").alias("_mark"), "_rows", (place == F.col("_first")).alias("_stays")))
    own = F.col(id_col).cast("long").eqNullSafe(F.col("_other")) & (F.xxhash64(text_col) == F.col("_mark"))
    # Few ids are broadcast, so that the texts stay where they are.
    sent = lambda part: F.broadcast(part) if part.count() <= BROADCAST_ROWS else part
    out = df.join(sent(rows.where("not _stays").select("_other", "_mark")), own, "left_anti")
    again = rows.where("_stays and _rows > 1").select("_other", "_mark")
    if again.isEmpty():
        return out
    again = sent(again)
    # Of rows with one id and text, the one of the least hash over all columns.
    one = out.join(again, own, "left_semi").groupBy(id_col, text_col).agg(F.min_by(F.struct(*df.columns), F.xxhash64(*df.columns)).alias("_row"))
    return out.join(again, own, "left_anti").unionByName(one.select("_row.*"))
