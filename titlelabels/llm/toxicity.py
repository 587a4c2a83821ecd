"""Toxicity score: bags of subword embeddings under a linear softmax.

A word's vector is the average of the embeddings of its byte n-grams (with word borders,
hashed into ``BUCKETS`` rows); a linear layer and a softmax give the odds of the toxic class.
Embeddings and layer are trained together in numpy, first on words weighted by how many
toxic and other documents hold them, then on documents as bags of words, where the single
worst word answers for the document. So a phrase of harmless words cannot score, and a long
text is judged by its maximum. A misspelled word shares most n-grams with the word it stands
for, and so its vector.

As the softmax is over two classes and averages are linear, each n-gram contributes one
number; scoring looks these up over all bytes of a text at once.

Null and empty texts, and texts without words, get the lowest odds. Without
labels of both kinds every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelabels.llm.common import labelled, map_rows, remainder
from titlelabels.llm.words import mix, word_hashes
from titlelabels.session import checkpointed

BUCKETS = 1 << 17
SIZES = (3, 4, 5)
DIMENSIONS = 6
#: Labelled documents learnt from, toxic and others each.
FIT_ROWS = 2_500
#: Distinct words of documents learnt from, summed over documents.
FIT_WORDS = 3_000_000
WORD_STEPS = 60
BAG_STEPS = 60
RATE = 0.5
DECAY = 2e-7
THRESHOLD = 0.3
#: Words worked on at a time while fitting.
BLOCK = 1 << 16
#: Bytes scored at a time.
CHUNK = 1 << 19

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_FACTORS = np.random.default_rng(23).integers(0, 1 << 63, max(SIZES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def grams(data: bytes) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Buckets and word numbers of all n-grams of lower-cased UTF-8, by size; the number of words."""
    letters = np.frombuffer(b" " + data + b" ", np.uint8)
    inside = _LETTER[letters]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])  # the border before each word
    if not len(starts):
        return [], 0
    letters = np.where(inside, letters, 32).astype(np.uint64)
    word = np.cumsum(np.concatenate([[False], inside[1:] & ~inside[:-1]])) - 1
    borders = np.cumsum(~inside)
    out = []
    for n in SIZES:
        count = len(letters) - n + 1
        if count < 1:
            break
        # Between the first and the last byte there is no border, and one of them is a letter.
        at = np.flatnonzero((borders[n - 2 : n - 2 + count] == borders[:count]) & (inside[1 : 1 + count]))
        key = letters[at] * _FACTORS[0]
        for k in range(1, n):
            key += letters[at + k] * _FACTORS[k]
        out.append(((mix(key) % np.uint64(BUCKETS)).astype(np.int64), word[at + 1]))
    return out, len(starts)


def word_values(data: bytes, table: np.ndarray) -> np.ndarray:
    """The average of an n-gram's number over each word."""
    found, n = grams(data)
    if not n:
        return np.zeros(0)
    total, count = np.zeros(n), np.zeros(n)
    for bucket, word in found:
        total += np.bincount(word, table[bucket], n)
        count += np.bincount(word, minlength=n)
    return total / np.maximum(count, 1)


class Model:
    """Numbers of n-grams (embedding times layer), the layer's bias, and the scale of a document's odds."""

    def __init__(self, table: np.ndarray, bias: float, scale: float, shift: float):
        self.table, self.bias, self.scale, self.shift = table.astype(np.float32), bias, scale, shift

    def score(self, text: str | None) -> float:
        data = (text or "").lower().encode()
        worst, at = -np.inf, 0
        while at < len(data):
            end = min(at + CHUNK, len(data))
            while end < len(data) and _LETTER[data[end]]:
                end += 1
            values = word_values(data[at:end], self.table)
            if len(values):
                worst = max(worst, float(values.max()))
            at = end
        if worst == -np.inf:
            worst = -20.0 - self.bias
        raw = self.scale * (worst + self.bias) + self.shift
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


class _Adagrad:
    def __init__(self, x: np.ndarray):
        self.x, self.seen = x, np.full(x.shape, 1e-6, x.dtype)

    def step(self, g: np.ndarray) -> None:
        self.seen += g * g
        self.x += RATE * g / np.sqrt(self.seen)


def indexed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of all words in word order, and how many each word has."""
    parts, counts = [], []
    for k in range(0, len(words), BLOCK):
        found, n = grams(" ".join(words[k : k + BLOCK]).encode())
        word = np.concatenate([w for _, w in found])
        order = np.argsort(word, kind="stable")
        parts.append(np.concatenate([b.astype(np.int32) for b, _ in found])[order])
        counts.append(np.bincount(word, minlength=n))
    return np.concatenate(parts), np.concatenate(counts)


def learn(bags: list[list[str]], toxic: np.ndarray) -> Model | None:
    """The model of documents as lists of their distinct lower-cased words, with 0/1 labels."""
    known: dict[str, int] = {}
    flat = np.array([known.setdefault(w, len(known)) for bag in bags for w in bag], np.int64)
    sizes = np.array([len(bag) for bag in bags], np.int64)
    bucket, per_word = indexed(list(known)) if known else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    return trained(flat, sizes, np.asarray(toxic, float), bucket, per_word)


def trained(flat: np.ndarray, sizes: np.ndarray, y: np.ndarray, bucket: np.ndarray, per_word: np.ndarray) -> Model | None:
    """The model of documents as numbers of words: ``flat`` has them, document after document, ``sizes`` how many each has.

    ``bucket`` has the n-grams of all words, word after word, ``per_word`` how many each has; ``y`` the 0/1 labels.
    """
    if not len(y) or y.min() == y.max() or not len(flat):
        return None
    full = np.flatnonzero(sizes)
    begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    first = np.cumsum(per_word) - per_word
    used, bucket = np.unique(bucket, return_inverse=True)
    bucket, n = bucket.astype(np.int32), len(per_word)

    rng = np.random.default_rng(7)
    embedding = rng.normal(0, 0.05, (len(used), DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(1, np.float32)
    rules = [_Adagrad(embedding), _Adagrad(layer), _Adagrad(bias)]

    def places(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the n-grams of the words stand, and how many each has."""
        spans = per_word[words]
        ends = np.cumsum(spans)
        return np.repeat(first[words] - (ends - spans), spans) + np.arange(ends[-1]), spans

    def vectors(words: np.ndarray) -> np.ndarray:
        """Average embedding of the words."""
        out = np.empty((len(words), DIMENSIONS), np.float32)
        for k in range(0, len(words), BLOCK):
            at, spans = places(words[k : k + BLOCK])
            begins = np.concatenate([[0], np.cumsum(spans)[:-1]])
            out[k : k + BLOCK] = np.add.reduceat(embedding[bucket[at]], begins, axis=0) / spans[:, None]
        return out

    def update(words: np.ndarray, vector: np.ndarray, slope: np.ndarray) -> None:
        """One step along ``slope``, the derivative of the log-likelihood by the odds of each word."""
        total = np.abs(slope).sum() + 1e-9
        direction = layer[:, 1] - layer[:, 0]
        g = np.zeros(len(used))
        for k in range(0, len(words), BLOCK):
            at, spans = places(words[k : k + BLOCK])
            g += np.bincount(bucket[at], np.repeat(slope[k : k + BLOCK] / spans, spans), len(used))
        g = (g / total).astype(np.float32)
        half = (vector * slope[:, None]).sum(0) / total
        rules[1].step(np.stack([-half, half], axis=1).astype(np.float32))
        rules[0].step(g[:, None] * direction[None, :] - np.float32(DECAY) * embedding)
        rules[2].step(np.array([slope.sum() / total], np.float32))

    # Words: how many toxic and other documents hold each, both classes given the same weight.
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    ones = np.bincount(flat, (weight * y)[owner], n)
    zeros = np.bincount(flat, (weight * (1 - y))[owner], n)
    every = np.arange(n)
    for _ in range(WORD_STEPS):
        vector = vectors(every)
        p = 1 / (1 + np.exp(-(vector @ (layer[:, 1] - layer[:, 0]) + bias[0])))
        update(every, vector, (ones * (1 - p) - zeros * p))
    # Documents: the worst word answers.
    for _ in range(BAG_STEPS):
        odds = vectors(every) @ (layer[:, 1] - layer[:, 0]) + bias[0]
        of_place = odds[flat]
        worst = np.maximum.reduceat(of_place, begins)
        worst_at = np.flatnonzero(of_place == np.repeat(worst, sizes[full]))
        one = np.unique(owner[worst_at], return_index=True)[1]
        words = flat[worst_at[one]]
        p = 1 / (1 + np.exp(-worst))
        update(words, vectors(words), weight[full] * (y[full] - p))
    odds = vectors(every) @ (layer[:, 1] - layer[:, 0]) + bias[0]
    worst = np.maximum.reduceat(odds[flat], begins)
    scale, shift = calibrated(worst, y[full], np.sqrt(weight[full] * len(y)))
    table = np.zeros(BUCKETS, np.float32)
    table[used] = embedding @ (layer[:, 1] - layer[:, 0])
    return Model(table, float(bias[0]), scale, shift)


def calibrated(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit by Newton steps, slightly damped."""
    a, b = 1.0, 0.0
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (y - p) * x).sum() - 1e-2 * a, (w * (y - p)).sum() - 1e-2 * b])
        h = w * p * (1 - p)
        H = np.array([[(h * x * x).sum() + 1e-2, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-2]])
        step = np.linalg.solve(H, g)
        size = np.abs(step).max()
        a, b = np.array([a, b]) + step / max(1.0, size)
        if size < 1e-6:
            break
    return float(a), float(b)


def words_of(text: str | None) -> list[str]:
    """Distinct lower-cased words, in order."""
    data = np.frombuffer((text or "").lower().encode(), np.uint8)
    plain = np.where(_LETTER[data], data, 32).astype(np.uint8).tobytes()
    return sorted({w.decode("utf-8", "ignore") for w in plain.split()})


def numbered(words: list[str]) -> tuple[list[int], list[dict]]:
    """Hashes of words in ascending order, and beside each hash the word's n-grams."""
    if not words:
        return [], []
    hashes = word_hashes(" ".join(words).encode())[0].view(np.int64)
    bucket, per_word = indexed(words)
    found = dict(zip(hashes.tolist(), np.split(bucket, np.cumsum(per_word)[:-1]), strict=True))
    return sorted(found), [{"word": h, "grams": found[h].tolist()} for h in sorted(found)]


def fit(docs: DataFrame, labels: DataFrame, label: str, learn_from, bound: int = FIT_ROWS, words: int = FIT_WORDS) -> Model | None:
    """The model of about ``bound`` labelled documents of either class that ``learn_from`` (a condition on the id) admits.

    Tasks turn texts into numbers; the driver gets, as arrays, at most about ``words`` numbers of distinct words of
    documents (fewer documents are taken where these would have more) and the n-grams of each word once.
    """
    # One table of both classes, each bounded: the label is the class, so rows of one class are picked at its own rate.
    parts = []
    for kind in (0, 1):
        rows = labelled(docs, labels.where(F.col(label).isin(0, 1)), label, learn_from & (F.col(label) == kind), bound)
        outputs = "words array<long>, entries array<struct<word: long, grams: array<int>>>"
        parts.append(map_rows(rows, ["text"], outputs, lambda: lambda t: numbered(words_of(t)), ("_id", "label")))
    rows = checkpointed(parts[0].unionByName(parts[1]))
    total = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    if total > words:
        rows = rows.where(F.pmod(F.xxhash64("_id", F.lit("words")), F.lit(1 << 30)) < int(words / total * (1 << 30)))
    bags = rows.select("_id", "label", "words").toArrow().sort_by([("_id", "ascending"), ("label", "ascending")])
    known = rows.select(F.inline("entries")).dropDuplicates(["word"]).toArrow().sort_by("word")
    lists, entries = bags["words"].combine_chunks(), known["grams"].combine_chunks()
    flat = np.searchsorted(known["word"].to_numpy(), lists.flatten().to_numpy())
    sizes, per_word = (pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in (lists, entries))
    return trained(flat, sizes.astype(np.int64), bags["label"].to_numpy().astype(float), entries.flatten().to_numpy(), per_word.astype(np.int64))


def score(df: DataFrame, model: Model | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the score of every row's text."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def build():
        own = sent.value
        return (lambda text: (own.score(text),)) if own else (lambda text: (0.0,))

    return map_rows(df, [text_col], "score double", build, keep)


def toxicity(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Scores of all documents; ids whose checksum leaves remainder 2 modulo 4 are never learnt from."""
    model = fit(docs, labels, "toxic", remainder("doc_id", 4) != 2)
    return score(docs, model, keep=keep)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the fold, the score, and 1 where it reaches ``THRESHOLD``."""
    out = toxicity(docs, labels)
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", predicted)
