"""Spelling variants against plain Python: all pairs compared letter by letter."""

import random
import re
import zlib
from collections import Counter

import pytest

from titlelabels.llm import spelling
from titlelabels.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, word string, n long, half string, run string"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_apart(a, b):
    """Exactly one inserted, deleted or replaced letter, by trying them all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counts(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def neighbours(words):
    """Pairs one apart: words that give the same text when one letter goes meet first, then are compared."""
    groups = {}
    for w in words:
        for k in range(len(w) + 1):
            groups.setdefault(w[:k] + w[k + 1 :], set()).add(w)
    near = {w: set() for w in words}
    for group in groups.values():
        for a in group:
            near[a] |= {b for b in group if b != a and one_apart(a, b)}
    return near


def expected(words, near):
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def results(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def vocabulary(seed, size, letters, least=6, most=9):
    r = random.Random(seed)
    words = {}
    while len(words) < size:
        w = "".join(r.choice(letters) for _ in range(r.randint(least, most)))
        for _ in range(3):
            words[w] = r.choice([5, 6, 30, 200, 1200, 9000, 50_000])
            k = r.randrange(len(w))
            w = r.choice([w[:k] + r.choice(letters) + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + w[k + 1 :]])
            if len(w) < least:
                break
    return words


@pytest.mark.parametrize(("letters", "block"), [("ab", 8192), ("abé", 64), ("abcdefghij÷ÿ", 16)])
def test_vocabulary_against_all_pairs(spark, monkeypatch, letters, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    words = vocabulary(len(letters), 500, letters)
    df = spark.createDataFrame([(None, None, w, n, "h", "r") for w, n in words.items()], SCHEMA).select("word", "n")
    near = {a: {b for b in words if one_apart(a, b)} for a in words}
    assert near == neighbours(words)
    assert results(spelling.variants(df)) == expected(words, near)


def test_links_come_once_in_each_direction(spark):
    words = vocabulary(9, 300, "ab", 6, 7)
    df = spark.createDataFrame([(None, None, w, n, "h", "r") for w, n in words.items()], SCHEMA).select("word", "n")
    got = sorted((r.word, r.near) for r in spelling.links(df).collect())
    assert got == sorted((a, b) for a in words for b in words if one_apart(a, b))


def test_documents_with_nulls_and_ties(spark):
    r = random.Random(2)
    base = ["STRASSE", "strassé", "strase", "strasse", "ÉtésÀnnn", "abcdef", "abcdeg", "abcdeh", "x" * 400]
    rows = [(None, None), (1, ""), (2, "12 34 _"), (None, "abcdef " * 30)]
    rows += [(k, " ".join(r.choice(base) + r.choice([".", "×", "-", "1 "]) for _ in range(200))) for k in range(3, 40)]
    rows += [(5, rows[-1][1]), (5, rows[-1][1])]
    df = spark.createDataFrame([(*x, "w", 1, "h", "r") for x in rows], SCHEMA).repartition(4)
    words = counts(rows)
    assert results(spelling.grouped(df)) == expected(words, neighbours(words))


def test_long_chains_end_at_their_root(spark):
    chain = ["q" * 6 + "r" * k for k in range(7)]
    words = {w: 5 * 5**k for k, w in enumerate(chain)}
    df = spark.createDataFrame([(None, None, w, n, "h", "r") for w, n in words.items()], SCHEMA).select("word", "n")
    assert {r.root for r in spelling.variants(df).collect()} == {chain[-1]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spelling.grouped(none).collect() == []


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    words = counts(rows)
    assert results(QUERIES["op11_spelling"](spark, folder)) == expected(words, neighbours(words))
