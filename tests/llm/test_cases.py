"""Operators in plain Python once more, and rows that are empty, null, repeated or oddly named."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from titlelabels.llm import (
    additive_model,
    byte_pairs,
    decision_list,
    jaccard_join,
    main_text,
    mixing,
    order_minhash,
    passages,
    private_data,
    statistics,
    toxicity,
    words,
)
from titlelabels.llm.queries import tokenizer_path

FULL = (1 << 64) - 1
rnd = random.Random(8)
VOCABULARY = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 6))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


# Order MinHash in plain integers


def mixed(x):
    for _ in range(2):
        x = ((x ^ x >> 32) * int(words._ODD)) & FULL
    return x ^ x >> 32


def word_hash(word):
    if len(word) > words.LONG_WORD:
        import hashlib

        return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    base = int(words._BASE)
    return mixed((sum(c * pow(base, k, 1 << 64) for k, c in enumerate(word)) + len(word) * int(words._ODD)) & FULL)


def plain_signature(text):
    hashes = [word_hash(w) for w in text.encode().split()]
    factors = [int(f) for f in words._FACTORS]
    if len(hashes) < 2:
        pieces = [mixed(h * factors[1] & FULL) for h in hashes]
    else:
        pieces = [mixed((a * factors[2] + b * factors[0]) & FULL) for a, b in zip(hashes, hashes[1:], strict=False)]
    seen, numbered = {}, []
    for piece in pieces:
        seen[piece] = seen.get(piece, -1) + 1
        numbered.append(mixed((piece + seen[piece] * int(order_minhash._BASE)) & FULL))
    out = []
    for k in range(order_minhash.HASHES):
        mask, factor = int(order_minhash._MASKS[k]), int(order_minhash._FACTORS[k])
        least = sorted(range(len(numbered)), key=lambda i: ((numbered[i] >> 32 ^ mask) * factor) % (1 << 32))[: order_minhash.PICKED]
        value = 0
        for i in sorted(least):
            value = mixed((value * int(order_minhash._BASE) + numbered[i]) & FULL)
        out.append(value >> 48 if numbered else 0)
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 60, 300])
def test_order_minhash_equals_plain_integers(n):
    text = prose(n, n) + (" again and again and again" if n > 2 else "")
    assert order_minhash.signature(text).tolist() == plain_signature(text)


@pytest.mark.parametrize("n", [63, 64, 65, 127, 128, 129, 255, 256, 257, 511, 512, 513])
def test_one_word_more_keeps_the_likeness(n):
    text = " ".join(f"w{k}" for k in random.Random(n).sample(range(10**6), n))
    for more in (f"{text} new", f"new {text}"):
        assert order_minhash.likeness(order_minhash.signature(text), order_minhash.signature(more)) > 0.9


def thue_morse(letters):
    out = "a"
    while len(out) < letters:
        out += out.translate(str.maketrans("ab", "ba"))
    return out, out.translate(str.maketrans("ab", "ba"))


def test_long_words_that_differ_are_different(spark):
    one, two = thue_morse(2048)
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_set_keys_use_all_bits():
    keys = [jaccard_join.set_key(np.sort(np.random.default_rng(k).integers(0, 1 << 63, 5, dtype=np.uint64))) for k in range(400)]
    for bit in range(64):
        assert 120 < sum(key >> bit & 1 for key in keys) < 280, bit


# Scores in plain loops


def test_additive_scores_equal_a_plain_loop_over_tables(spark):
    r = random.Random(3)
    texts = [prose(r.randint(0, 80), k) + r.choice(["", "!!!", " 12 34", "\n\na\na\na"]) for k in range(300)]
    x = np.array([statistics.measure(t)[len(statistics.COUNTS) :] for t in texts])
    model = additive_model.learn(x, (x[:, 0] + x[:, 8] > np.median(x[:, 0] + x[:, 8])).astype(float))
    df = spark.createDataFrame([(k, t, 0.5) for k, t in enumerate(texts)], "doc_id long, text string, score double").repartition(3)
    got = {row.doc_id: row.score for row in additive_model.score(df, model, keep=("doc_id", "score")).collect()}
    for k, values in enumerate(x):
        raw = model.start
        for value, cuts, table in zip(values, model.cuts, model.tables, strict=True):
            raw += table[sum(value >= c for c in cuts)]
        for i, j, table in model.pairs:
            raw += table[sum(values[i] >= c for c in model.pair_cuts[i]), sum(values[j] >= c for c in model.pair_cuts[j])]
        assert got[k] == pytest.approx(1 / (1 + np.exp(-raw)), abs=1e-9)


def test_decision_list_verdicts_equal_its_conditions(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rules = decision_list.fit(docs, labels)
    assert rules
    got = {r.doc_id: r.kept for r in decision_list.apply(docs, rules).collect()}
    names = [*statistics.COUNTS, *statistics.SHARES]
    for r in docs.collect():
        values = dict(zip(names, statistics.measure(r.text), strict=True))
        base = values["n_words"] < 50 or 100 * values["n_repeat_words"] > 50 * values["n_words"]
        rejected = any(all(c.holds(np.array([values[c.name]]))[0] for c in rule.conditions) for rule in rules)
        assert got[r.doc_id] == (not base and not rejected), r.doc_id


# Pages


def test_links_end_with_their_block():
    para = "Some running text of a paragraph, long enough to count. " * 3
    page = f"<div><p>Hi <a href=x>a link</p><p>{para}</p><p>{para}</p></div>"
    assert main_text.extract(page).endswith(f"{para.strip()}\n{para.strip()}")


@pytest.mark.parametrize("depth", [1, 7, 8, 9, 40])
def test_adverts_go_at_any_depth_of_named_parts(depth):
    para = "Some running text of a paragraph, long enough to count. " * 9
    page = "<div class='legal'>" * depth + f"<p>{para}</p><div class='ad'>Buy this now, cheap, today only.</div>" + "</div>" * depth
    assert main_text.extract(page) == para.strip()


# Rows


def test_spans_are_cut_by_row(spark):
    one, two = prose(90, 1), prose(90, 2)
    rows = [(1, one, "a"), (5, one, "b"), (5, two, "c"), (None, one, "d"), (None, None, "e"), (None, two, "f")]
    out = passages.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, __x string"))
    assert out.columns == ["doc_id", "text", "__x"]
    got = {r[2]: r[1] for r in out.collect()}
    assert (got["a"], got["c"], got["e"]) == (one, two, None)
    assert [got[x].strip() for x in "bdf"] == ["", "", ""]


EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EMPTY)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, k % 2, int(k % 7 == 0)) for k in range(80)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_empty_tables(spark, empty, labels):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text.main_text(pages).collect() == []
    assert additive_model.quality(empty, labels).collect() == []
    assert toxicity.judged(empty, labels).collect() == []
    assert private_data.digest(empty).collect() == [] and private_data.mask(empty).collect() == []
    assert byte_pairs.round_trip(empty, tokenizer_path()).collect() == []
    assert decision_list.apply(empty, decision_list.fit(empty, labels)).collect() == []
    assert jaccard_join.one_per_component(empty).collect() == []
    assert passages.without_repeats(empty).collect() == []
    assert mixing.mixed(empty).collect() == []


def test_pipeline_stages_of_an_empty_table(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.collect() == []


def odd_rows(spark):
    """Null and repeated ids, a very long text, columns whose names operators use themselves."""
    rows = [(k, prose(60, k), "x") for k in range(40)]
    rows += [(None, prose(60, 3), "x"), (None, None, "x"), (7, prose(60, 7), "x"), (7, "", "x"), (7, prose(60, 99), "x"), (50, prose(60_000, 5), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = {c: F.lit("x") for c in ("score", "spans", "label", "n", "id", "node", "begin", "n_words", "kept", "html", "n_tokens")}
    return df.withColumns({**clash, "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")}), len(rows)


def test_null_and_repeated_ids_long_texts_and_clashing_names(spark, labels):
    docs, n = odd_rows(spark)
    whole = {
        "quality": additive_model.quality(docs, labels),
        "toxicity": toxicity.judged(docs, labels),
        "private data": private_data.digest(docs),
        "byte pairs": byte_pairs.round_trip(docs, tokenizer_path()),
        "decision list": decision_list.apply(docs, decision_list.fit(docs, labels)),
        "order minhash": order_minhash.compare_edited(docs),
        "jaccard join": jaccard_join.near_duplicates(docs),
        "masked": private_data.mask(docs),
        "without repeats": passages.without_repeats(docs),
        "mixing": mixing.word_counts(docs),
    }
    ids = sorted((r.doc_id for r in docs.collect()), key=str)
    for name, out in whole.items():
        got = sorted((r["doc_id"] for r in out.collect()), key=str)
        assert got == ids and len(got) == n, name
    assert passages.repeats(docs).count() > 0


def test_pages_with_columns_of_the_results(spark):
    pages = spark.createDataFrame([(1, "u", "<p>some text of a page</p>", "old", 9), (None, None, None, None, None)], "page_id long, url string, html string, text string, n_chars long")
    got = {r.page_id: (r.text, r.n_chars) for r in main_text.main_text(pages, keep=("page_id", "text", "n_chars")).collect()}
    assert got == {1: ("some text of a page", 19), None: ("", 0)}


# Tiles of the Jaccard join


def test_tiles_give_the_pairs_of_a_join(spark, monkeypatch):
    """Near copies in large buckets: whatever the size from which buckets are cut, and into however many blocks, the same pairs come out."""
    r = random.Random(4)
    rows, bits = [], []
    for k in range(240):
        base = np.random.default_rng(k % 6).integers(0, 1 << 63, 90 if k % 6 else 70, dtype=np.uint64) * np.uint64(2) + np.uint64(k % 2)
        own = np.random.default_rng(1000 + k).integers(0, 1 << 63, 40, dtype=np.uint64)
        found = np.unique(np.concatenate([base, own[: 1 + r.randrange(0, 16)]]))
        node = jaccard_join.set_key(found)
        bits.append((node, jaccard_join.parity_bits(found).tolist()))
        length = jaccard_join.prefix_length(len(found))
        rows += [(int(b), node, len(found), length, length, 9, k, False) for b in range(k % 6, 120, 6)]
    left = spark.createDataFrame(rows, "shingle long, node long, n int, length int, met int, shared int, component long, hot boolean")
    known = spark.createDataFrame(bits, "node long, bits array<long>")
    got = []
    for small, tile in ((1000, 1000), (0, 1000), (0, 7), (16, 16)):
        monkeypatch.setattr(jaccard_join, "SMALL", small)
        monkeypatch.setattr(jaccard_join, "TILE", tile)
        got.append({tuple(x) for x in jaccard_join._rest(left, known).collect()})
    assert len(got[0]) > 100
    for other in got[1:]:
        assert sorted(other - got[0]) == sorted(got[0] - other) == []


def test_parity_bits_never_differ_more_than_the_sets():
    for k in range(60):
        g = np.random.default_rng(k)
        one = np.unique(g.integers(0, 1 << 63, int(g.integers(1, 400)), dtype=np.uint64))
        two = np.unique(np.concatenate([one[g.random(len(one)) < 0.9], g.integers(0, 1 << 63, 9, dtype=np.uint64)]))
        a, b = sorted((jaccard_join.parity_bits(one), jaccard_join.parity_bits(two)), key=len)
        while len(b) > len(a):
            b = b[: len(b) // 2] ^ b[len(b) // 2 :]
        differ = sum(bin(int(x) & FULL).count("1") for x in a ^ b)
        assert differ <= len(np.setxor1d(one, two))


def test_a_forest_connects_what_all_pairs_connect():
    r = np.random.default_rng(5)
    pairs = np.stack([r.integers(0, 60, 400), r.integers(60, 120, 400), *r.integers(50, 90, (2, 400)), r.integers(0, 30, 400), r.integers(30, 50, 400), r.integers(0, 20, 400)])

    def groups(found):
        where = {x: {x} for x in range(50)}
        for a, b in found[4:6].T.tolist():
            if where[a] is not where[b]:
                joined = where[a] | where[b]
                for x in joined:
                    where[x] = joined
        return {frozenset(x) for x in where.values()}

    kept = jaccard_join.forest(pairs)
    assert groups(kept) == groups(pairs) and kept.shape[1] == 50 - len(groups(pairs))
    assert jaccard_join.forest(pairs[:, :0]).shape == (7, 0)


def test_encoder_remembers_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(byte_pairs, "MEMO", 32)
    with open(tokenizer_path(), encoding="utf-8") as f:
        vocabulary = f.read()
    own, fresh = byte_pairs.Encoder(vocabulary), byte_pairs.Encoder(vocabulary)
    texts = [" ".join(f"w{k % 90}x{k % 7} the" for k in range(at, at + 40)) for at in range(0, 900, 20)]
    for text in [*texts, *texts]:
        fresh.memo.clear()
        fresh.older.clear()
        assert own.encode(text) == fresh.encode(text)
        assert len(own.memo) <= 32 and len(own.older) <= 32
    assert own.memo and own.older  # words met again are remembered, those of the generation before too


@pytest.mark.parametrize(("stage", "operator", "name"), [("toxicity", toxicity, "toxicity"), ("personal data", private_data, "mask"), ("encoding", byte_pairs, "encode")])
def test_pipeline_sends_few_texts_at_a_time_to_python(spark, monkeypatch, stage, operator, name):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(batch.num_rows)])], names=["score"])

    monkeypatch.setattr(operator, name, lambda docs, *_, **__: docs.mapInArrow(sizes, "score double"))
    monkeypatch.setattr(toxicity, "THRESHOLD", 1e9)
    docs = spark.range(3000).coalesce(1).selectExpr("cast(id AS double) AS score")
    found = dict(corpus_pipeline.STAGES)[stage](spark, docs, "/root/testdata/sf0.001")
    assert found.agg(F.max("score"), F.sum("score")).first() == (512.0, 3000.0)


def test_paragraphs_of_a_large_band_are_not_all_compared(spark, monkeypatch):
    compared = []

    def counted(pairs, parts, overlaps=jaccard_join.overlaps):
        compared.append(pairs.count())
        return overlaps(pairs, parts)

    for module in (jaccard_join, passages):
        monkeypatch.setattr(module, "overlaps", counted, raising=False)
    r = random.Random(3)
    base, rows = prose(60, 91).split(), []
    for i in range(240):  # alike enough to collide in bands, too little to be linked
        text = base.copy()
        for at in (r.randrange(5, 25), r.randrange(35, 55)):
            text[at] = f"neu{r.randrange(10**9)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame([*rows, (900, " ".join(base)), (901, " ".join([*base, "end"]))], "id long, text string")
    paragraphs = passages.units(docs).where("n is not null").select("key", "id", "begin", "end")
    assert passages.linked(docs, paragraphs).distinct().count() == 1
    assert compared and sum(compared) <= 2 * len(rows), compared
