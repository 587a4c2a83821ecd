"""Operators against brute force, on small tables with nulls, empty, long and repeated texts."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from titlelabels import session
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
)
from titlelabels.llm.graph import components
from titlelabels.llm.queries import QUERIES, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, mix int, node long"
rnd = random.Random(5)
WORDS = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 6))) for _ in range(400)]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def corpus() -> list[tuple]:
    texts: list[str | None] = [None, "", "   \n", "one", "Ein Wort", prose(5, 1), prose(4000, 2) + "\n" + "x" * 50_000]
    base = prose(120, 3).split()
    for k in range(40):  # near copies of one text, exact copies among them
        new = list(base)
        for _ in range(k % 6):
            new[random.Random(k).randrange(len(new))] = f"neu{k}"
        texts.append(" ".join(new).upper() if k % 7 == 0 else " ".join(new))
    shared = prose(60, 4)
    for k in range(12):
        texts.append(prose(200, 50 + k) + " " + shared + " " + prose(90, 90 + k))
    texts += [prose(80, 200 + k) for k in range(25)]
    rows = [(k * 3, t, "en", [None, "a", "b", "a"][k % 4], len(t or ""), 1, "s", 2, 3) for k, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()


def shingles_of(words):
    return frozenset(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()


# Mixing


def test_mixing_equals_sql(spark, docs):
    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841  (read by DuckDB)
    want = sorted(con.execute(mixing.sql()).fetchall())
    got = sorted(tuple(r) for r in mixing.word_counts(docs).collect())
    assert got == want
    taken, target = defaultdict(int), {}
    sources = {r.doc_id: r.source for r in docs.collect()}
    for i, size, _, goal, words, _ in got:
        assert 0 <= words <= 2 * size
        taken[sources[i]] += words
        target[sources[i]] = goal
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_mixing_sources_keep_out_of_each_others_way(spark):
    rows = [(k, "w " * 10, "en", "big", 20, 1, "", 1, 1) for k in range(90)]
    rows += [(100 + k, "w " * 10, "en", s, 20, 1, "", 1, 1) for k, s in enumerate(["a", "a", "c"])]
    got = mixing.word_counts(spark.createDataFrame(rows, SCHEMA)).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert all(r.t == int(r.target + 0.5) for r in got)
    assert sum(r.t for r in got) == pytest.approx(1.5 * 930, abs=2)


def test_mixed_documents_are_whole_and_at_most_twice(spark, docs, empty):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = defaultdict(int)
    for r in out.collect():
        assert r.text == texts[r.doc_id] and r.text.split()
        seen[r.doc_id] += 1
    assert max(seen.values()) <= 2
    assert mixing.mixed(empty).count() == 0 and mixing.word_counts(empty).count() == 0


# Fingerprints


def test_fingerprints_of_neighbours(spark, docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in order_minhash.compare_edited(docs).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        one, two, three = map(order_minhash.signature, (text, edited, after))
        assert (r.fingerprint, r.edited_fingerprint) == (order_minhash.written(one), order_minhash.written(two))
        assert (r.near_edited, r.near_next) == (order_minhash.likeness(one, two), order_minhash.likeness(one, three))


def test_fingerprints_with_ties_nulls_and_one_row(spark, empty):
    rows = [(1, "a b c"), (1, "a b d"), (None, "x y"), (None, None), (7, "q r s")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = order_minhash.compare_edited(df).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "7", "None", "None"]
    one = order_minhash.compare_edited(df.where("doc_id = 7")).first()
    assert one.near_next == 1.0 and one.near_edited < 1.0
    assert order_minhash.compare_edited(empty).count() == 0


def test_fingerprint_feels_order():
    text = prose(300, 8)
    words = text.split()
    swapped = " ".join(words[150:] + words[:150])
    near = order_minhash.likeness(order_minhash.signature(text), order_minhash.signature(swapped))
    assert near < 0.75 and order_minhash.likeness(order_minhash.signature(text), order_minhash.signature(text + "")) == 1.0
    numbered = order_minhash.numbered_pieces("a b a b a b")[0]
    assert len(set(numbered.tolist())) == 5  # equal pieces differ by their number


# Near duplicates


def brute_components(rows):
    sets = {i: shingles_of(words_of(t)) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark, docs, empty):
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)
    kept = {r.doc_id for r in jaccard_join.one_per_component(docs).collect()}
    assert kept == {c for _, c in want.values()}
    assert jaccard_join.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_near_the_threshold(spark, seed):
    r = random.Random(seed)
    base = [[f"w{r.randrange(10**6)}" for _ in range(r.randint(5, 60))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = list(r.choice(base))
        for _ in range(r.randint(0, 2)):
            words[r.randrange(len(words))] = r.choice(["alpha", "beta", f"z{r.randrange(50)}"])
        rows.append((i, " ".join(words[: len(words) - r.randint(0, 2)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_with_null_and_equal_ids(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "x y z"), (None, None)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == [
        ("5", 1, "5"), ("5", 2, "5"), ("None", 0, "None"), ("None", 2, "5"),
    ]


def test_one_row_of_each_component_stays(spark):
    a, b, c = prose(60, 901), prose(60, 902), prose(60, 903)
    near = c.rsplit(" ", 1)[0] + " other"
    rows = [(1, a, "p"), (5, a, "q"), (5, b, "r"), (6, b + " ", "s"), (7, c, "t"), (7, c, "t"), (7, near, "t"), (None, a, "u"), (None, near, "v")]
    rows += [(None, prose(60, 904), x) for x in "wxw"] + [(None, None, "y"), (5, "", "z"), (5, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(3)
    got = [tuple(r) for r in jaccard_join.one_per_component(df).collect()]
    assert sorted(x for _, t, x in got if not t) == ["y", "z", "z"]
    got = [r for r in got if r[1]]
    assert sorted(str(i) for i, _, _ in got) == ["1", "5", "7", "None"] and set(got) <= set(rows)
    assert {(1, a, "p"), (5, b, "r")} <= set(got)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 160)}


# Main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>More</a></ul></nav><div class="ad">buy &amp; save</div>
<article><header><h1>Head &amp; line</h1></header><p><b>First&nbsp; para<br>graph<p>Short.</p><aside>no</aside>
<form><input value=x>send</form><p>A &#8212; b</p><div class="comments"><p>me too</p></div></article>
<div id="sidebar"><p>side</p></div><footer>&copy; me</footer>"""


def test_main_text_of_an_article():
    assert main_text.extract(PAGE) == "Head & line\nFirst para graph\nShort.\nA — b"


def test_main_text_without_an_article():
    long, other = "many words here " * 10, "further text of the page " * 8
    page = f"<body><div><a href=1>One</a></div><div><a href=2>Two</a></div><div><a href=3>Three</a></div><div><a>Four</a></div><div>{long}</div><div>short one</div><p>{other}</p><ul>" + "<li><a href=x>link</a>" * 5 + "</ul><p>tail</p>"
    assert main_text.extract(page) == f"{long.strip()}\nshort one\n{other.strip()}"


def test_main_text_of_odd_pages(spark):
    assert [main_text.extract(x) for x in (None, "", "<p>", "just text", "<script>never closed")] == ["", "", "", "just text", ""]
    for bad in ("<div" * 20_000, "<title" * 20_000, "<div>" * 20_000 + "x", "<!--" * 20_000, "<p a='" * 20_000):
        main_text.extract(bad)
    df = spark.createDataFrame([(1, "u", PAGE), (2, None, None)], "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in main_text.main_text(df).collect()}
    assert got[2] == ("", 0) and got[1][1] == len(got[1][0]) > 30


def test_main_text_of_parts_with_misleading_names():
    long = "many words here " * 10
    for around in ('<main class="has-sidebar">', '<div id="content" class="no-sidebar">', '<article class="post comments-open">', '<div class="legal-news">',
                   '<div class="sidebar"><main>', '<body class="widget"><div class="social">', '<article class="ad">'):
        page = f'<nav><a href=/>Home</a></nav>{around}<h1>Head</h1><p>{long}<div class="comments"><p>me too</div><div class="ad-box">buy</div>'
        assert main_text.extract(page) == f"Head\n{long.strip()}", around
    page = f'<article><p>{long}</p><div class="comments">{"<p>" + long * 3 + "</p>"}</div></article><aside><article>{long}</article></aside>'
    assert main_text.extract(page) == long.strip()


def test_main_text_ranks_regions_by_their_sums():
    long, other = "many words here " * 10, "further text of the page " * 8
    card = "<article><h3>Read</h3><p>a few words</p></article>"
    assert main_text.extract(f"<div><p>{long}</p><p>{other}</p></div>{card}") == f"{long.strip()}\n{other.strip()}"
    assert main_text.extract(f"<div><p>{long * 9}</p></div><article><p>{long}</p></article>") == f"{(long * 9).strip()}\n{long.strip()}"
    advert = '<div class="ad">buy now</div>'
    page = f"<div><h1>Head</h1>{advert}<p>{long}</p>{advert}<p>short</p>{advert}<p>{other}</p>{advert}<p>The end.</p></div>{advert}<div><p>elsewhere</p></div>"
    assert main_text.extract(page) == f"Head\n{long.strip()}\nshort\n{other.strip()}\nThe end."


def test_main_text_of_all_pages(spark):
    import html

    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r.text for r in QUERIES["op4_main_text"](spark, folder).collect()}
    for i, page in duckdb.execute(f"SELECT page_id, html FROM '{folder}/pages.parquet'").fetchall():
        inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = [html.unescape(re.sub(r"</?b>|<br>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert got[i] == "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


# Quality


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    hit = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_counts_equal_brute_force():
    r = random.Random(2)
    for _ in range(400):
        text = "".join(r.choice(["a ", "b ", "c ", "é#\n", "a b a\n", "\x1c", " ", " \t\n", "|&"]) for _ in range(r.randint(0, 40)))
        assert statistics.measure(text)[:5] == brute_counts(text)
    assert statistics.measure(None)[:5] == (0, 0, 0, 0, 0)
    for text in [t for _, t, *_ in corpus()]:
        assert statistics.measure(text)[:5] == brute_counts(text)


def test_decision_list_finds_planted_rules():
    r = np.random.default_rng(1)
    x = {c: r.random(3000) for c in statistics.SHARES}
    good = ~((x["symbol_share"] > 0.8) | ((x["upper_share"] > 0.7) & (x["unique_share"] <= 0.4)))
    rules = decision_list.learn(x, good.astype(int))
    bad = np.zeros(3000, bool)
    for rule in rules:
        bad |= np.logical_and.reduce([c.holds(x[c.name]) for c in rule.conditions])
    assert (bad == ~good).mean() > 0.97
    assert decision_list.learn(x, np.ones(3000)) == []


def test_decision_list_over_documents(spark, docs, empty):
    labels = spark.createDataFrame([(3 * k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    out = decision_list.apply(docs, decision_list.fit(docs, labels)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(out) == len(texts)
    for r in out:
        n, chars, symbols, dup, repeated = brute_counts(texts[r.doc_id])
        failed = n < 50 or 100 * repeated > 50 * n
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, chars, symbols, dup, repeated, failed)
        assert not (failed and r.kept)
    assert decision_list.fit(docs, labels.limit(0)) == []
    assert decision_list.apply(empty, []).count() == 0


def test_additive_model_learns_shapes_and_pairs():
    r = np.random.default_rng(3)
    x = r.random((6000, len(statistics.SHARES)))
    y = (((x[:, 0] > 0.4) & (x[:, 0] < 0.6)) | ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5))).astype(float)
    model = additive_model.learn(x[:4000], y[:4000])
    score = model.score(x[4000:])
    assert ((score >= 0.5) == y[4000:]).mean() > 0.93
    assert score.min() >= 0 and score.max() <= 1
    assert any({i, j} == {1, 2} for i, j, _ in model.pairs)
    assert additive_model.learn(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


def held_out(got, labels, name):
    truth = {r.doc_id: r[name] for r in labels.collect()}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    ones = [r.predicted for r in held if truth[r.doc_id] == 1]
    zeros = [r.predicted for r in held if truth[r.doc_id] == 0]
    return sum(ones) / len(ones), sum(zeros) / len(zeros)


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op5_additive_model"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    found, wrong = held_out(got, spark.read.parquet(f"{folder}/labels.parquet"), "quality")
    assert found > 0.97 and wrong < 0.1


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    found, wrong = held_out(got, spark.read.parquet(f"{folder}/labels.parquet"), "toxic")
    assert found > 0.8 and wrong < 0.05


def test_toxicity_reads_misspellings_and_odd_texts(spark, docs):
    r = random.Random(4)
    bags = [[r.choice(WORDS) for _ in range(30)] + (["dreadful"] if k % 5 == 0 else []) for k in range(400)]
    model = toxicity.learn(bags, np.array([int(k % 5 == 0) for k in range(400)]))
    assert model.score("a dreadful thing") > 0.8 and model.score("dreadfull!") > 0.5
    assert model.score(" ".join(WORDS[:50])) < 0.3
    assert all(0 <= model.score(t) < 0.3 for t in (None, "", " \n", "..."))
    one = toxicity.words_of("The THE the, Über")
    assert one == ["the", "über"]
    none = toxicity.judged(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {(x.score, x.predicted) for x in none.collect()} == {(0.0, 0)}


def test_word_values_equal_a_plain_loop():
    table = np.random.default_rng(6).random(toxicity.BUCKETS)
    text = "ab abcdé, x  longer-word"
    got = toxicity.word_values(text.encode(), table)
    words = re.findall(rb"[0-9a-z\x80-\xff]+", text.encode())
    assert len(got) == len(words)
    for word, value in zip(words, got, strict=True):
        spelled = b" " + word + b" "
        keys = []
        for n in toxicity.SIZES:
            for k in range(len(spelled) - n + 1):
                piece = np.frombuffer(spelled[k : k + n], np.uint8).astype(np.uint64)
                keys.append(int(toxicity.mix(np.array([(piece * toxicity._FACTORS[:n]).sum(dtype=np.uint64)]))[0]) % toxicity.BUCKETS)
        assert value == pytest.approx(table[keys].mean())


# Personal data


def brute_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(v if k % 2 == 0 else v * 2 - 9 * (v > 4) for k, v in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_private_data_equals_the_patterns():
    r = random.Random(3)
    kinds = ["ab@@..c-+", "0123456789. -", "+(0) 12-3.", "0123456789", "@a.b", "é１ "]
    for _ in range(20_000):
        t = "".join(r.choice(r.choice(kinds)) for _ in range(r.randint(0, 50)))
        assert [s for s in private_data.spans(t) if s[0] in private_data.BASE_KINDS] == brute_spans(t)
    for long in ("1" * 100_000, "a" * 100_000 + "@", "+1" + " " * 100_000, "1." * 50_000, "a@" * 50_000, "://" * 50_000):
        private_data.spans(long)


def test_private_data_of_cues_and_masks(spark, docs):
    text = 'to a.b@c.de, token = "74e9e412cf0507f8", account no. 1234567, IBAN DE89 3704 0044 0532 0130 00 at https://x.y/z.'
    assert [s[0] for s in private_data.spans(text)] == ["email", "account", "account", "secret", "url"]
    assert private_data.masked(text) == 'to <EMAIL>, token = "<SECRET>", account no. <ACCOUNT>, IBAN <ACCOUNT> at <URL>.'
    assert private_data.masked(None) is None and private_data.masked("") == ""
    same = private_data.mask(docs)
    assert same.columns == docs.columns and sorted(map(str, same.collect())) == sorted(map(str, docs.collect()))
    got = {r.doc_id: r for r in private_data.digest(docs).collect()}
    assert got[0].spans == "" and got[0].base_sha256 == hashlib.sha256(b"").hexdigest()


# Byte pairs


def test_encoding_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    with open(tokenizer_path(), encoding="utf-8") as f:
        own = byte_pairs.Encoder(f.read())
    r = random.Random(7)
    tokens = list(own.words.tokens.values())
    texts = [t or "" for _, t, *_ in corpus()] + ["a<|endoftext|>b <|endoftext|>", " lead", "two  blanks \n end ", "x" * 3000]
    texts += ["".join(r.choice("abcdehinorst  'é<|>\nあ1２") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += [b"".join(r.choice(tokens) for _ in range(3)).decode("utf-8", "replace") for _ in range(1500)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(t), "<u4").tolist() == ids
        assert own.decode(own.encode(t)).decode() == library.decode(ids, skip_special_tokens=False)
    coded = byte_pairs.encode(docs, tokenizer_path(), keep=("doc_id", "size"))
    back = {x.doc_id: x.text for x in byte_pairs.decode(coded, tokenizer_path()).collect()}
    assert back == {x.doc_id: x.text or "" for x in docs.collect()}


# Passages


def test_passages_find_every_shared_run_of_over_fifty_words(spark, docs, empty):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    runs = defaultdict(set)
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - 50):
            runs[tuple(w[k : k + 51])].add(i)
    want = set().union(*[v for v in runs.values() if len(v) > 1])
    got = passages.repeats(docs).collect()
    assert want <= {r.doc_id for r in got}
    clean = {r.doc_id for r in docs.collect()} - want
    alike = {i for i in clean for j, (_, t) in enumerate(rows) if rows[j][0] != i and set(words_of(t)) == set(words_of(dict(rows)[i]))}
    assert not {r.doc_id for r in got if r.kind == "passage"} & (clean - alike - {i for i, t in rows if "neu" in t.lower()})
    texts = dict(rows)
    assert all(0 <= r.begin < r.end <= len(texts[r.doc_id]) for r in got)
    assert any(not r.removed for r in got) and any(r.removed for r in got)
    assert passages.repeats(empty).count() == 0


def test_passages_cluster_near_paragraphs_and_cut_them(spark):
    one = prose(100, 31)
    two = one.replace(one.split()[50], "changed", 1)
    rows = [(1, "top line here\n" + one, "x"), (2, two + "\nfoot", "y"), (3, prose(100, 32), "z"), (4, None, "n"), (5, "é " + one, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    found = passages.repeats(df).where("kind = 'paragraph'").collect()
    assert {(r.doc_id, r.removed) for r in found} == {(1, False), (2, True), (5, True)} and len({r.cluster for r in found}) == 1
    out = {r.doc_id: r.text for r in passages.without_repeats(df).collect()}
    assert out[1] == rows[0][1] and out[3] == rows[2][1] and out[4] is None
    assert out[2].strip() == "foot" and out[5].strip() == ""


def test_paragraphs_that_meet_in_a_band_are_all_compared(spark):
    r = random.Random(11)
    rows = []
    for group in range(3):  # drifting copies: every one is near its neighbours only
        words = prose(60, 300 + group).split()
        for _ in range(60):
            words[r.randrange(60)] = f"neu{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    docs = df.select(F.col("doc_id").alias("id"), "text")
    sets = {i: next(iter(passages.Text(t).paragraphs()))[2] for i, t in rows}
    keys = {i: passages.set_key(s) for i, s in sets.items()}
    held = defaultdict(set)
    for i, s in sets.items():
        for band in passages.bands(s).tolist():
            held[band].add(i)
    parent = {k: k for k in keys.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for members in held.values():
        for a in members:
            for b in members:
                both = len(np.intersect1d(sets[a], sets[b]))
                if a < b and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(keys[a]), find(keys[b])
                    parent[max(x, y)] = min(x, y)
    want = {k: find(k) for k in parent}
    paragraphs = passages.units(docs).where("n is not null").select("key", "id", "begin", "end")
    got = {x.node: x.component for x in components(passages.linked(docs, paragraphs)).collect()}
    assert {k: got.get(k, k) for k in want} == want


def test_short_lines_and_wrapped_paragraphs_take_part(spark):
    words = prose(63, 41).split()
    wrapped = lambda w: "\n".join(" ".join(w[k : k + 7]) for k in range(0, 63, 7))
    rows = [(1, "All rights reserved\n\n" + wrapped(words)), (2, prose(30, 42) + "\nall rights reserved"), (3, prose(30, 43) + "\n" + wrapped([*words[:-1], "changed"])), (4, "alone here")]
    found = passages.repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("kind = 'paragraph'").collect()
    texts = dict(rows)
    spans = {(r.doc_id, texts[r.doc_id][r.begin : r.end].lower(), r.removed) for r in found}
    assert {(1, "all rights reserved", False), (2, "all rights reserved", True)} <= spans
    assert {(1, wrapped(words).lower(), False), (3, wrapped([*words[:-1], "changed"]).lower(), True)} <= spans
    assert not [r for r in found if r.doc_id == 4]


def test_passages_cover_shared_runs_to_their_ends(spark):
    rows = []
    for k in range(30):  # runs of 51 words and more, in three documents each; a part of some is in an earlier one
        inner = prose(51 + 3 * k, 500 + k)
        if k % 3 == 0:
            rows.append((len(rows), prose(40, 600 + k) + " " + " ".join(inner.split()[8:-9]) + " " + prose(30, 650 + k)))
        rows += [(len(rows) + j, prose(35 + k, 700 + 3 * k + j) + "\n" * (j % 2) + " é " + inner + " " + prose(25, 800 + 3 * k + j)) for j in range(3)]
    rows += [(900 + j, "same " * 120) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = defaultdict(list)
    for x in passages.repeats(df).where("kind = 'passage' and removed").collect():
        got[x.doc_id].append((x.begin, x.end))
    first, runs = {}, defaultdict(set)
    for i, text in rows:
        spots = [m.span() for m in re.finditer(r"\S+", text)]
        words = [text[a:b].lower() for a, b in spots]
        for size, seen in ((51, True), (20, False)):
            for k in range(len(words) - size + 1):
                run = tuple(words[k : k + size])
                if first.setdefault(run, i) != i:
                    if seen:
                        assert any(a <= spots[k][0] and spots[k + size - 1][1] <= b for a, b in got[i]), (i, k)
                    else:
                        runs[i] |= set(range(spots[k][0], spots[k + 19][1]))
    for i, spans in got.items():  # and nothing but repeated runs
        assert {x for a, b in spans for x in range(a, b)} <= runs[i] | (set(range(600)) if i == 900 else set())
    out = {x.doc_id: x.text for x in passages.without_repeats(df).collect()}
    assert out[900].split()[:20] == ["same"] * 20 and out[901].strip() == ""


def test_windows_do_not_depend_on_what_stands_around():
    inner = prose(51, 77)
    own = set(passages.Text(prose(30, 1) + " " + inner + " " + prose(40, 2)).windows()[0].tolist())
    other = set(passages.Text(prose(9, 3) + "\n" + inner).windows()[0].tolist())
    assert own & other


def test_many_texts_give_what_each_gives_alone():
    r = random.Random(21)
    texts = ["", "\n", "one", " a\nb ", "wé " * 19, "x " * 30, "Same " * 90, *[" ".join(r.choice(["a", "Bé", "c\n", "\n", "dd"]) for _ in range(r.randrange(45))) for _ in range(60)]]
    texts += [prose(20 + 7 * k, 950 + k) + "\n" * (k % 3) + prose(9, k) for k in range(20)]
    own = passages.Texts([t.encode() for t in texts])
    a, b, _ = own.ranges()
    found, sizes = own.sets(a, b)
    keys, begins, ends, doc = own.placed(a, b, passages.set_keys(found, sizes))
    bits, words = jaccard_join.parity_bits_of(found, sizes)
    windows = own.windows()
    for i, t in enumerate(texts):
        alone, want = passages.Text(t), []
        for x, y, s in alone.paragraphs():
            assert t.encode().decode()[x:y].split() and s.tolist() == sorted({*s.tolist()})
            want.append((passages.set_key(s), x, y, len(s), jaccard_join.parity_bits(s).tolist(), passages.bands(s).tolist()))
        at = np.flatnonzero(doc == i).tolist()
        cut = np.cumsum(words) - words
        banded = passages.bands_of(found, sizes)
        got = [(int(keys.view(np.int64)[k]), begins[k], ends[k], sizes[k], bits[cut[k] : cut[k] + words[k]].tolist(), banded[k].tolist()) for k in at]
        assert got == want
        assert [c[windows[3] == i].tolist() for c in windows[:3]] == [c.tolist() for c in alone.windows()[:3]]


def test_bands_come_from_the_pass_that_finds_paragraphs(spark):
    base = prose(40, 61).split()
    rows = [(k, "\n".join([" ".join([*base[:k], f"neu{k}", *base[k + 1 :]]), prose(25, 62 + k), "a few words"])) for k in range(12)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    sets = passages.units(docs).where("bands is not null").withColumnRenamed("key", "node")
    got = sorted((x.band, x.node) for x in passages.colliding(sets).collect())
    held = defaultdict(set)
    for _, t in rows:
        for _, _, s in passages.Text(t).paragraphs():
            for band in passages.bands(s).view(np.int64).tolist() if len(s) >= passages.LEAST_SET else []:
                held[band].add(passages.set_key(s))
    assert got == sorted((band, node) for band, nodes in held.items() if len(nodes) > 1 for node in nodes) and got


def test_runs_of_copies_are_looked_up_in_pieces(spark):
    inner = prose(300, 71)
    rows = [(k, f"{prose(30, 720 + k)} {inner} {prose(30, 760 + k)}") for k in range(12)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    windows = passages.units(docs).where("n is null").select("key", "id", "begin")
    seeds = windows.join(windows.groupBy("key").agg(F.count_distinct("id").alias("n")).where("n > 1"), "key").select("id", "begin")
    runs = 12 * 281
    pieces = passages.seeded(docs, seeds).collect()
    assert len(pieces) <= runs // 3 and sum(len(x.runs) for x in pieces) >= runs * passages.RUN.itemsize
    assert len({x.piece for x in pieces}) <= len(pieces) // 2  # equal passages fall into equal pieces
    found = passages.repeats(docs, "id").where("kind = 'passage'").collect()
    texts = dict(rows)
    assert sorted((x.id, texts[x.id][x.begin : x.end], x.removed) for x in found) == [(k, inner, k > 0) for k in range(12)] and len({x.cluster for x in found}) == 1


def test_sorted_rows_come_in_whole_groups():
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 3, 4, 5, 5]
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(range(12))], names=["key", "at"])
    for size in (1, 2, 3, 5, 12):
        got = list(passages._whole((rows.slice(k, size) for k in range(0, 12, size)), ["key"]))
        assert [x for b in got for x in b.column("at").to_pylist()] == list(range(12))
        ends = [{*b.column("key").to_pylist()} for b in got]
        assert sum(map(len, ends)) == 5


# Registered queries and the pipeline


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder).cache()
        seen[name] = (docs, out)
        docs = out
    assert all(out.columns == columns for name, (_, out) in seen.items() if name != "encoding")
    before, after = seen["near duplicates"]
    ids = {i for _, i in brute_components([(r.doc_id, r.text) for r in before.collect()]).values()}
    assert {r.doc_id for r in after.collect()} == ids
    before, after = seen["personal data"]
    assert before.count() == after.count() and not [r for r in after.collect() if brute_spans(r.text)]
    before, after = seen["encoding"]
    back = byte_pairs.decode(after, tokenizer_path()).select("text").collect()
    assert sorted(r.text for r in back) == sorted(r.text for r in before.collect())


def _shuffle_files(root):
    return [f for f in root.rglob("shuffle_*") if f.suffix == ".data"]


def test_kept_tables_leave_no_shuffle_files(spark, tmp_path):
    settings = [spark.conf.get(k) for k in (session.DROP_SHUFFLES, session.ARROW_ROWS)]
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(d.toString()) for d in manager.localDirs()]
    before = {f for d in folders for f in _shuffle_files(d)}
    rows = spark.range(10_000).groupBy((F.col("id") % 1_000).alias("k")).agg(F.count("*").alias("n"))
    with session.scratch(spark):
        kept = session.checkpointed(rows)
        for _ in range(50):  # files are removed in the background
            if not (left := {f for d in folders for f in _shuffle_files(d)} - before):
                break
            time.sleep(0.1)
        assert kept.count() == 1_000 and not left
    assert settings == [spark.conf.get(k) for k in (session.DROP_SHUFFLES, session.ARROW_ROWS)]


def test_passages_leave_only_what_later_steps_read(spark, monkeypatch, tmp_path):
    root = tmp_path / "shared"
    monkeypatch.setattr(session, "checkpoint_root", lambda spark: str(root))
    same = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a b {same}"), (2, f"{same} c d"), (3, "none of it")], "doc_id long, text string")
    got = sorted((r.doc_id, r.kind) for r in passages.repeats(docs).collect())
    assert {d for d, _ in got} == {1, 2}
    left = [p for p in root.iterdir() if p.is_dir()]
    assert len(left) == 1 and {p.name for p in left[0].iterdir()} == {"member", "lines", "seeds", "runs", "spans"}
