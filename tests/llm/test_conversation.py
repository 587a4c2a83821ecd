"""Conversation repair against a search over all edits, and its parts in many tasks."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from titlelabels.llm import conversation as co
from titlelabels.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, conv string, copies int, audit string"
SOUND = re.compile(r"(s?(ua)+)?")


def search(rows):
    """Cheapest edits with the least initials: uniform-cost search over (row, initials so far, state); no vectors from the end."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        for role in ("user", "assistant"):
            if to := step.get((state, role[0])):
                heapq.heappush(heap, (cost + 2, audit + "I", i, to, (*out, (role, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
        if fault in ("blank", "duplicate"):
            continue
        more = 1 if fault == "truncated" else 0
        if to := step.get((state, role[:1])):
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, to, (*out, (role, text))))
        for new in ("user", "assistant"):
            if to := step.get((state, new[0])):
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, to, (*out, (new, text))))


def expected(conversations):
    convs = defaultdict(list)
    for conv, turn, role, text in conversations:
        here = convs[conv]
        number = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(number.encode()) % 20
        key = (turn is not None, turn, role is not None, role, hashlib.sha256((" " if text is None else text).encode()).digest())
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(key, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: tuple((x is not None, x) if x is not None else (False,) for x in r[0]))
        seen, faulty, counts = set(), [], defaultdict(int)
        for _, _, role, text in rows:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            faulty.append((role, text, fault))
        turns = {r[1] for r in rows if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[2][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, kept = search(faulty)
        assert SOUND.fullmatch("".join(r[0] for r, _ in kept))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return out


def cases():
    r = random.Random(12)
    texts = [None, "", " \n", "Yes.", "No?", "so it goes", "Hm! ", "é. \t", "done.\x0b"]
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(r.randrange(0, 12)):
            place = r.choice([turn, turn, turn, turn * 2, None])
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"])
            text = r.choice(texts) if r.random() < 0.5 else f"{r.choice('abc')} {r.randrange(9)}" + r.choice(["", ".", "?"])
            rows += [(conv, place, role, text)] * (3 if r.random() < 0.05 else 1)
    return rows


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def results(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_equal_to_a_search_over_all_edits(spark):
    rows = cases()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(7)
    assert results(co.audited(df)) == sorted(expected(rows), key=str)


def test_one_conversation_over_all_tasks(spark):
    r = random.Random(3)
    rows = [(7, t, r.choice(["user", "assistant", "system"]), r.choice(["a.", "b", f"{t}.", f"{t}"])) for t in range(700)]
    rows += [(None, None, "user", "the same.")] * 500 + [(8, 0, "user", "one."), (8, 1, "assistant", "two.")]
    df = spark.createDataFrame([(*x, "x", 1, "y") for x in rows], SCHEMA).repartition(5)
    assert results(co.audited(df)) == sorted(expected(rows), key=str)


def test_runs_in_pieces_give_the_whole():
    r = random.Random(4)
    for _ in range(200):
        runs = [co.Run(r.choice("suax"), r.random() < 0.2, r.random() < 0.3, r.choice([1, 1, 1, 3])) for _ in range(r.randrange(1, 30))]
        cost, audit = co.best(runs)
        cut = r.randrange(len(runs))
        after = co.CLOSED
        for run in reversed(runs[cut:]):
            after = run.before(after)
        assert co.through(co.table_of(runs[cut:]), co.CLOSED) == after
        head, q, _ = co.walk(runs[:cut], 0, after, False)
        assert head + co.walk(runs[cut:], q, co.CLOSED, True)[0] == audit
        table = co.table_of(runs)
        assert co.through(table, co.CLOSED)[0] == cost


def test_rows_of_the_repaired_conversation(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "user", "What now?"), (2, 0, "user", ""), (2, 1, "tool", "x.")]
    df = co.rows_of(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA))
    found = co.repaired(df)
    got = defaultdict(list)
    for r in sorted(co.repaired_rows(df, found).collect(), key=lambda r: (r.conv, r.place)):
        got[r.conv].append((r.edit, r.role, r.text))
    assert got == {"=1": [("I", "user", ""), ("K", "assistant", "Hello."), ("K", "user", "What now?"), ("I", "assistant", "")]}
    assert {r.conv: r.audit for r in found.collect()} == {"=1": "IKDKI", "=2": "DD"}


def test_empty_table(spark):
    assert co.audited(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(QUERIES["op12_conversation"](spark, folder)) == sorted(expected(rows), key=str)


def test_very_long_conversation_needs_few_vectors():
    runs = [co.Run("ua"[k % 2], k % 97 == 0, k % 5 == 0, 1) for k in range(20_000)]
    cost, audit = co.best(runs)
    assert len(audit.replace("I", "")) == 20_000 and cost > 0


@pytest.mark.parametrize("copies", [1, 2, 5])
def test_copies_after_the_first_are_duplicates(copies):
    cost, audit = co.best([co.Run("u", False, False, copies), co.Run("a", False, False, 1)])
    assert (cost, audit) == (3 * (copies - 1), "K" + "D" * (copies - 1) + "K")


def test_null_ids_and_clashing_columns_do_not_mix(spark):
    df = spark.createDataFrame([(None, 0, "user", "a.", "k", 1, "z"), (None, None, None, None, "k", 1, "z")], SCHEMA)
    out = co.audited(df).withColumn("n", F.lit(1)).collect()
    assert len(out) == 1 and out[0].conv_id is None
