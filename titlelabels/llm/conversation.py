"""Repair of conversation structure by the cheapest edits.

A sound conversation reads, by the initials of its roles, ``(s?(ua)+)?``: nothing, or pairs of
user and assistant, perhaps after one system row. Edits are Keep (0), Rerole to user or
assistant (2), Delete (3, required for blank and duplicate rows) and Insert of an empty user
or assistant row (2); a truncated row that stays adds 1. Of the cheapest edits those with the
ASCII-least initials are taken. An initial and the state before it give the state after it, so
initials name one repaired conversation.

The cost of the rest of a conversation, by state, comes from its end. Such vectors are kept at
every square root of its length only; walking forward, one block between two of them is
computed anew and gives the tight edits. Rows are dealt by range, so that a conversation of any
length is cut into runs of neighbouring tasks: a run's effect on cost vectors is a 4 by 4 table and its effect on
states is four numbers, and only these, of the first and last run of a task, meet in the driver.

Rows of a conversation go by turn (nulls first), rows of equal turn by role (nulls first), then by the
SHA-256 of the text. Null text is one space and so blank; a null role is one space, which no edit keeps;
a null conversation id is one conversation, written as one space in the number that chooses damage.
Equal rows are counted before they are shuffled. Other columns do not take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from titlelabels.llm.common import SLICE
from titlelabels.llm.spread import join_groups
from titlelabels.session import checkpoint_root, checkpointed, scratch, shared_folder

# Costs and how damage is chosen.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
DAMAGE = 20
FAR = 1 << 50

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STATES = range(4)
#: The state after the row that an inserted or re-roled row must be.
NEXT = (2, 2, 3, 2)
#: The state after a kept row, by its initial.
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
NO_KEEP = (None, None, None, None)
ROLE_OF = {2: "user", 3: "assistant"}

Vector = list[int]


def inserted(v: Vector) -> Vector:
    """Costs with rows inserted first, where that is cheaper."""
    a, b = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return [min(v[0], INSERT + a), min(v[1], INSERT + a), a, b]


#: Costs after the last row: nothing or whole pairs are sound.
CLOSED = inserted([0, FAR, FAR, 0])


class Run:
    """Equal rows in a row: initial of the role, whether it must go, whether it is truncated, further copies."""

    __slots__ = ("keep", "must", "more", "stay")

    def __init__(self, initial: str, must: bool, truncated: bool, copies: int):
        self.keep = KEEP.get(initial, NO_KEEP)
        self.must, self.stay, self.more = must, TRUNCATED if truncated else 0, copies - 1

    def before(self, after: Vector) -> Vector:
        """Costs before the run from those after it; copies after the first are duplicates."""
        extra = DELETE * self.more
        after = [x + extra for x in after] if extra else after
        if self.must:
            return inserted([x + DELETE for x in after])
        out = []
        for q in STATES:
            best = min(DELETE + after[q], REROLE + self.stay + after[NEXT[q]])
            to = self.keep[q]
            if to is not None:
                best = min(best, self.stay + after[to])
            out.append(best)
        return inserted(out)

    def edits(self, q: int, here: Vector, after: Vector) -> tuple[str, int]:
        """Tight edits with the least initials from state ``q``, inserts before the run included, and the state after."""
        extra = DELETE * self.more
        made = []
        while True:
            left = here[q] - extra
            if left == DELETE + after[q]:
                made.append("D")
                break
            if here[q] == INSERT + here[NEXT[q]]:
                made.append("I")
                q = NEXT[q]
                continue
            to = self.keep[q]
            if not self.must and to is not None and left == self.stay + after[to]:
                made.append("K")
                q = to
            else:
                made.append("R")
                q = NEXT[q]
            break
        return "".join(made) + "D" * self.more, q


def table_of(runs: list[Run]) -> list[Vector]:
    """Cost from each state before the runs to each state after them; inserts after the last run are not in it."""
    columns = []
    for to in STATES:
        v = [FAR] * 4
        v[to] = 0
        for run in reversed(runs):
            v = run.before(v)
        columns.append(v)
    return [[columns[to][q] for to in STATES] for q in STATES]


def through(table: list[Vector], after: Vector) -> Vector:
    return [min(c + x for c, x in zip(row, after, strict=True)) for row in table]


def walk(runs: list[Run], q: int, after: Vector, last: bool) -> tuple[str, int, int]:
    """Initials of the edits of ``runs`` from state ``q``, given the costs after them; the state at their end; truncated rows that stay.

    Cost vectors stay at every ``isqrt(n)``-th run; a block is computed again when the walk enters it.
    """
    n = len(runs)
    step = isqrt(n) + 1
    marks, v = {}, after
    for i in reversed(range(n)):
        v = runs[i].before(v)
        if i % step == 0:
            marks[i] = v
    made, stays = [], 0
    for start in range(0, n, step):
        stop = min(start + step, n)
        block = [after if stop == n else marks[stop]]
        for i in reversed(range(start, stop)):
            block.append(runs[i].before(block[-1]) if i > start else marks[start])
        block.reverse()
        for i in range(start, stop):
            text, q = runs[i].edits(q, block[i - start], block[i - start + 1])
            made.append(text)
            stays += runs[i].stay if "K" in text or "R" in text else 0
    while last and q not in (0, 3):  # closed by inserts only
        made.append("I")
        q = NEXT[q]
    return "".join(made), q, stays


def best(runs: list[Run]) -> tuple[int, str]:
    """Least cost and audit of a whole conversation."""
    v = CLOSED
    for run in reversed(runs):
        v = run.before(v)
    return v[0], walk(runs, 0, CLOSED, True)[0]


# Rows

#: The order of a conversation's rows; together these name equal rows.
ORDER = ("turn", "said_by", "said_as")


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _short(value: Column) -> Column:
    """The first 128 bits of SHA-256."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def conv_key() -> Column:
    """The conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def rows_of(conversations: DataFrame) -> DataFrame:
    """``conv``, the columns of ``ORDER``, ``role``, ``text`` and ``copies`` (1); nulls of role and text are one space."""
    return conversations.select(
        conv_key().alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("said_by"),
        _short(_spaced("text")).alias("said_as"),
        _spaced("role").alias("role"),
        _spaced("text").alias("text"),
        F.lit(1).alias("copies"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """:func:`rows_of` with the damage that a number of each row's id and turn chooses; ``copies`` is 2 where it repeats."""
    number = F.concat(F.when(F.col("conv") == "", " ").otherwise(F.substr("conv", F.lit(2))), F.lit(":"), _spaced("turn"))
    rows = rows_of(conversations).withColumn("kind", F.crc32(number) % DAMAGE).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv", *ORDER, role.alias("role"), text.alias("text"), copies.alias("copies"))


def facts_of(rows: DataFrame) -> DataFrame:
    """One row per equal rows, without texts: initial of the role, ``said`` (role and text), blank, open at its end, copies."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    facts = rows.select(
        "conv",
        *ORDER,
        F.struct(
            F.substring("role", 1, 1).alias("initial"),
            _short(said).alias("said"),
            (~F.col("text").rlike("[^\\x20\\x09-\\x0D]")).alias("blank"),
            (~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")).alias("open_end"),
        ).alias("f"),
        "copies",
    )
    facts = facts.groupBy("conv", *ORDER, "f").agg(F.sum("copies").cast("long").alias("copies"))
    return facts.select("conv", *ORDER, "f.*", "copies")


def faults(facts: DataFrame) -> DataFrame:
    """Facts with ``must`` (1 blank, 2 duplicate, else 0) and ``truncated``."""
    order = F.struct(*ORDER)
    firsts = checkpointed(facts.groupBy("conv", "said").agg(F.min(order).alias("first"), F.count("*").alias("n")))
    known = join_groups(facts, firsts, ["conv", "said"], "n", ORDER)
    must = F.when(F.col("blank"), 1).when(~order.eqNullSafe(F.col("first")), 2).otherwise(0).cast("byte")
    return known.select("conv", *ORDER, "initial", must.alias("must"), (F.col("open_end") & ~F.col("blank")).alias("truncated"), "copies")


# Runs of neighbouring tasks

_INPUT = ["conv", "initial", "must", "truncated", "copies"]
_EDGE = "part int, conv string, first string, last string, cells array<long>, exits array<int>"
_PIECE = "part int, conv string, audit string, stays long, blank long, duplicate long, truncated long, illegal long"


def _convs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, list[tuple]]]:
    """Rows of each conversation of a sorted task: the task's number, the conversation, its rows here."""
    conv, rows, part = None, [], None
    for batch in batches:
        part = batch.column(batch.num_columns - 1)[0].as_py() if part is None and batch.num_rows else part
        columns = [batch.column(k).to_pylist() for k in range(len(_INPUT))]
        for c, *row in zip(*columns, strict=True):
            if c != conv:
                if rows:
                    yield part, conv, rows
                conv, rows = c, []
            rows.append(tuple(row))
    if rows:
        yield part, conv, rows


def _runs(rows: list[tuple]) -> list[Run]:
    return [Run(initial, bool(must), truncated, copies) for initial, must, truncated, copies in rows]


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _map_convs(ordered: DataFrame, outputs: str, build) -> DataFrame:
    return _streamed(ordered.select(*_INPUT, F.spark_partition_id().alias("part")), outputs, lambda batches: build(_convs(batches)))


def _edges(convs):
    """The first and the last conversation of a task: their tables and initials."""
    first = last = None
    for here in convs:
        first, last = first or here, here
    for part, conv, rows in [x for x in ([first] if first is last else [first, last]) if x]:
        cells = [x for line in table_of(_runs(rows)) for x in line]
        yield part, conv, rows[0][0], rows[-1][0], cells, []


def _pieces(known: dict[tuple[int, str], tuple[int, Vector, bool, str]]):
    """Audits and counts of every run. ``known`` has, of runs that go on in other tasks, the state before, the costs after, whether it is the last, and the initial before."""

    def build(convs):
        for part, conv, rows in convs:
            q, after, last, previous = known.get((part, conv), (0, CLOSED, True, None))
            audit, _, stays = walk(_runs(rows), q, after, last)
            blank = duplicate = truncated = illegal = 0
            for initial, must, open_end, copies in rows:
                blank += copies if must == 1 else 0
                duplicate += copies if must == 2 else copies - 1 if must == 0 else 0
                truncated += 1 if must == 0 and open_end else 0
                illegal += copies - 1 + (previous is not None and previous + initial not in ("su", "ua", "au"))
                previous = initial
            yield part, conv, audit, stays, blank, duplicate, truncated, illegal

    return build


def _exits(after: dict[tuple[int, str], Vector]):
    """The state after a run for each state before it, of runs that go on in the next task."""

    def build(convs):
        for part, conv, rows in convs:
            if (part, conv) in after:
                runs = _runs(rows)
                yield part, conv, "", "", [], [walk(runs, q, after[part, conv], False)[1] for q in STATES]

    return build


def _borders(ordered: DataFrame) -> dict[tuple[int, str], tuple[int, Vector, bool, str | None]]:
    """What runs must know of the tasks before and after them; at most two rows a task reach the driver."""
    edges = {(r.part, r.conv): r for r in _map_convs(ordered, _EDGE, _edges).collect()}
    chains: dict[str, list[int]] = {}
    for part, conv in sorted(edges):
        chains.setdefault(conv, []).append(part)
    chains = {conv: parts for conv, parts in chains.items() if len(parts) > 1}
    after: dict[tuple[int, str], Vector] = {}
    for conv, parts in chains.items():
        v = CLOSED
        for part in reversed(parts):
            after[part, conv] = v
            cells = edges[part, conv].cells
            v = through([cells[k : k + 4] for k in range(0, 16, 4)], v)
    if not after:
        return {}
    exits = {(r.part, r.conv): r.exits for r in _map_convs(ordered, _EDGE, _exits(after)).collect()}
    known = {}
    for conv, parts in chains.items():
        q, previous = 0, None
        for part in parts:
            known[part, conv] = (q, after[part, conv], part == parts[-1], previous)
            q, previous = exits[part, conv][q], edges[part, conv].last
    return known


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired(rows: DataFrame) -> DataFrame:
    """Of every conversation in ``rows`` (from :func:`rows_of` or :func:`damaged`): faults, cost and audit.

    Columns ``conv``, those of ``COUNTS`` and ``audit``, written to the shared folder; conversations without rows are not in it.
    """
    spark = rows.sparkSession
    path = shared_folder(spark)
    checkpoint_root(spark)
    with scratch(spark):
        facts = checkpointed(facts_of(rows))
        # Rows of a conversation are read in order, again and again by the same tasks: kept as they are dealt.
        ordered = faults(facts).repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER).select(*_INPUT).checkpoint()
        pieces = _map_convs(ordered, _PIECE, _pieces(_borders(ordered)))
        whole = pieces.groupBy("conv").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "").alias("audit"),
            *[F.sum(c).alias(c) for c in ("stays", "blank", "duplicate", "truncated", "illegal")],
        )
        turns = facts.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
        turns = turns.agg(F.max("turn").alias("most"), F.min("turn").alias("least"), F.count("turn").alias("turns"))
        gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
        each = {"R": REROLE, "D": DELETE, "I": INSERT}
        cost = F.col("stays") * TRUNCATED
        for letter, price in each.items():
            cost = cost + price * (F.length("audit") - F.length(F.replace("audit", F.lit(letter), F.lit(""))))
        out = whole.join(turns, "conv").withColumns({"gaps": gaps, "cost": cost})
        out.select("conv", *[F.col(c).cast("long").alias(c) for c in COUNTS], "audit").write.parquet(path)
    return spark.read.parquet(path)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str | None, str | None]]:
    """``conv, edit, role, text`` of what stays or is inserted, in order; a conversation starts with no edit."""
    conv = audit = None
    at = state = 0

    def insert_until() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = NEXT[state]
            at += 1
            yield conv, "I", ROLE_OF[state], ""

    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            columns = [c.to_pylist() for c in whole.slice(start, SLICE).columns]
            for key, edits, role, text, copies in zip(*columns, strict=True):
                if edits is not None:
                    if conv is not None:
                        yield from insert_until()
                    conv, audit, at, state = key, edits, 0, 0
                    yield conv, None, None, None
                    continue
                for _ in range(copies):
                    yield from insert_until()
                    edit = audit[at]
                    at += 1
                    if edit == "K":
                        state = KEEP[role[0]][state]
                        yield conv, "K", role, text
                    elif edit == "R":
                        state = NEXT[state]
                        yield conv, "R", ROLE_OF[state], text
    if conv is not None:
        yield from insert_until()


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of each conversation in one task, in order, its audit before them."""
    none = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    heads = found.select(*[F.col("conv") if c == "conv" else F.lit(None).cast(t).alias(c) for c, t in none.items()], "audit")
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(heads)
    dealt = both.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), *ORDER)
    return dealt.select("conv", "audit", "role", "text", "copies")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv, place, edit`` (K, R or I), ``role, text``. ``found`` is what :func:`repaired` gives."""

    def places(batches):
        place = 0
        for conv, edit, role, text in _edited(batches):
            place = 0 if edit is None else place + 1
            if edit is not None:
                yield conv, place, edit, role, text

    return _streamed(_with_audits(rows, found), "conv string, place long, edit string, role string, text string", places)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv`` and the SHA-256 of each repaired conversation, ``role:text`` by line."""

    def hashed(batches):
        conv = digest = None
        any_row = False
        for key, edit, role, text in _edited(batches):
            if edit is None:
                if conv is not None:
                    yield conv, digest.hexdigest()
                conv, digest, any_row = key, hashlib.sha256(), False
            else:
                digest.update(f"{chr(10) if any_row else ''}{role}:{text}".encode())
                any_row = True
        if conv is not None:
            yield conv, digest.hexdigest()

    return _streamed(_with_audits(rows, found), "conv string, repaired_sha256 string", hashed)


def _streamed(df: DataFrame, outputs: str, build) -> DataFrame:
    schema = StructType.fromDDL(outputs)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for row in build(batches):
            waiting.append(row)
            if len(waiting) == SLICE:
                yield _emit(waiting, arrow)
                waiting = []
        yield _emit(waiting, arrow)

    return df.mapInArrow(run, schema)


def audited(conversations: DataFrame) -> DataFrame:
    """Every conversation, damaged and repaired: counts, cost, audit and the digest of what it reads then."""
    rows = damaged(conversations)
    found = repaired(rows)
    both = found.join(digests(rows, found), "conv")
    ids = conversations.select("conv_id", conv_key().alias("conv")).distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS]
    digest = F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")
    return ids.join(both, "conv", "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)
