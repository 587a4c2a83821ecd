import math

import pytest
from pyspark.sql import functions as F

from querybook import fixtures as fx
from tests import fake_model
from tests.properties import assert_result
from titlelabels import (
    OUTPUT_SCHEMA,
    HashedTokens,
    Labeller,
    Limits,
    ModelVectors,
    Settings,
    VectorColumn,
    VectorTable,
    classify_notes,
    score_titles,
)
from titlelabels.anchors import anchor_rows, anchor_table
from titlelabels.operators.centroids import label_centroids
from titlelabels.operators.hot import repeated_titles, tracked_items
from titlelabels.taxonomy import DIMS, LABELS

EXTRA = ["SPEECH AND SWALLOW CARE", "nursing Note", "ORDER", "hospital note", "A" * 2000 + " NOTE", "A" * 2000 + " MD"]
LONG = EXTRA[-2]
TITLES = [*fx.TITLES, *EXTRA]
SMALL = Limits(titles=3, bytes=20_000)


@pytest.fixture(scope="module")
def notes(spark):
    """Some titles are rare, some hold a large part of the rows."""
    rows = [(i, TITLES[i % len(TITLES)]) for i in range(280)]
    rows += [(1000 + i, "TELEHEALTH VISIT") for i in range(150)] + [(2000 + i, (None, LONG)[i % 2]) for i in range(300)]
    return spark.createDataFrame(rows, "id bigint, note_title string").repartition(5)


def vector(text):
    """Letter counts of unit length, as the stand-in model gives them."""
    m = fake_model.load("x")([text])[0].tolist()
    length = math.sqrt(sum(x * x for x in m))
    return [x / length for x in m] if length else m


def hashed(text):
    import hashlib
    import re

    m = [0.0] * 256
    for token in re.split(r"[\W_]+", text.upper()):
        if token:
            m[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 256] += 1
    length = math.sqrt(sum(x * x for x in m))
    return [x / length for x in m] if length else m


def brute_scores(encode, title):
    v, out = encode(title), {d: {} for d in DIMS}
    groups = {}
    for dim, label, _, phrase in anchor_rows():
        groups.setdefault((dim, label), []).append(encode(phrase))
    for (dim, label), vs in groups.items():
        mean = [sum(x) / len(vs) for x in zip(*vs, strict=True)]
        length = math.sqrt(sum(x * x for x in mean))
        out[dim][label] = sum(a * b / length for a, b in zip(v, mean, strict=True))
    return out


def check(rows, encode, settings=Settings()):
    known = {}
    for r in rows:
        if r.note_title not in known:
            blank = r.note_title is None or not r.note_title.strip()
            known[r.note_title] = None if blank else brute_scores(encode, r.note_title)
        assert_result(r.note_title, r.classification.asDict(), known[r.note_title], settings)


def labellers(spark):
    texts = spark.createDataFrame(
        [(t, vector(t)) for t in set(TITLES) if t is not None], "title string, v array<double>"
    )
    anchors = spark.createDataFrame(
        [(d, x, vector(p)) for d, x, _, p in anchor_rows()], "dim string, label string, v array<double>"
    )
    high = Settings(emb_conf_thresh=0.8)
    return {
        "hashed": (Labeller(), hashed, Settings()),
        "table": (Labeller(encoder=VectorTable(texts, anchors), settings=high), vector, high),
        "model": (Labeller(encoder=ModelVectors(fake_model.load, "p"), settings=high), vector, high),
    }


@pytest.mark.parametrize("kind", ["hashed", "table", "model"])
@pytest.mark.parametrize("limits", [Limits(), SMALL], ids=["all-broadcast", "hot-and-cold"])
def test_every_result_has_its_properties(spark, notes, kind, limits):
    from dataclasses import replace

    labeller, encode, settings = labellers(spark)[kind]
    rows = classify_notes(notes, labeller=replace(labeller, limits=limits)).collect()
    assert sorted(r.id for r in rows) == sorted(r.id for r in notes.collect())
    check(rows, encode, settings)


def test_columns_schema_and_names_of_the_caller(spark):
    df = spark.createDataFrame(
        [("SOAP", "old", 1, "x", 2)], "`the title` string, rule_hits string, rules int, text string, __library int"
    )
    out = classify_notes(df, "the title")
    assert out.schema["classification"].dataType.simpleString() == OUTPUT_SCHEMA.simpleString()
    assert out.columns == [
        "the title", "rule_hits", "rules", "text", "__library",
        "classification", "note_roles", "note_types", "role_conf", "type_conf", "clf_source",
    ]
    row = out.first()
    assert row.rule_hits == ["type:soap"] and row.rules == 1 and row.text == "x" and row["__library"] == 2
    assert row.note_types == row.classification.note_types


def test_score_titles_shape(spark):
    batch = spark.createDataFrame([("SOAP",), ("SOAP",), (None,), ("H&P MD",)], "title string")
    out = score_titles(batch)
    assert out.columns == ["title", *OUTPUT_SCHEMA.fieldNames()]
    rows = out.collect()
    assert len(rows) == 4
    for r in rows:
        assert (r.classification_source == "EMPTY") == (r.title is None)
        assert (not r.embedding_role_scores) == (r.classification_source in ("RULES", "EMPTY"))
        assert set(r.roles) <= {*LABELS["role"], "UNKNOWN"} and 0 <= r.role_confidence <= 1


def test_result_does_not_depend_on_partitioning(spark, notes):
    one = {(r.id, str(r.classification)) for r in classify_notes(notes.coalesce(1)).collect()}
    many = {(r.id, str(r.classification)) for r in classify_notes(notes.repartition(13, "id")).collect()}
    assert one == many


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_titles_are_bounded_in_number(spark, notes):
    found = repeated_titles(notes, "note_title", 3)
    assert found.rows == 730 and found.count == 3
    titles = {r.title: r.n for r in found.titles.collect()}
    assert titles["TELEHEALTH VISIT"] >= 150 and titles[LONG] >= 150 and len(titles) == 3
    assert Limits(titles=10, bytes=1).most(4_000) == 1 and Limits(titles=10).most(4_000) == 10
    assert tracked_items(50_000) == 1 << 17 and tracked_items(1) == 64


def test_distinct_titles_are_not_shuffled(spark):
    rows = spark.range(0, 60_000, 1, 8).selectExpr("id", "concat('NURSING NOTE ', id) AS note_title")
    out = classify_notes(rows, labeller=Labeller(limits=Limits(titles=500)))
    assert "Exchange" not in plan_of(out).split("Subquery")[0] and "Join" not in plan_of(out)
    assert out.filter(F.array_contains("note_roles", "NURSING")).count() == 60_000


def test_one_title_over_a_third_of_the_rows_is_found_among_distinct_ones(spark):
    rows = spark.range(0, 90_000, 1, 8).selectExpr("id", "if(id % 3 = 0, 'SOAP', concat('NOTE ', id)) AS note_title")
    found = repeated_titles(rows, "note_title", 500)
    assert {r.title: r.n for r in found.titles.collect()}["SOAP"] > 29_000 and found.count <= 500


def test_empty_table(spark):
    assert classify_notes(spark.createDataFrame([], "note_title string")).count() == 0


def test_centroids_are_unit_vectors_and_zero_stays(spark):
    zero = spark.createDataFrame([("role", "CLINICAL", [0.0, 0.0])], "dim string, label string, v array<double>")
    assert label_centroids(zero).first().c == [0.0, 0.0]
    rows = label_centroids(HashedTokens().anchor_vectors(anchor_table(spark))).collect()
    assert len(rows) == 17
    for r in rows:
        assert math.sqrt(sum(x * x for x in r.c)) == pytest.approx(1.0)


def test_title_without_known_vector_falls_back_to_rules(spark):
    anchors = spark.createDataFrame([("role", "CLINICAL", [1.0])], "dim string, label string, v array<double>")
    none = spark.createDataFrame([], "title string, v array<double>")
    df = spark.createDataFrame([("RISK ASSESSMENT",)], "note_title string")
    with pytest.raises(Exception, match="no vector for title"):
        classify_notes(df, labeller=Labeller(encoder=VectorTable(none, anchors))).collect()
    rules = Labeller(encoder=VectorTable(none, anchors, missing="rules"))
    c = classify_notes(df, labeller=rules).first().classification
    assert (c.note_types, c.note_type_confidence, c.classification_source) == (["ASSESSMENT"], 0.0, "EMBEDDING")


def test_duplicate_vectors_do_not_multiply_rows(spark):
    anchors = spark.createDataFrame([("role", "CLINICAL", [1.0])], "dim string, label string, v array<double>")
    twice = spark.createDataFrame([("NOTE", [1.0]), ("NOTE", [0.5])], "title string, v array<double>")
    df = spark.createDataFrame([("NOTE",), ("NOTE",)], "note_title string")
    assert classify_notes(df, labeller=Labeller(encoder=VectorTable(twice, anchors))).count() == 2


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    anchors = spark.createDataFrame([("role", "CLINICAL", [1.0] * 26)], "dim string, label string, c array<double>")
    rows = spark.range(0, 1600, 1, 16).selectExpr("concat('VISIT ', id) AS note_title")
    labeller = Labeller(encoder=ModelVectors(fake_model.counted, str(tmp_path)), centroids=anchors)
    tasks = rows.select(F.spark_partition_id().alias("p"), "note_title").repartition(16, "note_title")
    assert labeller.score(tasks, "note_title", "c").agg(F.count("c.roles")).first()[0] == 1600
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert 1 <= len(loads) == len(set(loads)) <= 8  # one file a load, named by its process; 16 tasks on 8 cores
    before = len(loads)
    labeller.score(tasks, "note_title", "c").agg(F.count("c.roles")).first()
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) and len(loads) <= max(before, 8) + 8


def unstable(calls):
    """A title that is another one whenever it is read."""
    import random

    def title(i):
        calls.add(1)
        return random.choice(["VISIT ", "HOSPITAL STAY ", "NURSING CALL "]) + str(random.randrange(10**9)) if i % 4 else "SOAP"

    return F.udf(title, "string").asNondeterministic()


@pytest.mark.parametrize("kind", ["table", "model", "hashed"])
def test_answers_belong_to_the_rows_that_asked(spark, kind):
    labeller = labellers(spark)[kind][0]
    if kind == "table":
        anchors = spark.createDataFrame([("role", "CLINICAL", [1.0])], "dim string, label string, v array<double>")
        none = spark.createDataFrame([], "title string, v array<double>")
        labeller = Labeller(encoder=VectorTable(none, anchors, missing="rules"))
    calls = spark.sparkContext.accumulator(0)
    rows = spark.range(0, 200, 1, 4).withColumn("note_title", unstable(calls)("id"))
    out = classify_notes(rows, labeller=labeller).select("id", "classification").collect()
    assert sorted(r.id for r in out) == list(range(200))
    assert all(r.classification is not None and r.classification.classification_source for r in out)
    assert calls.value <= 400  # read twice at most


def test_half_of_the_last_digit_goes_to_even(spark):
    anchors = spark.createDataFrame([("role", "CLINICAL", [1.0, 0.0])], "dim string, label string, v array<double>")
    # cosine 0.03125 and 0.09375 exactly: five digits, the last a five
    rows = [(x, [x, math.sqrt(1 - x * x)]) for x in (0.03125, 0.09375)]
    df = spark.createDataFrame([("VISIT", v) for _, v in rows], "note_title string, v array<double>")
    settings = Settings(emb_conf_thresh=0.0, digits=4)
    got = classify_notes(df, labeller=Labeller(encoder=VectorColumn("v", anchors), settings=settings)).collect()
    assert sorted(round(r.classification.embedding_role_scores["CLINICAL"], 6) for r in got) == [0.0312, 0.0938]


def test_ties_keep_taxonomy_order(spark):
    same = [("type", x, [1.0]) for x in reversed(LABELS["type"])]
    anchors = spark.createDataFrame(same, "dim string, label string, v array<double>")
    texts = spark.createDataFrame([("NOTE", [1.0])], "title string, v array<double>")
    df = spark.createDataFrame([("NOTE",)], "note_title string")
    c = classify_notes(df, labeller=Labeller(encoder=VectorTable(texts, anchors))).first().classification
    assert c.note_types == list(LABELS["type"][:3]) and c.roles == [] and c.role_confidence == 0.0


def test_flat_columns_filter_like_any_column(spark, notes):
    out = classify_notes(notes)
    direct = [r for r in out.collect() if r.clf_source == "RULES" and "NURSING" in r.note_roles]
    filtered = out.filter((F.col("clf_source") == "RULES") & F.array_contains("note_roles", "NURSING"))
    assert filtered.count() == len(direct) > 0
