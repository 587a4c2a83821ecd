"""Sets published as a whole, layouts told from the written files, and what a run reads."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from querybook import fixtures as fx
from titlelabels import Labeller, classify_notes, label_notes, run
from titlelabels.operators.classify import answers
from titlelabels.plans import labelling
from titlelabels.plans.labelling import clustered_notes, layout_weights
from titlelabels.sources import published
from titlelabels.sources.sinks import cluster_by_labels, file_ranges, label_mask, layout_key, layout_report, range_bounds, write_notes, z_value

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("published") / "in")
    fx.notes(spark, SF).write.parquet(path)
    return path


def test_a_run_publishes_notes_manifest_and_anchors(spark, source, tmp_path):
    out = str(tmp_path / "out")
    run(spark, source, path=out, files=3)
    notes = spark.read.parquet(out)
    assert notes.count() == label_notes(fx.notes(spark, SF)).count() and "value" not in notes.columns
    manifest = published.read_manifest(spark, path=out).first()
    assert manifest.n_notes == notes.count() and manifest.model == "HashedTokens" and manifest.n_rules == 60
    anchors = {r.dim: json.loads(r.value) for r in published.read_anchors(spark, path=out).collect()}
    assert len(anchors["role"]) == 5 and len(anchors["type"]) == 12
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]


@pytest.mark.parametrize("step", ["write_notes", "run_manifest", "write_anchors"])
def test_a_run_that_breaks_leaves_the_old_set(spark, source, tmp_path, monkeypatch, step):
    out = str(tmp_path / "out")
    run(spark, source, path=out, files=2, model="old")
    before = sorted(map(str, spark.read.parquet(out).select("note_id", "clf_source").collect()))

    def broken(*args, **kwargs):
        raise RuntimeError("broken here")

    monkeypatch.setattr(labelling, step, broken)
    with pytest.raises(RuntimeError, match="broken here"):
        run(spark, source, path=out, files=2, model="new", statuses=("COMPLETED",))
    assert sorted(map(str, spark.read.parquet(out).select("note_id", "clf_source").collect())) == before
    assert published.read_manifest(spark, path=out).first().model == "old"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]


def test_a_run_that_dies_between_the_renames_is_put_right(spark, source, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    run(spark, source, path=out, files=1, model="old")
    rename = published._Files.rename

    def fails_at_second(self, old, new):
        if new == out:
            raise OSError("gone")
        rename(self, old, new)

    monkeypatch.setattr(published._Files, "rename", fails_at_second)
    with pytest.raises(OSError, match="gone"):  # neither the new set nor the old one can be put in place
        run(spark, source, path=out, files=1, model="new")
    monkeypatch.undo()
    assert not Path(out).exists()
    assert published.read_manifest(spark, path=out).first().model == "old"
    run(spark, source, path=out, files=1, model="new")
    assert published.read_manifest(spark, path=out).first().model == "new"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]


def test_tables_change_place_and_schema_with_their_manifest(spark, source, monkeypatch):
    name = "titlelabels_published"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    run(spark, source, table=name, files=2, model="one")
    first = published._location(spark, name)
    run(spark, source, table=name, files=2, model="two", statuses=("COMPLETED",))
    assert published.read_manifest(spark, table=name).first().model == "two"
    assert spark.table(name).count() == published.read_manifest(spark, table=name).first().n_notes > 0
    assert not Path(first.removeprefix("file:")).exists()
    monkeypatch.setattr(labelling, "write_anchors", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, source, table=name, files=2, model="three")
    monkeypatch.undo()
    assert published.read_manifest(spark, table=name).first().model == "two"
    run(spark, source, table=name, files=2, model="four", columns=("note_id", "note_title"))
    assert "sta3n" not in spark.table(name).columns
    assert published.read_manifest(spark, table=name).first().model == "four"
    spark.sql(f"DROP TABLE {name}")


def counting(calls):
    def title(text):
        calls.add(1)
        return text

    return F.udf(title, "string")


def test_notes_are_read_twice_and_labelled_once(spark, tmp_path, monkeypatch):
    calls = spark.sparkContext.accumulator(0)
    notes = fx.notes(spark, SF).withColumn("note_title", counting(calls)("note_title"))
    monkeypatch.setattr(labelling, "scan_notes", lambda spark, source: notes)
    eligible = label_notes(fx.notes(spark, SF)).count()
    run(spark, "unused", path=str(tmp_path / "out"), files=4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == eligible
    # Once for the sketch, once for the labelled rows; titles without an answer are read once more for the ranges.
    assert calls.value <= 3 * eligible


def test_ranges_from_weights_need_no_sample_of_the_rows(spark):
    notes = fx.composed_notes(spark, SF)
    known = answers(notes, "note_title", Labeller())
    weights = layout_weights(notes, "note_title", Labeller(), known)
    assert sum(w for _, w in weights) == pytest.approx(notes.count())
    laid = cluster_by_labels(classify_notes(notes, known=known), files=4, weights=weights)
    assert "rangepartitioning" not in plan_of(laid)
    assert "rangepartitioning" in plan_of(cluster_by_labels(classify_notes(notes, known=known), files=4))


@pytest.mark.parametrize("z_order", [False, True])
def test_files_tell_whether_rows_were_clustered(spark, tmp_path, z_order):
    labelled = classify_notes(fx.composed_notes(spark, SF).repartition(5))
    reports = {}
    for name, how in {"by_sample": {}, "not": {"cluster": False}}.items():
        path = str(tmp_path / name)
        write_notes(labelled, path=path, files=6, z_order=z_order, **how)
        reports[name] = layout_report(spark, path, z_order).first()
    assert reports["by_sample"].n_overlaps == 0 and reports["by_sample"].n_notes == reports["not"].n_notes == 1500
    assert reports["not"].n_overlaps > 0


@pytest.mark.parametrize("z_order", [False, True])
def test_rows_are_sorted_without_the_results_of_known_titles(spark, z_order):
    notes = fx.numbered_notes(spark, SF).withColumn("clf_source", F.lit("theirs"))
    labeller = Labeller()
    known = answers(notes, "note_title", labeller)
    weights = layout_weights(notes, "note_title", labeller, known, z_order)
    got = clustered_notes(notes, "note_title", labeller, known, 4, z_order, weights)
    want = cluster_by_labels(classify_notes(notes, known=known), 4, z_order, weights)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    keys = got.select(F.spark_partition_id().alias("p"), layout_key(z_order).alias("key")).collect()
    assert len({r.p for r in keys}) > 1 and keys == sorted(keys)
    # The sort holds notes and places; results only of titles that have no place.
    held = got._jdf.queryExecution().optimizedPlan().toString().split("Sort [__key")[1].split("\n")[1]
    assert "__carried" in held and not any(c in held for c in ("note_roles", "classification", "rule_hits"))


def test_ranges_of_files_sort_no_rows(spark, tmp_path):
    path = str(tmp_path / "notes")
    write_notes(classify_notes(fx.composed_notes(spark, SF)), path=path, files=3)
    ranges = file_ranges(spark, path)
    below_counts = ranges._jdf.queryExecution().sparkPlan().toString().split("SortAggregate")[-1]
    assert below_counts.count("HashAggregate") == 2 and sum(r.n_notes for r in ranges.collect()) == 1500


def test_bounds_give_equal_shares_and_heavy_keys_several_files():
    assert range_bounds([("a", 1), ("b", 1), ("c", 1), ("d", 1)], 4) == ["b", "c", "d"]
    assert range_bounds([("a", 1), ("b", 6), ("c", 1)], 4) == ["b", "b", "b"]
    assert range_bounds([], 4) == [] and range_bounds([("a", 5)], 1) == []


def test_z_values_by_hand(spark):
    rows = [
        ([], [], "EMPTY"),
        (["CLINICAL"], [], "EMPTY"),
        ([], ["ADMISSION"], "RULES"),
        (["UNKNOWN"], ["UNKNOWN"], "EMPTY"),
        (["ADMINISTRATIVE"], ["ADMINISTRATIVE"], "EMBEDDING"),
    ]
    df = spark.createDataFrame(rows, "r array<string>, t array<string>, s string")
    got = [tuple(r) for r in df.select(label_mask(F.col("r"), "role"), label_mask(F.col("t"), "type"), z_value(F.col("r"), F.col("t"), F.col("s"))).collect()]
    # Masks: bit n for the n-th label, the bit above all for a label that is not in the taxonomy.
    assert [g[:2] for g in got] == [(0, 0), (1, 0), (0, 1), (32, 4096), (16, 2048)]

    def interleaved(role, kind, source):
        words = [format(role, "06b"), format(kind, "013b"), format(source, "03b")]
        return int("".join(w[d] for d in range(13) for w in words if d < len(w)), 2)

    assert [g[2] for g in got] == [interleaved(r, t, s) for (r, t, _), s in zip(got, [1, 1, 2, 1, 4], strict=True)]
    assert got[3][2] > got[4][2] > got[1][2]
