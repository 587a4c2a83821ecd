import json
import re
from pathlib import Path

from pyspark.sql import functions as F

from querybook import fixtures as fx
from titlelabels import Labeller, Limits, classify_notes, label_notes, run
from titlelabels.anchors import anchor_rows, anchor_table
from titlelabels.operators.rules import with_rules
from titlelabels.plans import reports
from titlelabels.session import checkpoint_root, shared_folder
from titlelabels.sources.notes import eligible_notes, scan_notes
from titlelabels.sources.sinks import cluster_by_labels, write_anchors, write_notes
from titlelabels.streaming.notes import label_batches, with_rule_struct

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rule_stage_is_a_projection_without_python(spark):
    plan = plan_of(with_rules(fx.notes(spark, SF), "note_title"))
    assert "Python" not in plan and "Exchange" not in plan


def test_rows_are_not_shuffled_and_nothing_is_a_cross_join(spark):
    for limits in (Limits(), Limits(titles=2)):
        plan = plan_of(classify_notes(fx.notes(spark, SF), labeller=Labeller(limits=limits)))
        joins = re.findall(r"(\w*Join)", plan)
        assert set(joins) == {"BroadcastHashJoin"}, joins
        main = plan.split("Subquery")[0]
        assert "hashpartitioning" not in main and "Python" not in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "notes")
    fx.notes(spark, SF).write.parquet(path)
    notes = scan_notes(spark, path)
    plan = plan_of(label_notes(notes))
    assert "In(status, [AMENDED,COMPLETED,UNCOSIGNED])" in plan and "EqualTo(patient_class,INPA" in plan
    schema = re.search(r"ReadSchema: (\S+)", plan_of(label_notes(notes).select("clf_source"))).group(1)
    assert "author_name" not in schema and "sta3n" not in schema


def test_eligible_drops_nulls(spark):
    df = spark.createDataFrame(
        [(1, "COMPLETED", "INPATIENT"), (2, None, "INPATIENT"), (3, "COMPLETED", None), (4, "UNSIGNED", "INPATIENT")],
        "note_id int, status string, patient_class string",
    )
    assert [r.note_id for r in eligible_notes(df, ["note_id"]).collect()] == [1]


def test_run_replaces_rows_and_schema(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    fx.notes(spark, SF).write.parquet(source)
    spark.range(3).write.parquet(out)
    run(spark, source, path=out)
    back = spark.read.parquet(out)
    assert back.count() == label_notes(fx.notes(spark, SF)).count()
    assert {"classification", "note_roles", "role_key", "sta3n"} <= set(back.columns) and "id" not in back.columns


def test_save_as_table(spark):
    name = "titlelabels_test_notes"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    labelled = classify_notes(fx.notes(spark, SF)).select("note_id", "note_roles", "note_types", "clf_source")
    write_notes(labelled, table=name)
    write_notes(labelled.withColumn("more", F.lit(1)), table=name, cluster=False)
    assert "more" in spark.table(name).columns and spark.table(name).count() == 1500
    spark.sql(f"DROP TABLE {name}")


def test_a_hot_group_is_cut_into_several_tasks(spark):
    rows = spark.range(0, 8000, 1, 8).select(
        F.array(F.lit("NURSING")).alias("note_roles"),
        F.array(F.when(F.col("id") % 10 == 0, "PLAN").otherwise("ORDER")).alias("note_types"),
        F.lit("RULES").alias("clf_source"),
    )
    for z in (False, True):
        laid = cluster_by_labels(rows, files=8, z_order=z)
        sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 4000
    assert cluster_by_labels(rows).columns == ["note_roles", "note_types", "clf_source", "role_key", "type_key"]


def test_anchor_files(spark, tmp_path):
    path = str(tmp_path / "anchors")
    write_anchors(anchor_table(spark), path)
    want = {}
    for dim, label, _, phrase in anchor_rows():
        want.setdefault(dim, {}).setdefault(label, []).append(phrase)
    got = {d: json.loads(next(Path(path, f"dim={d}").glob("*.txt")).read_text()) for d in want}
    assert got == want


def test_report_line(spark):
    df = spark.createDataFrame(
        [("T" * 50, ["NURSING", "CLINICAL"], [], 0.4575, 0.0625, "EMBEDDING")],
        "title string, roles array<string>, note_types array<string>, role_confidence float, "
        "note_type_confidence float, classification_source string",
    )
    line = reports.report_lines(df).first().line
    roles, none = str(["NURSING", "CLINICAL"]), str([])
    assert line == f"{'T' * 44:<45} {roles:<30} {none:<40} {'EMBEDDING':<18} {0.4575:>6.3f} {0.0625:>6.3f}"
    assert len(reports.REPORT_RULE) == 155


def test_reports_agree_with_the_rows(spark):
    labelled = classify_notes(fx.notes(spark, SF)).cache()
    rows = labelled.collect()
    mix = {r.clf_source: r.n_notes for r in reports.source_mix(labelled).collect()}
    assert sum(mix.values()) == len(rows) and set(mix) == {"RULES", "RULES+EMBEDDING", "EMBEDDING", "EMPTY"}
    audit = {r.tag: r.n_notes for r in reports.rule_audit(labelled).collect()}
    assert len(audit) == 60
    assert audit["type:soap"] == sum("type:soap" in r.rule_hits for r in rows)
    matrix = {(r.role, r.note_type): r.n_notes for r in reports.role_type_matrix(labelled).collect()}
    assert sum(matrix.values()) == sum(len(r.note_roles) * len(r.note_types) for r in rows)
    labelled.unpersist()


def test_streams(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    fx.notes(spark, SF).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    q = (
        with_rule_struct(stream)
        .select("note_id", "rules.roles")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c1"))
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination(120)
    want = with_rules(fx.notes(spark, SF), "note_title").select("note_id", "rules.roles")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, want.collect()))

    batches = str(tmp_path / "batches")
    q = label_batches(
        stream, lambda b, n: b.write.mode("overwrite").parquet(f"{batches}/batch={n}"), str(tmp_path / "c2")
    )
    q.awaitTermination(120)
    assert spark.read.parquet(batches).count() == 1500


def test_shared_folder_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert shared_folder(spark).startswith(root)
    assert shared_folder(spark) != shared_folder(spark)


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path):
    shared, source = Path(checkpoint_root(spark).removeprefix("file:")), str(tmp_path / "in")
    rows = [("COMPLETED", "INPATIENT", "NURSING PROGRESS NOTE"), ("SIGNED", "INPATIENT", "CONSULT"), ("COMPLETED", "OUT", "SOAP")]
    spark.createDataFrame(rows, "status string, patient_class string, note_title string").write.parquet(source)
    before = set(shared.iterdir())
    columns = ("status", "note_title")
    run(spark, source, path=str(tmp_path / "out"), columns=columns, z_order=True)
    run(spark, source, path=str(tmp_path / "all"), columns=columns, statuses=("COMPLETED", "SIGNED"), classes=("INPATIENT", "OUT"))
    assert set(shared.iterdir()) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1 and spark.read.parquet(str(tmp_path / "all")).count() == 3


def test_a_hot_group_of_one_task_is_cut_too(spark):
    df = spark.range(8000).coalesce(1).selectExpr("id", "'SOAP' AS note_title")
    from titlelabels.sources.sinks import cluster_by_labels

    out = cluster_by_labels(classify_notes(df), files=8)
    sizes = [len(p) for p in out.select("id").rdd.glom().collect()]
    assert max(sizes) < 3000
