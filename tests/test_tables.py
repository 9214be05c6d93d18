"""Validation, cleaning, upserts, sinks and labels on small hand-written tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.functions import labels, times
from feedloom.operators import clean, upsert, validate
from feedloom.sources import readers, sinks

T = [datetime(2024, 1, d) for d in (1, 2, 3)]
FEEDBACK = "feedback_id string, feedback_text string, feedback_source string, created_at timestamp_ntz, sku string, rating int, cluster_id string"


@pytest.fixture()
def feedback(spark):
    rows = [
        ("fb001", "Shoes are leaking after 2 weeks", "review", T[0], "s1", 1, None),
        ("fb002", "Great shoes, very comfortable!", "review", T[1], "s1", 5, "old"),
        ("fb003", "Size runs small, had to return", "return", T[2], "s2", None, None),
    ]
    return spark.createDataFrame(rows, FEEDBACK)


@pytest.fixture()
def inventory(spark):
    return spark.createDataFrame([("s1", "Weekend"), ("s2", "Everyday"), ("s3", None)], "sku string, style string")


def ids(df):
    return sorted(r["feedback_id"] for r in df.collect())


def test_text_quality(spark, inventory):
    texts = ["fine", "", "   ", "!!!", "n/a", " N.A. ", "Not Applicable", None, "é", "\tna\t", "7", "na na"]
    rows = spark.createDataFrame([(f"{i}", t, "review", T[0], "s1", None, None) for i, t in enumerate(texts)], FEEDBACK)
    assert ids(clean.clean_feedback(clean.with_style(rows, inventory))) == ["0", "10", "11", "9"]


def test_unstyled_products_drop_out(feedback, inventory):
    assert ids(clean.with_style(feedback.withColumn("sku", F.lit("s3")), inventory)) == []


def test_resume_skips_known_ids(spark, feedback, inventory):
    ledger = spark.createDataFrame([("fb001", T[0]), ("fb002", T[0])], "feedback_id string, embedded_at timestamp_ntz")
    assert ids(clean.new_feedback(feedback, inventory, ledger)) == ["fb003"]
    assert ids(clean.new_feedback(feedback, inventory)) == ["fb001", "fb002", "fb003"]
    assert ids(clean.new_feedback(feedback, inventory, limit=2)) == ["fb001", "fb002"]


def test_date_bounds(feedback):
    assert ids(clean.in_date_range(feedback, "2024-01-02", "2024-01-02")) == ["fb002"]
    assert ids(clean.in_date_range(feedback, end="2024-01-01 23:59:59")) == ["fb001"]
    assert ids(clean.since(feedback, T[1])) == ["fb003"]
    assert ids(clean.days_back(feedback, T[2], 1)) == ["fb002", "fb003"]


def test_week_number_is_not_iso(spark):
    days = ["2024-01-01", "2024-01-06", "2024-01-07", "2024-12-31", "2023-01-01"]
    rows = spark.createDataFrame([(d,) for d in days], "d string").select(times.week_of_year(times.F.to_date("d")).alias("w"))
    assert [r.w for r in rows.collect()] == [1, 1, 2, 53, 1]


def test_upsert_replaces_inserts_and_is_idempotent(spark):
    schema = "feedback_id string, tag_name string, confidence_score double, created_at timestamp_ntz"
    target = spark.createDataFrame([("a", "x", 0.1, T[0]), ("b", "x", 0.2, T[0])], schema)
    changes = spark.createDataFrame([("a", "x", 0.5, T[1]), ("a", "x", 0.9, T[2]), ("a", "y", 0.3, T[0])], schema)
    once = upsert.upsert_tags(target, changes)
    want = {("a", "x", 0.9), ("b", "x", 0.2), ("a", "y", 0.3)}
    assert {tuple(r)[:3] for r in once.collect()} == want
    twice = upsert.upsert_tags(once, changes)
    assert {tuple(r)[:3] for r in twice.collect()} == want and twice.count() == 3


def test_assignments_keep_unmatched_rows(spark, feedback):
    new = spark.createDataFrame([("fb001", "c1"), ("zzz", "c2")], "feedback_id string, cluster_label string")
    rows = {r.feedback_id: r.cluster_id for r in upsert.apply_assignments(feedback, new).collect()}
    assert rows == {"fb001": "c1", "fb002": "old", "fb003": None}


def test_validation_reasons(spark):
    rows = spark.createDataFrame(
        [("a", [0.1] * 4, "m", "review", T[0]), ("b", [0.1] * 3, "m", "review", T[0]), ("c", [0.0] * 4, "m", "review", T[0]),
         ("d", None, "m", "review", T[0])],
        "feedback_id string, vector array<float>, model string, source string, created_at timestamp_ntz")
    good, bad = validate.split_valid(rows, "embedding", dim=4)
    assert ids(good) == ["a"]
    assert {r.feedback_id: r.reason for r in bad.collect()} == {"b": "wrong dimension", "c": "zero vector", "d": "missing vector"}
    tags = spark.createDataFrame([("a", "t", s, T[0]) for s in (0.0, 1.0, 1.5, -0.1)],
                                 "feedback_id string, tag_name string, confidence_score double, created_at timestamp_ntz")
    assert [r.valid for r in validate.validate(tags, "tag").collect()] == [True, True, False, False]
    with pytest.raises(ValueError, match="missing columns"):
        validate.require_columns(rows, "cluster")


def test_label_parts(spark):
    texts = ["source_review.style_chelsea.0.1.2", "source_chat.style_none.unclustered", "root.0", "source_a.source_b.style_x.y"]
    c = F.col("l")
    rows = spark.createDataFrame([(t,) for t in texts], "l string").select(
        labels.label_source(c), labels.label_style(c), labels.label_depth(c), labels.label_ancestors(c)).collect()
    assert [tuple(r)[:3] for r in rows] == [("review", "chelsea", 4), ("chat", "none", 2), ("unknown", None, 1), ("b", "x", 3)]
    assert rows[0][3] == ["source_review.style_chelsea", "source_review.style_chelsea.0", "source_review.style_chelsea.0.1", texts[0]]
    built = spark.range(1).select(labels.slice_label(F.lit("chat"), F.lit(None).cast("string"))).head()[0]
    assert built == "source_chat.style_none"


def test_vectors_as_text(spark):
    rows = readers.with_parsed_vectors(spark.createDataFrame([("[0.5, -1]",), ("[]",)], "vector string"))
    assert [list(r.vector) for r in rows.collect()] == [[0.5, -1.0], []]


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'He said "no",\nthen left', ["x", "y"]), ("b", None, [])], "id string, text string, ids array<string>")
    sinks.export_csv(rows, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "out"))
    got = {r.id: (r.text, r.ids) for r in back.collect()}
    assert got["a"] == ('He said "no",\nthen left', "x,y") and got["b"][0] is None


def test_quarantine_appends_with_keys(spark, feedback, tmp_path):
    _, failed = sinks.split_failures(feedback, F.when(F.col("rating").isNull(), "no rating"))
    for _ in range(2):
        sinks.quarantine(failed, str(tmp_path / "dead"))
    rows = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert [(r.feedback_id, r.error) for r in rows] == [("fb003", "no rating")] * 2


def test_source_folders_are_pruned(spark, tables, tmp_path):
    sinks.write_embeddings(tables.embeddings, str(tmp_path / "e"))
    rows = readers.scan_embeddings(spark.read.parquet(str(tmp_path / "e")), source="chat")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    assert rows.count() == tables.embeddings.filter("source = 'chat'").count()
