"""Readers of model answers, keyword tags, prompts and failure policies."""

import pytest
from pyspark.sql import functions as F

from feedloom.functions import responses
from feedloom.operators import reports, tagging, terms

CATS = ["Waterproof Leak", "Sizes not standard", "Too Heavy"]


def run(spark, fn, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, r string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("r"), CATS)).collect()]


@pytest.mark.parametrize("text, want", [
    ('["Waterproof Leak", "Too Heavy"]', ["Waterproof Leak", "Too Heavy"]),
    ('```json\n["Too Heavy"]\n```', ["Too Heavy"]),
    ("[]", ["Uncategorized"]),
    ('["Nope"]', ["Uncategorized"]),
    ('Here: ["Too Heavy", "Nope"] done', ["Too Heavy"]),
    ('[] but it is too heavy', ["Too Heavy"]),
    ('["Nope"] sizes not standard', ["Sizes not standard"]),
    ("too heavy, waterproof leak", ["Waterproof Leak", "Too Heavy"]),
    ("'Too Heavy'", ["Too Heavy"]),
    ("['Too Heavy']", ["Too Heavy"]),
    ('{"a": "Too Heavy"}', ["Too Heavy"]),
    ("nothing", ["Uncategorized"]),
    ('["Too Heavy", 3, null]', ["Too Heavy"]),
    ('["Too Heavy",', ["Too Heavy"]),
])
def test_multi_tags(spark, text, want):
    assert run(spark, responses.multi_tags, [text]) == [want]


def test_single_tag(spark):
    texts = ["Too Heavy", '"too heavy"', "I think Too Heavy fits", "heavy", "zzz", ""]
    assert run(spark, responses.single_tag, texts) == ["Too Heavy", "Too Heavy", "Too Heavy", "Too Heavy", "Uncategorized", "Waterproof Leak"]


def test_batch_answers(spark):
    answer = '{"1": ["Too Heavy", "x"], "2": "Waterproof Leak", "3": [], "5": 4}'
    items = spark.createDataFrame([(b, p) for b in range(4) for p in range(1, 6)], "batch int, position int").withColumn("shard", F.lit(0))
    answers = spark.createDataFrame([(0, answer), (1, "sorry"), (2, '["Too Heavy"]')], "batch int, response string").withColumn("shard", F.lit(0))
    rows = tagging.parse_batch_responses(items, answers, CATS, fallback=F.array(F.lit("F"))).orderBy("batch", "position").collect()
    none = ["Uncategorized"]
    assert [r.tags for r in rows if r.batch == 0] == [["Too Heavy"], ["Waterproof Leak"], none, none, none]
    assert [r.tags for r in rows if r.batch == 1] == [["F"]] * 5
    assert [r.tags for r in rows if r.batch == 2] == [none] * 5
    assert [r.tags for r in rows if r.batch == 3] == [["F"]] * 5


def test_batches_keep_order(spark):
    rows = spark.createDataFrame([(f"{i}", i) for i in range(9)], "feedback_id string, created_at int")
    got = reports.request_batches(rows, 3, F.lit(0)).orderBy("created_at").collect()
    assert [(r.batch, r.position) for r in got] == [(i // 3, i % 3 + 1) for i in range(9)]
    spread = reports.request_batches(rows, 3, reports.hash_shard(4))
    assert spread.groupBy("shard", "batch").count().filter("count > 3").count() == 0


def test_batches_of_a_whole_table(spark):
    rows = [(f"{i:03d}", None if i % 50 == 7 else i // 7, "t") for i in range(203)]
    frame = spark.createDataFrame(rows, "feedback_id string, created_at int, _n string").repartition(5)
    got = reports.numbered_batches(frame, 10).collect()
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert {r.feedback_id: (r.batch, r.position, r["_n"]) for r in got} == {r[0]: (i // 10, i % 10 + 1, "t") for i, r in enumerate(order)}
    assert reports.numbered_batches(frame.limit(0), 10).count() == 0


def test_prompt_block(spark):
    rows = spark.createDataFrame([(0, 0, 2, "b" * 300), (0, 0, 1, "a")], "shard int, batch int, position int, feedback_text string")
    assert tagging.build_prompts(rows, width=200).head()["block"] == "1. a\n2. " + "b" * 200


def test_keyword_tags_single_and_many(spark):
    rows = spark.createDataFrame([("1", "It LEAKS and is heavy"), ("2", None), ("3", "ok")], "feedback_id string, feedback_text string")
    rules = [("Waterproof Leak", "leak"), ("Too Heavy", "heavy"), ("Waterproof Leak", "wet")]
    many = [r.tags for r in tagging.keyword_tags(rows, rules).orderBy("feedback_id").collect()]
    assert many == [["Waterproof Leak", "Too Heavy"], ["Uncategorized"], ["Uncategorized"]]
    assert tagging.keyword_tags(rows, rules, allow_multiple=False).orderBy("feedback_id").head()["tags"] == ["Waterproof Leak"]


def test_failure_policies(spark):
    rows = spark.createDataFrame([("1", 0, ["a"], None), ("2", 1, ["b"], "boom")], "feedback_id string, batch int, tags array<string>, e string")
    assert [r.tags for r in tagging.apply_failure_policy(rows, F.col("e"), "default").orderBy("feedback_id").collect()] == [["a"], ["Uncategorized"]]
    assert tagging.apply_failure_policy(rows, F.col("e"), "quarantine").count() == 1
    with pytest.raises(Exception, match="batch 1 failed: boom"):
        tagging.apply_failure_policy(rows, F.col("e"), "fail").collect()
    with pytest.raises(ValueError):
        tagging.apply_failure_policy(rows, F.col("e"), "other")


def test_taxonomy_edits_leave_the_given_one(spark):
    base = tagging.taxonomy_table(spark)
    names = lambda df: [r.category for r in df.orderBy("priority").collect()]
    add = spark.createDataFrame([("New", 0), ("Stains", 1)], "category string, priority int")
    edited = tagging.edit_taxonomy(base, add=add, remove=spark.createDataFrame([("Smelly",)], "category string"))
    assert names(edited) == [n for n in tagging.DEFAULT_CATEGORIES if n != "Smelly"] + ["New"]
    assert names(base) == tagging.DEFAULT_CATEGORIES and len(tagging.DEFAULT_CATEGORIES) == 30


def test_cluster_descriptions(spark):
    texts = spark.createDataFrame([("a", "leak leak water"), ("a", "leak"), ("b", "tight toe water")], "cluster_label string, feedback_text string")
    top = terms.cluster_terms(texts, k=1)
    catalog = spark.createDataFrame([("a", "Cluster containing 2 feedback items"), ("z", "Cluster containing 1 feedback items")],
                                    "cluster_label string, cluster_description string")
    got = {r.cluster_label: r.cluster_description for r in terms.describe_clusters(catalog, top).collect()}
    assert got == {"a": "leak", "z": "Cluster containing 1 feedback items"}


def test_empty_reports(spark):
    none = spark.createDataFrame([], "tags array<string>")
    assert tuple(reports.multi_tag_stats(none).head()) == (0, 0.0, 0, 0, 0, 0)
