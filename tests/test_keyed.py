"""Stored tables with keyed writes: touched folders only, repeatable, finished after a stop."""

import datetime
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from checks.pairs_text import RULES
from feedloom.plans import ingest
from feedloom.session import cut, scratch
from feedloom.sources import keyed

DAY = datetime.datetime(2024, 1, 1)
LATER = datetime.datetime(2024, 1, 9)


def items(spark, rows):
    return spark.createDataFrame(rows, "feedback_id string, embedded_at timestamp_ntz")


def files(folder):
    return {os.path.relpath(f, folder) for f in glob.glob(f"{folder}/bucket=*/*.parquet")}


def rows_of(table, spark):
    return sorted(map(tuple, table.read(spark).collect()), key=str)


def test_only_touched_folders_are_replaced(spark, tmp_path):
    ledger = keyed.ledger_table(str(tmp_path), buckets=16)
    assert ledger.read(spark).count() == 0
    first = ledger.upsert(items(spark, [(f"f{i}", DAY) for i in range(200)]))
    assert (first.keys, first.changed) == (200, 200) and len(first.buckets) == 16
    before = files(ledger.folder)
    again = ledger.upsert(items(spark, [(f"f{i}", DAY) for i in range(200)] * 2))
    assert (again.keys, again.changed, again.buckets) == (200, 0, []) and files(ledger.folder) == before
    some = ledger.upsert(items(spark, [("f3", LATER), ("f3", DAY), ("new", DAY), ("f4", DAY)]))
    assert (some.keys, some.changed) == (3, 2) and 1 <= len(some.buckets) <= 2
    kept = {f for f in before if int(f.split("/")[0][7:]) not in some.buckets}
    assert kept and kept <= files(ledger.folder) and not (before - kept) & files(ledger.folder)
    want = {f"f{i}": DAY for i in range(200)} | {"f3": LATER, "new": DAY}
    assert dict(rows_of(ledger, spark)) == want and ledger.read(spark).count() == 201


def test_reads_for_keys_prune(spark, tmp_path):
    ledger = keyed.ledger_table(str(tmp_path), buckets=16)
    ledger.upsert(items(spark, [(f"f{i}", DAY) for i in range(200)]))
    part = ledger.read_for(spark.createDataFrame([("f7",)], "feedback_id string"))
    assert 0 < part.count() < 60 and part.filter("feedback_id = 'f7'").count() == 1
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ = \d+", plan)


def test_a_stopped_write_is_finished_or_dropped(spark, tmp_path):
    ledger = keyed.ledger_table(str(tmp_path), buckets=4)
    ledger.upsert(items(spark, [(f"f{i}", DAY) for i in range(40)]))
    want = rows_of(ledger, spark)
    # stopped before the files were complete: nothing has changed
    os.makedirs(f"{ledger.folder}/_pending/bucket=1")
    open(f"{ledger.folder}/_pending/bucket=1/x.parquet", "w").close()
    assert rows_of(ledger, spark) == want
    assert ledger.upsert(items(spark, [])).keys == 0 and not os.path.exists(f"{ledger.folder}/_pending")
    assert rows_of(ledger, spark) == want
    # stopped while folders were moved: one old folder is gone, its successor waits
    bucket = sorted(glob.glob(f"{ledger.folder}/bucket=*"))[0]
    number = int(bucket.rsplit("=", 1)[1])
    whole = cut(ledger._some(spark, [number]))
    whole.withColumn("embedded_at", F.lit(LATER).cast("timestamp_ntz")).write.partitionBy("bucket").parquet(f"{ledger.folder}/_pending")
    keyed.remove(spark, bucket)
    ledger.upsert(items(spark, []))
    got = dict(rows_of(ledger, spark))
    moved = {r.feedback_id for r in whole.collect()}
    assert moved and got == {k: LATER if k in moved else v for k, v in want}


def test_types_nulls_and_extra_columns(spark, tmp_path):
    tags = keyed.tags_table(str(tmp_path), buckets=4)
    rows = spark.createDataFrame([(1, "a", 0.5, DAY, 9), (1, "b", 0.5, DAY, 9), (None, "a", 0.1, DAY, 9), (None, "a", 0.2, LATER, 9)],
                                 "feedback_id int, tag_name string, confidence_score double, created_at timestamp_ntz, bucket int")
    assert tags.upsert(rows).changed == 3 and tags.upsert(rows).changed == 0
    assert rows_of(tags, spark) == sorted([("1", "a", 0.5, DAY), ("1", "b", 0.5, DAY), (None, "a", 0.2, LATER)], key=str)


def test_sync_gives_the_number_of_items(spark, tmp_path):
    ledger = keyed.ledger_table(str(tmp_path), buckets=4)
    stored = spark.createDataFrame([("a", DAY), ("b", DAY)], "feedback_id string, created_at timestamp_ntz")
    assert keyed.sync_ledger(ledger, stored) == 2 and keyed.sync_ledger(ledger, stored) == 2 and keyed.sync_ledger(ledger, stored.limit(0)) == 0


def test_assignments_leave_the_texts_alone(spark, tmp_path):
    assigned = keyed.assigned_table(str(tmp_path), buckets=4)
    label = lambda rows: spark.createDataFrame(rows, "feedback_id string, cluster_label string")
    keyed.write_assignments(assigned, label([("a", "x"), ("b", "x")]), "2024-02-01 00:00:00")
    keyed.write_assignments(assigned, label([("a", "a-later-run")]), "2024-03-01 00:00:00")
    feedback = spark.createDataFrame([("a", "t", None), ("b", "t", "old"), ("c", "t", "kept")], "feedback_id string, feedback_text string, cluster_id string")
    got = keyed.with_assigned(feedback, assigned.read(spark))
    assert got.columns == feedback.columns
    assert {r.feedback_id: r.cluster_id for r in got.collect()} == {"a": "a-later-run", "b": "x", "c": "kept"}


@pytest.mark.parametrize("skip", [True, False])
def test_ingest_into_stored_tables(spark, tables, tmp_path, skip):
    root = str(tmp_path)
    feedback, inventory = cut(tables.feedback), cut(tables.inventory)
    early = feedback.filter("created_at < TIMESTAMP_NTZ '2024-01-03'")
    go = lambda rows, day: ingest.run_ingest(spark, root, rows, inventory, RULES, now=f"2024-02-0{day} 00:00:00", skip_embedded=skip, buckets=8)
    first = go(early, 1)
    assert first.stats["total_records"] == first.embeddings.changed == first.ledger.changed > 0 and first.tags.changed >= first.embeddings.changed
    names = files(f"{root}/embeddings")
    again = go(early, 2)
    if skip:
        assert again.stats["total_records"] == 0 and again.synced == first.embeddings.keys
    assert again.embeddings.changed == again.tags.changed == 0 and files(f"{root}/embeddings") == names
    both = go(feedback, 3)
    ids = {r.feedback_id for r in keyed.embeddings_table(root, 8).read(spark).collect()}
    assert ids == {r.feedback_id for r in keyed.ledger_table(root, 8).read(spark).collect()}
    assert len(ids) == first.embeddings.changed + both.embeddings.changed == keyed.embeddings_table(root, 8).read(spark).count()


def test_scratch_tables_go_at_the_end(spark):
    with scratch(spark) as outer:
        rows = cut(spark.range(10))
        with scratch(spark) as inner:
            assert cut(rows).count() == 10 and inner.startswith(outer) and os.path.isdir(inner)
        assert not os.path.exists(inner) and rows.count() == 10
    assert not os.path.exists(outer)
    with pytest.raises(KeyError), scratch(spark) as failed:
        cut(spark.range(3))
        raise KeyError
    assert not os.path.exists(failed) and cut(spark.range(4)).count() == 4
