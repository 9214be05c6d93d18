"""Filter interaction audit: what every filter removes, in every order of the filters, from one pass over the documents.

A document's answers to all filters are a mask.  A mask fixes the outcome of each step of each order, so it stands for one
wide integer: a field per step (120 orders of five filters, 600 steps), each with five counters of 64 bits.  Tasks add the
integers of their documents per part; the sums are added again and unpacked.  A counter holds at most the number of rows,
which is below 2**64, so no field runs over into the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import words

COUNTERS = 5  # kept, removed, redundant, good lost, toxic lost
WORD_BYTES = 8
MOST_FILTERS = 7
HELD_PARTS = 256  # sums that a task holds before it hands them on
SLOTS = 64

Condition = Callable[[Column, Column], Column]

#: Filters on one text, given the text and its words; true means that the text fails.
CONDITIONS: dict[str, Condition] = {
    "A": lambda text, found: F.size(found) < 200,
    "B": lambda text, found: 100 * F.size(F.array_distinct(found)) < 50 * F.size(found),
    "C": lambda text, found: 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 3 * F.length(text).cast("long"),
    "D": lambda text, found: text.rlike("[#$%&*|]"),
}
REPEATS = "E"  # the text of a smaller doc_id, anywhere in the table


@lru_cache
def _orders(filters: int) -> np.ndarray:
    return np.array(list(permutations(range(filters))))


@lru_cache
def wide_integers(filters: int) -> list[int]:
    """The integer of each mask: a bit per filter, then one for good and one for toxic documents."""
    orders = _orders(filters)
    made = []
    for mask in range(4 << filters):
        fails = (mask >> orders) & 1
        before = np.cumsum(fails, axis=1) - fails
        removed = (fails == 1) & (before == 0)
        fields = np.stack([before + fails == 0, removed, (fails == 1) & (before > 0),
                           removed & bool(mask >> filters & 1), removed & bool(mask >> filters + 1 & 1)], axis=2)
        made.append(int.from_bytes(fields.astype("<u8").tobytes(), "little"))
    return made


def _size(filters: int) -> int:
    return factorial(filters) * filters * COUNTERS * WORD_BYTES


def _task_sums(filters: int):
    """Per task and part, the sum of the wide integers of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide, repeated, slot = wide_integers(filters), 1 << filters - 1, TaskContext.get().partitionId() % SLOTS
        sums: dict[str, int] = {}

        def handed() -> pa.RecordBatch:
            packed = [total.to_bytes(_size(filters), "little") for total in sums.values()]
            return pa.record_batch({"part": pa.array(list(sums), pa.string()), "slot": pa.array([slot] * len(sums), pa.int32()), "total": pa.array(packed, pa.binary())})

        for batch in batches:
            for part, mask, first, later in zip(*(column.to_pylist() for column in batch.columns)):
                sums[part] = sums.get(part, 0) + first * wide[mask] + (later * wide[mask | repeated] if later else 0)
                if len(sums) >= HELD_PARTS:
                    yield handed()
                    sums.clear()
        if sums:
            yield handed()

    return run


def _added(table: pa.Table) -> int:
    return sum(int.from_bytes(value.as_py(), "little") for value in table["total"])


def _slot_sums(filters: int):
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"part": table["part"][:1], "total": pa.array([_added(table).to_bytes(_size(filters), "little")], pa.binary())})
    return run


def _unpacked(names: list[str]):
    def run(table: pa.Table) -> pa.Table:
        orders, n = _orders(len(names)), len(names)
        counts = np.frombuffer(_added(table).to_bytes(_size(n), "little"), "<u8").reshape(len(orders), n, COUNTERS).astype(np.int64)
        removed = counts[:, :, 1]
        shapley = np.array([removed[orders == f].sum() for f in range(n)])
        unique = np.array([removed[orders[:, -1] == f][0, -1] for f in range(n)])  # last of all, so failing it only
        rows = len(orders) * n
        column = lambda i: pa.array(counts[:, :, i].ravel(), pa.int64())
        return pa.table({
            "part": pa.array([table["part"][0].as_py()] * rows, pa.string()),
            "filter_order": pa.array(np.repeat(["".join(names[f] for f in order) for order in orders], n), pa.string()),
            "step": pa.array(np.tile(np.arange(1, n + 1), len(orders)).astype(np.int32)),
            "filter": pa.array([names[f] for f in orders.ravel()], pa.string()),
            "kept": column(0), "removed": column(1), "redundant": column(2), "unique_fails": pa.array(unique[orders.ravel()], pa.int64()),
            "good_lost": column(3), "toxic_lost": column(4), "shapley": pa.array(shapley[orders.ravel()], pa.int64())})
    return run


OUT = ("part string, filter_order string, step int, filter string, kept long, removed long, redundant long, unique_fails long, "
       "good_lost long, toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", conditions: dict[str, Condition] | None = None,
          repeats: str = REPEATS) -> DataFrame:
    """Per value of column `part`, order of the filters and step: rows kept, removed, failing but gone already, and more.

    `docs` holds doc_id, text and the part; `labels` holds doc_id, quality and toxic, where one row of an id that says 1 is
    enough.  `conditions` are the filters on one text, by name; `repeats` names the filter for texts of a smaller doc_id.
    Null texts are empty, null parts the empty string.  Every row counts, repeated ones too.  A row without doc_id has no
    label, repeats nothing and is repeated by nothing.  Other columns are ignored; no rows give none.

    Copies meet as (text hash, part, answers) with counts added before the shuffle, so a text with a third of all rows is a
    few rows by then; what is gathered per hash is one row per part that holds the text.
    """
    conditions = CONDITIONS if conditions is None else conditions
    names = [*conditions, repeats]
    if len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    split = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = split.withColumn("found", words(F.col("text")))
    mask = F.lit(0)
    for i, condition in enumerate(conditions.values()):
        mask = mask + F.when(condition(F.col("text"), F.col("found")), 1 << i).otherwise(0)
    rows = split.select("id", "part", F.unhex(F.sha2("text", 256)).alias("sha"), mask.alias("mask"))
    rows = rows.groupBy("id", "sha", "part", "mask").agg(F.count("*").alias("n"))
    said = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(name)
    flags = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(said("quality"), said("toxic"))
    # rows without an id match nothing; the second key spreads them
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("sha"), F.lit(4096))).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("spread", spread).join(
        flags.withColumn("_spread", F.lit(0).cast("long")), (F.col("id") == F.col("_id")) & (F.col("spread") == F.col("_spread")), "left")
    flag = lambda name, bit: F.when(F.col(name), 1 << bit).otherwise(0)
    rows = rows.withColumn("mask", F.col("mask") + flag("quality", len(names)) + flag("toxic", len(names) + 1))
    rows = rows.groupBy("sha", "part", "mask").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n"))), F.lit(0)).alias("named"),
        F.min("id").alias("first"), F.min_by("n", "id").alias("n_first"))
    least = F.min("first").over(Window.partitionBy("sha"))
    rows = rows.withColumn("least", least)
    later = F.col("named") - F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    counted = rows.select("part", "mask", (F.col("n") - later).alias("first"), later.alias("later"))
    sums = counted.mapInArrow(_task_sums(len(names)), "part string, slot int, total binary")
    sums = sums.groupBy("part", "slot").applyInArrow(_slot_sums(len(names)), "part string, total binary")
    return sums.groupBy("part").applyInArrow(_unpacked(names), OUT)
