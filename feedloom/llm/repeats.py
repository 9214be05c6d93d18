"""Which of many named places share their name: the exchange behind both substring operators.

A place is a row (name, more, uid, place); `place` packs start, length and a mark.  Places that meet their like inside one
batch of a task are settled there (marked): they need no partner.  One row without a place tells the others.  So a
name that a third of all documents share costs at most one row per batch in the exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES = "name long, more long, uid long, place long"
START = "place >> 32"


def packed(starts: np.ndarray, lengths: np.ndarray, marks: np.ndarray | int = 0) -> np.ndarray:
    return starts.astype(np.int64) << 32 | lengths.astype(np.int64) << 1 | marks


def _grouped(names: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order with equal (name, more) side by side, and where a new one begins."""
    order = np.argsort(names)
    same = names[order][1:] == names[order][:-1]
    other = more[order][1:] != more[order][:-1]
    if (same & other).any():  # different places of one name: rare, as names are hashes
        order = np.lexsort((more, names))
        same, other = names[order][1:] == names[order][:-1], more[order][1:] != more[order][:-1]
    return order, np.concatenate((np.ones(min(1, len(order)), bool), ~same | other))


def places(names: np.ndarray, more: np.ndarray, uids: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
           known: np.ndarray, public: np.ndarray) -> pa.RecordBatch:
    """Rows for the exchange.  known: repeated for sure; public: has copies elsewhere that need no answer, so no row of its own."""
    order, new = _grouped(names, more)
    group = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    several = np.diff(heads, append=len(order)) > 1
    told = several | (np.add.reduceat((known | public)[order], heads) > 0) if len(order) else several
    settled = np.empty(len(order), bool)
    settled[order] = told[group]
    heads = order[heads[told]]
    own = np.flatnonzero(~public)
    mark = settled[own]
    # a settled place travels under a name of its own, spread over all partitions
    sent = np.where(mark, uids[own] * 1_000_003 + starts[own], names[own].view(np.int64))
    nothing = pa.nulls(len(heads), pa.int64())
    return pa.record_batch({
        "name": pa.concat_arrays([pa.array(sent), pa.array(names[heads].view(np.int64))]),
        "more": pa.concat_arrays([pa.array(more[own].view(np.int64)), pa.array(more[heads].view(np.int64))]),
        "uid": pa.concat_arrays([pa.array(uids[own], pa.int64()), nothing]),
        "place": pa.concat_arrays([pa.array(packed(starts[own], lengths[own], mark)), nothing])})


def _twins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places that are marked, or next to a row of the same (name, more); the input is sorted by these.

    A row without a place stands for two or more settled elsewhere, so one equal neighbour is enough.
    """
    def kept(batch: pa.RecordBatch, before: tuple | None, after: tuple | None) -> pa.RecordBatch:
        names, more = (batch.column(i).to_numpy() for i in (0, 1))
        place = batch.column(3).fill_null(0).to_numpy()
        marked = place & 1 == 1
        like = np.zeros(len(names) + 1, bool)
        like[1:-1] = (names[1:] == names[:-1]) & (more[1:] == more[:-1]) & ~marked[1:] & ~marked[:-1]
        like[0] = before == (names[0], more[0], False) and not marked[0]
        like[-1] = after == (names[-1], more[-1], False) and not marked[-1]
        keep = (marked | like[1:] | like[:-1]) & ~batch.column(2).is_null().to_numpy(zero_copy_only=False)
        return pa.record_batch({"uid": batch.column(2).filter(pa.array(keep)), "place": pa.array(place[keep] & ~1)})

    def key(batch: pa.RecordBatch, at: int) -> tuple:
        at %= batch.num_rows
        return batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), bool((batch.column(3)[at].as_py() or 0) & 1)

    held, before = None, None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield kept(held, before, key(batch, 0))
                before = key(held, -1)
            held = batch
    if held is not None:
        yield kept(held, before, None)


def repeated(rows: DataFrame) -> DataFrame:
    """(uid, place) of the places whose name occurs more than once."""
    return rows.repartition("name", "more").sortWithinPartitions("name", "more").mapInArrow(_twins, "uid long, place long")


def gathered(rows: DataFrame) -> DataFrame:
    """Places by document, in order: uid, starts, lengths.  A document bounds the size of its group."""
    whole = rows.groupBy("uid").agg(F.sort_array(F.collect_list("place")).alias("places"))
    start, length = (lambda p: F.shiftright(p, 32).cast("int")), (lambda p: F.shiftright(p, 1).bitwiseAND(F.lit(2147483647)).cast("int"))
    return whole.select("uid", F.transform("places", start).alias("starts"), F.transform("places", length).alias("lengths"))


def covered(starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions 0 .. size - 1 inside any of the spans."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of a mask."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]
