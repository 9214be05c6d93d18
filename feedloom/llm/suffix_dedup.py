"""Suffix-array dedup of byte strings, in shards sorted by external induction.

1. *Shards.*  Every window of `window` bytes is named by the least hash of the byte grams inside it, which depends on the
   window alone: equal windows have equal names.  Consecutive windows with one name form a segment.  Names that occur
   once in all texts hold no repeat; the segments of the others are collected by name, equal segments once.  Names with
   more bytes than a shard, such as those of a passage in many different surroundings, are split: a window's distance to
   its naming gram and the bytes that windows of about this distance share make its new name, so equal windows still meet;
   names that are still too large are split into single windows.  Names are dealt to shards of bounded expected size.
2. *Sorting.*  A shard's segments are one suffix array, built with its common prefixes by `induced.suffix_order`.  A window
   repeats if its suffix shares at least `window` bytes with a neighbour.
3. *Removal.*  Repeated windows are gathered per text; the bytes they cover go.

A segment that many documents share is settled inside the batches that meet it and sorted once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import meet, stored, unique_texts
from feedloom.llm.hashing import Powers, rolling
from feedloom.llm.induced import suffix_order
from feedloom.llm.repeats import PLACES, covered, gathered, packed, places, repeated, spans, START

WINDOW = 200
GRAM = 48
SHARD_BYTES = 1_500_000
CHUNK_ROWS = 100_000
STEPS = (16, 1)  # distances to the naming gram that split a large name together; 1 leaves single windows

def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by doubling."""
    count, step = len(values) - width + 1, 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[:count], values[width - step:width - step + count])


def segments(text: bytes, window: int, gram: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names, first windows and numbers of windows of a text's segments; whether the name occurs twice in the text."""
    if len(text) < window:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(bool)
    grams = rolling(np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1), gram, powers)
    width = window - gram + 1
    names = _least(grams, width)
    first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
    lengths = np.diff(first, append=len(names))
    # a gram names some window if it equals the greatest name of the windows that hold it
    edge = np.full(width - 1, np.iinfo(np.uint64).max, np.uint64)
    greatest = ~_least(~np.concatenate((~edge, names, ~edge)), width)
    naming, times = np.unique(grams[grams == greatest], return_counts=True)
    twice = times[np.searchsorted(naming, names[first])] > 1
    return names[first], first, lengths, twice


def _named(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, parts, size = Powers(), [], 0

        def rows() -> pa.RecordBatch:
            names, uids, first, lengths, twice = (np.concatenate(x) for x in zip(*parts))
            return places(names, np.zeros(len(names), np.uint64), uids, first, lengths, twice, np.zeros(len(names), bool))

        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                names, first, lengths, twice = segments(text.as_py().encode("utf-8", "surrogatepass"), window, gram, powers)
                if len(names):
                    parts.append((names, np.full(len(names), uid), first, lengths, twice))
                    size += len(names)
                if size >= CHUNK_ROWS:
                    yield rows()
                    parts, size = [], 0
        if parts:
            yield rows()
    return run


def _filed(parts: list[tuple]) -> pa.RecordBatch:
    """Rows for the exchange, from (name, hash of the bytes, uid, first window, windows, public, bytes)."""
    names, more, uids, first, lengths, public, contents = zip(*parts)
    names, more = np.array(names, np.uint64), np.array(more, np.uint64)
    lengths = np.array(lengths)
    out = places(names, more, np.array(uids), np.array(first), lengths, np.zeros(len(names), bool), np.array(public))
    content = {(n, m): c for n, m, c in zip(names.view(np.int64).tolist(), more.view(np.int64).tolist(), contents)}
    place, name, digest = (out.column(i).to_pylist() for i in (3, 0, 1))
    held = [None if p is not None and p & 1 else content[(n, d)] for p, n, d in zip(place, name, digest)]
    return out.append_column("content", pa.array(held, pa.binary()))


def _contents(window: int, gram: int):
    """Segments with their bytes: `name` is the segment's, `more` the hash of its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, parts, size = Powers(), [], 0

        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"].encode("utf-8", "surrogatepass")
                names, first, lengths, _ = segments(text, window, gram, powers)
                at = np.searchsorted(first, np.array(row["starts"]))
                for i in at.tolist():
                    a, n = int(first[i]), int(lengths[i])
                    content = text[a:a + n - 1 + window]
                    parts.append((names[i], xxhash.xxh3_64_intdigest(content), row["uid"], a, n, row["copies"] > 1, content))
                    size += len(content)
                    if size >= SHARD_BYTES:
                        yield _filed(parts)
                        parts, size = [], 0
        if parts:
            yield _filed(parts)
    return run


def cut_segment(content: bytes, name: int, window: int, gram: int, step: int, powers: Powers) -> Iterator[tuple[int, int, int]]:
    """(name, first window, windows) of the parts of a segment whose windows lie alike around their naming gram.

    Windows that are equal have equal distances to the first gram inside them that names them.  `step` distances go
    together; the bytes that all windows of these distances hold, and the distance, give the new name.
    """
    grams = rolling(np.frombuffer(content, np.uint8).astype(np.uint64) + np.uint64(1), gram, powers)
    naming = np.flatnonzero(grams == np.uint64(name))
    windows = np.arange(len(content) - window + 1)
    at = naming[np.searchsorted(naming, windows)]
    turn = (at - windows) // step
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (turn[1:] != turn[:-1]))))
    for i, n in zip(first.tolist(), np.diff(first, append=len(windows)).tolist()):
        begin, q = int(at[i]), int(turn[i])
        shared = content[begin - q * step:begin - (q + 1) * step + 1 + window]
        yield xxhash.xxh3_64_intdigest(shared, seed=q + 1), i, n


def _cut(window: int, gram: int, step: int):
    """Parts of the segments of large names, in the form of `_contents`; a segment that occurs several times needs no answer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, parts, size, origins = Powers(), [], 0, {}

        def rows() -> pa.RecordBatch:
            out = _filed(parts)
            return out.append_column("origin", pa.array([origins.get(n % 2**64) for n in out.column(0).to_pylist()], pa.int64()))

        for batch in batches:
            for row in batch.to_pylist():
                content = row["content"]
                for name, i, n in cut_segment(content, row["origin"] % 2**64, window, gram, step, powers):
                    origins[name] = row["origin"]
                    part = content[i:i + n - 1 + window]
                    parts.append((name, xxhash.xxh3_64_intdigest(part), row["uid"], row["start"] + i, n, row["several"], part))
                    size += len(part)
                if size >= SHARD_BYTES:
                    yield rows()
                    parts, size, origins = [], 0, {}
        if parts:
            yield rows()
    return run


def _sorted_shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        contents = [c.as_py() for c in table["content"]]
        _, at, common = suffix_order(contents, window)
        like = common >= window
        like[:-1] |= like[1:].copy()
        ends = np.cumsum([len(c) + 1 for c in contents])
        begin = ends - np.array([len(c) for c in contents])
        at = np.sort(at[like])
        owner = np.searchsorted(ends, at)
        offset = at - begin[owner]
        single = ~table["several"].to_numpy()[owner]
        owner, offset = owner[single], offset[single]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
        first = np.flatnonzero(new)
        runs = np.diff(first, append=len(owner))
        uid, start = table["uid"].to_numpy(), table["start"].to_numpy()
        return pa.table({"uid": pa.array(uid[owner[first]].astype(np.int64)), "place": pa.array(packed(start[owner[first]] + offset[first], runs))})
    return run


def _removed(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("sha", pa.string()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.binary())])
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["text"].encode("utf-8", "surrogatepass")
                starts, lengths = np.array(row["starts"] or [], np.int64), np.array(row["lengths"] or [], np.int64) + window - 1
                if row["copies"] > 1 and len(text) >= window:
                    starts, lengths = np.array([0]), np.array([len(text)])
                mask = covered(starts, lengths, len(text))
                first, last = spans(mask)
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes() if len(first) else text
                out.append({"sha": row["sha"], "n_bytes": len(text), "n_removed": len(text) - len(kept),
                            "spans": [{"start": int(a), "end": int(b)} for a, b in zip(first, last)],
                            "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if with_text else None})
            yield pa.RecordBatch.from_pylist(out, kind)
    return run


def _distinct(parts: DataFrame, *origin: Column) -> DataFrame:
    """Equal segments once: whether they occur several times, else where."""
    several = F.sum(F.when(F.col("uid").isNull(), 2).otherwise(1)) > 1
    rows = parts.filter("content IS NOT NULL").groupBy("name", "more").agg(
        several.alias("several"), F.min("uid").alias("uid"), F.min(F.expr(START)).alias("start"), F.first("content").alias("content"), *origin)
    return stored(rows.withColumn("several", F.col("several") | F.col("uid").isNull()).fillna({"uid": -1, "start": -1}))


def split_large(distinct: DataFrame, window: int, gram: int, shard_bytes: int) -> tuple[list[DataFrame], DataFrame]:
    """Places found equal, and segments left to sort, after names of more than `shard_bytes` are split."""
    found, done = [], []
    left = distinct.withColumn("origin", F.col("name"))
    for step in (min(step, window - gram + 1) for step in STEPS):
        sizes = left.groupBy("name").agg(F.sum(F.length("content") + 1).alias("bytes"))
        large = stored(sizes.filter(F.col("bytes") > shard_bytes).select("name"))
        if not large.head(1):
            break
        done.append(meet(left, large, "name", how="left_anti"))
        parts = meet(left, large, "name").mapInArrow(_cut(window, gram, step), f"{PLACES}, content binary, origin long")
        if step == 1:  # equal names are equal windows: nothing is left to sort
            found.append(repeated(parts.drop("content", "origin")))
            left = None
            break
        parts = stored(parts)
        found.append(repeated(parts.drop("content", "origin")))
        left = _distinct(parts, F.first("origin").alias("origin"))
    rest = [*done, left] if left is not None else done
    return found, reduce(DataFrame.unionByName, rest).drop("origin")


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = True, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Remove every byte covered by a string of `window` bytes that also starts elsewhere in `docs` (doc_id, text).

    One row per row of `docs`: doc_id, n_bytes, n_removed, spans (array of start, end in bytes), kept_sha256 and, if asked
    for, kept (the remaining bytes; a cut may fall inside a character).  Strings stay inside one text and are judged on
    the input.  Null and empty texts have no bytes; texts shorter than a window lose nothing; a repeated row is a text of
    its own, so its strings occur twice.  Null ids are ids; other columns are ignored.
    """
    gram = min(gram, window)
    members, unique = unique_texts(docs)
    named = unique.select("uid", "text").mapInArrow(_named(window, gram), PLACES)
    candidates = stored(gathered(repeated(named)))
    cut_out = unique.select("uid", "copies", "text").join(candidates, "uid").select("uid", "copies", "text", "starts")
    parts = stored(cut_out.mapInArrow(_contents(window, gram), f"{PLACES}, content binary"))
    whole = repeated(parts.drop("content"))
    split, distinct = split_large(_distinct(parts), window, gram, shard_bytes)
    total = distinct.agg(F.coalesce(F.sum(F.length("content") + 1), F.lit(0))).head()[0]
    shards = max(1, math.ceil(total / shard_bytes))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
    sorted_ = dealt.groupBy("shard").applyInArrow(_sorted_shard(window), "uid long, place long")
    found = stored(gathered(reduce(DataFrame.unionByName, [*split, sorted_], whole)))
    done = unique.join(found, "uid", "left").select("sha", "copies", "text", "starts", "lengths").mapInArrow(
        _removed(window, with_text), "sha string, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept binary")
    out = members.join(done, "sha").select("doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept")
    return out if with_text else out.drop("kept")
