"""Substring dedup by recompression.

Rounds rename the word sequence of every text: a *run* round names maximal runs of one symbol, a *pair* round splits all
symbols in two sides by a bit of their name and names every pair (left side, right side).  A name is the 64-bit hash of
what it stands for, so all tasks give equal pairs equal names without a dictionary to exchange.  Only symbols up to a
round's length limit take part, so a round can only disturb one short symbol at either end of a substring.  The limits
are chosen such that, in every window of the given number of words, the symbol over the middle word depends on the window
alone: equal windows carry the same symbol there.

1. Spark counts the symbols of all texts; a window whose middle symbol occurs once is no repeat.
2. The remaining windows are named by two hashes of their words, one composed by doubling and one rolling, and exchanged; those
   whose name occurs again are the repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stored, unique_texts
from feedloom.llm.hashing import Powers, mixed, rolling
from feedloom.llm.repeats import PLACES, covered, gathered, places, repeated, spans

WINDOW = 35
CHUNK_WORDS = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def schedule(window: int) -> list[tuple[str, int]]:
    """Rounds (kind, greatest length of a symbol that takes part) whose limits sum to what lies beside a window's middle word."""
    budget = (window - 1) // 2
    if budget < 1:
        return []
    budget, limits, limit = budget - 1, [], 1
    while 2 * limit <= budget:
        limits += [limit, limit]
        budget -= 2 * limit
        limit *= 2
    while budget:  # what is left goes to the greatest limits that fit
        limit = min(limit, 1 << (budget.bit_length() - 1))
        limits.append(limit)
        budget -= limit
    return [("run", 1)] + [("pair", limit) for limit in sorted(limits)]


def parse(names: np.ndarray, frozen: np.ndarray, rounds: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, first words and marks of the symbols that the rounds leave; marked (frozen) ones are runs and separators."""
    size, starts, runs = len(names), np.arange(len(names)), frozen
    for number, (kind, limit) in enumerate(rounds, 1):
        if len(names) < 2:
            break
        active = (np.diff(starts, append=size) <= limit) & ~runs
        if kind == "run":
            same = (names[1:] == names[:-1]) & active[1:] & active[:-1]
            keep = np.concatenate(([True], ~same))
            fresh = np.concatenate((same, [False]))[keep]
            names, starts, runs = names[keep], starts[keep], runs[keep] | fresh
            names = np.where(fresh, mixed(names + np.uint64(number)), names)
        else:
            side = mixed(names ^ (np.uint64(number) + _ODD)) >> np.uint64(63) == 0
            first = np.flatnonzero(active[:-1] & active[1:] & side[:-1] & ~side[1:])
            joined = mixed(mixed(names[first]) * _ODD + names[first + 1])
            names = names.copy()
            names[first] = joined
            keep = np.ones(len(names), bool)
            keep[first + 1] = False
            names, starts, runs = names[keep], starts[keep], runs[keep]
    return names, starts, runs


def window_names(hashes: np.ndarray, window: int) -> np.ndarray:
    """A hash of every `window` consecutive words: names of 1, 2, 4 .. words are joined as the window's length needs."""
    total, at, power, step = None, 0, hashes, 1
    count = len(hashes) - window + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    while step <= window:
        if window & step:
            part = power[at:at + count]
            total = part if total is None else mixed(mixed(total) * _ODD + part)
            at += step
        if 2 * step <= window:
            power = mixed(mixed(power[:len(power) - step]) * _ODD + power[step:])
        step *= 2
    return total


class _WordHashes(dict):
    """Hash of each word seen, bounded by starting anew; 0 is the separator's."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) or 1
        return value


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # bytes split at \x20 and \x09-\x0D, and nowhere else


def _hashes(text: str, known: dict) -> np.ndarray:
    tokens = split_words(text)
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def _symbols(window: int):
    rounds = schedule(window)

    def chunk(uids: list[int], texts: list[np.ndarray]) -> pa.RecordBatch:
        ends = np.cumsum([len(t) + 1 for t in texts])
        names = np.zeros(ends[-1], np.uint64)
        frozen = np.zeros(len(names), bool)
        frozen[ends - 1] = True
        for end, t in zip(ends, texts):
            names[end - 1 - len(t):end - 1] = t
        names, starts, runs = parse(names, frozen, rounds)
        lengths = np.diff(starts, append=ends[-1])
        owner = np.searchsorted(ends, starts, side="right")
        real = starts != ends[owner] - 1
        names, starts, lengths, runs, owner = names[real], starts[real], lengths[real], runs[real], owner[real]
        starts = starts - (ends - [len(t) + 1 for t in texts])[owner]
        return places(names, np.zeros(len(names), np.uint64), np.array(uids)[owner], starts, lengths, runs, np.zeros(len(names), bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, uids, texts, size = _WordHashes(), [], [], 0
        for batch in batches:
            for uid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = _hashes(text.as_py(), known)
                if len(hashes) >= window:
                    uids.append(uid)
                    texts.append(hashes)
                    size += len(hashes)
                if size >= CHUNK_WORDS:
                    yield chunk(uids, texts)
                    uids, texts, size = [], [], 0
        if texts:
            yield chunk(uids, texts)
    return run


def _windows(window: int):
    middle = (window - 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = _WordHashes(), Powers()
        parts: list[tuple] = []
        size = 0

        def rows() -> pa.RecordBatch:
            names, more, uids, starts, public = (np.concatenate(x) for x in zip(*parts))
            none = np.zeros(len(names), bool)
            return places(names, more, uids, starts, np.full(len(names), window), none, public)

        for batch in batches:
            rows_of = zip(batch.column("uid").to_pylist(), batch.column("copies").to_pylist(), *(batch.column(c) for c in ("text", "starts", "lengths")))
            for uid, copies, text, starts, lengths in rows_of:
                hashes = _hashes(text.as_py(), known)
                count = len(hashes) - window + 1
                due = np.flatnonzero(covered(starts.values.to_numpy(), lengths.values.to_numpy(), len(hashes))) - middle
                due = due[(due >= 0) & (due < count)]
                if len(due):
                    parts.append((window_names(hashes, window)[due], rolling(hashes, window, powers)[due], np.full(len(due), uid), due,
                                  np.full(len(due), copies > 1)))
                    size += len(due)
                if size >= CHUNK_WORDS:
                    yield rows()
                    parts, size = [], 0
        if parts:
            yield rows()
    return run


def _removed(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                tokens = split_words(row["text"])
                starts, lengths = np.array(row["starts"] or [], np.int64), np.array(row["lengths"] or [], np.int64)
                if row["copies"] > 1 and len(tokens) >= window:
                    starts, lengths = np.array([0]), np.array([len(tokens)])
                mask = covered(starts, lengths, len(tokens))
                kept = b" ".join([t for t, gone in zip(tokens, mask) if not gone]) if mask.any() else b" ".join(tokens)
                first, last = spans(mask)
                out.append({"sha": row["sha"], "n_words": len(tokens), "n_removed": int(mask.sum()),
                            "spans": [{"start": int(a), "end": int(b)} for a, b in zip(first, last)],
                            "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept.decode("utf-8", "surrogatepass") if with_text else None})
            kind = pa.schema([("sha", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                              ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.string())])
            yield pa.RecordBatch.from_pylist(out, kind)
    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Remove every word covered by a window of `window` words that also starts elsewhere in `docs` (doc_id, text).

    One row per row of `docs`: doc_id, n_words, n_removed, spans (array of start, end in words), kept_sha256 and, if asked
    for, kept (remaining words joined by one space).  Windows stay inside one text and are judged on the input.  Words are
    split at ASCII white space and unchanged.  Null and empty texts have no words; shorter texts than a window lose
    nothing; a repeated row is a text of its own, so its windows occur twice.  Null ids are ids; other columns are ignored.
    """
    members, unique = unique_texts(docs)
    symbols = unique.select("uid", "text").mapInArrow(_symbols(window), PLACES)
    candidates = stored(gathered(repeated(symbols)))
    named = unique.select("uid", "copies", "text").join(candidates, "uid").mapInArrow(_windows(window), PLACES)
    found = stored(gathered(repeated(named)))
    done = unique.join(found, "uid", "left").select("sha", "copies", "text", "starts", "lengths").mapInArrow(
        _removed(window, with_text), "sha string, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept string")
    out = members.join(done, "sha").select("doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept")
    return out if with_text else out.drop("kept")
