"""Suffix order and common prefixes of a set of byte strings, by external induced sorting.

The strings are laid end to end, each with a separator of its own below all bytes.  Leftmost S suffixes (those whose first
byte is below the byte before and whose suffix ascends) are sorted by recursion: induction sorts the substrings between
them, equal substrings get equal names, and the shorter sequence of names is sorted by doubling.  A second induction
carries (suffix, common prefix with its neighbour) from them to all suffixes: a suffix taken from the queue puts its left
neighbour into the queue of that neighbour's byte.  Suffixes leave the queue by byte and, within a byte, in order of
arrival, so a monotone priority queue is one list per byte.  Lists above the memory limit are kept in a temporary file
of the task, which vanishes with it.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY_BYTES = 64 << 20
SYMBOLS = 257  # separator and 256 byte values


class Queue:
    """Lists of array batches by byte; beyond `limit` bytes of memory the batches go to disk."""

    def __init__(self, width: int, limit: int = MEMORY_BYTES):
        self.lists: list[list] = [[] for _ in range(SYMBOLS)]
        self.limit, self.held, self.file, self.width = limit, 0, None, width

    def put(self, symbol: int, *columns: np.ndarray) -> None:
        self.lists[symbol].append(columns)
        self.held += sum(c.nbytes for c in columns)
        if self.held > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            for batches in self.lists:
                for i, batch in enumerate(batches):
                    if not isinstance(batch, list):
                        spilled = []
                        for c in batch:
                            spilled.append((self.file.seek(0, 2), len(c), c.dtype))
                            c.tofile(self.file)
                        batches[i] = spilled
            self.held = 0

    def _load(self, place: tuple) -> np.ndarray:
        offset, count, kind = place
        self.file.seek(offset)
        return np.fromfile(self.file, kind, count)

    def take(self, symbol: int) -> tuple[np.ndarray, ...]:
        """All batches of a byte, one after the other, which leave the queue."""
        batches, self.lists[symbol] = self.lists[symbol], []
        if not batches:
            return tuple(np.empty(0, np.int64) for _ in range(self.width))
        loaded = [[self._load(c) for c in b] if isinstance(b, list) else b for b in batches]
        self.held -= sum(c.nbytes for b in batches if not isinstance(b, list) for c in b)
        return tuple(np.concatenate(c) for c in zip(*loaded))


def _pass(text: np.ndarray, own: Queue, other: Queue, down: bool, done: Queue) -> None:
    """Induce one type of suffixes, byte by byte, upward (L type) or downward (S type).

    own: suffixes of that type as they are found; other: those of the other type, given (leftmost S ones, or all L ones).
    Common prefixes are kept with the suffix taken before.  Results go to `done`, in the order taken.
    """
    for symbol in range(SYMBOLS - 1, 0, -1) if down else range(SYMBOLS):
        parts, turns = [own.take(symbol)], 0
        while len(parts[-1][0]):  # suffixes that start with 1, 2, 3 .. of this byte and then leave it
            turns += 1
            at, common = parts[-1]
            again = np.flatnonzero(text[at - 1] == symbol) if symbol else np.empty(0, np.int64)
            if not len(again):
                break
            least = np.minimum.reduceat(common[:again[-1] + 1], np.concatenate(([0], again[:-1] + 1))) + 1
            least[0] = turns  # after the last suffix of the turn before
            parts.append((at[again] - 1, least))
        at, common = (np.concatenate(c) for c in zip(*parts))
        if len(at):
            common[0] = 0
            done.put(symbol, at, common)
        rest, theirs = other.take(symbol)
        if len(rest):
            theirs = theirs.copy()
            theirs[0] = min(turns, _run(text, int(rest[0]))) if len(at) else 0
            if down:
                done.put(symbol, rest, theirs)
            at, common = np.concatenate((at, rest)), np.concatenate((common, theirs))
        if not len(at):
            continue
        before = text[at - 1]
        fits = (before < symbol) & (before > 0) if down else before > symbol
        chosen = np.flatnonzero(fits)
        chosen = chosen[np.argsort(before[chosen], kind="stable")]
        bounds = np.flatnonzero(np.diff(before[chosen], prepend=-1)).tolist() + [len(chosen)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            places = chosen[a:b]
            least = np.minimum.reduceat(common[:places[-1] + 1], np.concatenate(([0], places[:-1] + 1))) + 1
            least[0] = 1  # suffixes taken before it started with another byte
            own.put(int(before[places[0]]), at[places] - 1, least)


def _run(text: np.ndarray, at: int) -> int:
    """How often the byte at a place repeats."""
    end = at
    while text[end] == text[at] and text[at]:
        end += 1
    return max(1, end - at)


def _induce(text: np.ndarray, seeds: np.ndarray, common: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but the separators, from greatest to least, as batches (start, common prefix with the one before)."""
    starting, left, found_l, found = (Queue(2, limit) for _ in range(4))
    symbols = text[seeds]
    bounds = np.flatnonzero(np.diff(symbols, prepend=-1)).tolist() + [len(seeds)]
    for a, b in zip(bounds[:-1], bounds[1:]):
        starting.put(int(symbols[a]), seeds[a:b], common[a:b])
    _pass(text, left, starting, False, found_l)
    turned = Queue(2, limit)
    for symbol in range(SYMBOLS):
        at, shared = found_l.take(symbol)
        if len(at):  # upward to downward: a common prefix belongs to the pair, so it moves by one
            turned.put(symbol, at[::-1], np.concatenate(([0], shared[:0:-1])))
    _pass(text, Queue(2, limit), turned, True, found)
    return [found.take(symbol) for symbol in range(SYMBOLS - 1, 0, -1)]


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, most: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes beyond what is `known`, up to `most`; separators match nothing."""
    out = known.copy()
    open_ = np.flatnonzero(out < most)
    while len(open_):
        x, y = a[open_] + out[open_], b[open_] + out[open_]
        same = (text[x] == text[y]) & (text[x] > 0) & (x != y)
        open_ = open_[same]
        out[open_] += 1
        open_ = open_[out[open_] < most]
    return out


def suffix_order(strings: list[bytes], most: int, limit: int = MEMORY_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, starts, common): suffixes from greatest to least with the common prefix with the one before.

    Order and common prefixes are exact up to `most` bytes; longer common prefixes are at least `most`.
    """
    size = sum(map(len, strings)) + len(strings) + 1
    text = np.zeros(size, np.int16)  # a separator in front, so that every suffix has a left neighbour
    at = 1
    for s in strings:
        text[at:at + len(s)] = np.frombuffer(s, np.uint8)
        text[at:at + len(s)] += 1
        at += len(s) + 1
    # S type: below the next byte that differs
    change = np.flatnonzero(np.diff(text))
    following = np.minimum(np.searchsorted(change, np.arange(size)), len(change) - 1) if len(change) else np.zeros(size, np.int64)
    ascends = np.zeros(size, bool)
    if len(change):
        ascends[:-1] = text[change[following[:-1]] + 1] > text[:-1]
    ascends[text == 0] = True
    starts = np.flatnonzero(ascends[1:] & ~ascends[:-1]) + 1  # leftmost S places, separators included
    ends = np.append(starts[1:], size - 1)

    # Names of the substrings between them: one induction from the unsorted places.
    rough = starts[np.argsort(text[starts], kind="stable")]
    nothing = np.zeros(len(rough), np.int64)
    is_start = np.zeros(size, bool)
    is_start[starts] = True
    batches = [at[is_start[at]] for at, _ in _induce(text, rough, nothing, limit)]
    order = np.concatenate(batches)[::-1] if batches else np.empty(0, np.int64)
    zeros = starts[text[starts] == 0]
    number = np.zeros(size, np.int64)
    number[starts] = np.arange(len(starts))
    length = np.where(text[starts] == 0, 0, ends - starts + 1)
    left, right = order[:-1], order[1:]
    alike = (length[number[left]] == length[number[right]]) if len(order) else np.empty(0, bool)
    span = length[number[left]] if len(order) else np.empty(0, np.int64)
    # equal up to and including the next leftmost S place; a substring that ends at a separator is like no other
    checked = np.flatnonzero(alike)
    alike[checked] = _common(text, left[checked], right[checked], np.zeros(len(checked), np.int64), 1 << 60 if not len(checked) else int(span[checked].max())) >= span[checked]
    names = np.zeros(len(starts), np.int64)
    names[number[zeros]] = np.arange(1, len(zeros) + 1)
    if len(order):
        names[number[order]] = len(zeros) + 1 + np.concatenate(([0], np.cumsum(~alike)))

    # Order of the name sequences by doubling, until all differ or `most` bytes are compared (each name is two bytes or more).
    ranks, step, ladder = names, 1, [names]
    while step * 2 <= 2 * most and len(np.unique(ranks)) < len(ranks):
        ahead = np.zeros(len(ranks), np.int64)
        ahead[:-step] = ranks[step:] if step < len(ranks) else ahead[:-step]
        key = ranks * (len(ranks) + 2) + ahead
        _, ranks = np.unique(key, return_inverse=True)
        ranks = ranks + 1
        ladder.append(ranks)
        step *= 2
    place = np.argsort(ranks, kind="stable")
    a, b = place[:-1].copy(), place[1:].copy()
    x, y = a.copy(), b.copy()
    for k, rank in zip(range(len(ladder) - 1, -1, -1), ladder[::-1]):
        inside = (x < len(rank)) & (y < len(rank))
        equal = inside & (rank[np.minimum(x, len(rank) - 1)] == rank[np.minimum(y, len(rank) - 1)])
        x, y = x + equal * (1 << k), y + equal * (1 << k)
    edge = np.append(starts, size - 1)
    known = edge[np.minimum(x, len(starts))] - starts[a]
    common = _common(text, starts[a], starts[b], np.minimum(known, most), most)
    batches = _induce(text, starts[place], np.concatenate(([0], common)), limit)
    return text, np.concatenate([b[0] for b in batches] + [np.empty(0, np.int64)]), np.concatenate([b[1] for b in batches] + [np.empty(0, np.int64)])
