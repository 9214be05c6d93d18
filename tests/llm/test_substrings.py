"""Both substring operators against brute force, on random, periodic, repeated, null and long texts."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import recompress, suffix_dedup
from feedloom.llm.induced import Queue, suffix_order
from feedloom.llm.queries import QUERIES


def removed(units, window, glue):
    """Per sequence: size, removed, runs, hash of the rest."""
    counts = collections.Counter(hash(u[i:i + window]) for u in units for i in range(len(u) - window + 1))
    out = []
    for u in units:
        gone = bytearray(len(u))
        for i in range(len(u) - window + 1):
            if counts[hash(u[i:i + window])] > 1:
                gone[i:i + window] = b"\1" * window
        rest = [x for x, g in zip(u, gone) if not g]
        out.append((len(u), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(glue(rest)).hexdigest()))
    return out


def words_of(text):
    return tuple(re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))


def random_rows(seed):
    rng, rows = random.Random(seed), []
    for i in range(120):
        kind = rng.random()
        if kind < 0.3:
            text = " ".join(rng.choice("ab") for _ in range(rng.randint(0, 120)))
        elif kind < 0.5:
            text = " ".join(["a"] * rng.randint(20, 90) + [rng.choice("xyzé") for _ in range(rng.randint(0, 40))])
        elif kind < 0.7:
            text = "ab cd ef " * rng.randint(5, 40) + "q" * rng.randint(0, 3)
        else:
            text = " \t\n".join(rng.choice(["u", "v", "w", "x y z u u v"]) for _ in range(rng.randint(0, 80)))
        rows.append((i, text))
    long_text = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(30_000))
    return [*rows, (1000, None), (1001, ""), (1002, " \t\n"), (None, rows[3][1]), (1003, long_text), (1004, long_text[5:90_000]), (1005, long_text), (1005, long_text)]


@pytest.mark.parametrize("window", [2, 5, 35])
def test_word_windows(docs_of, window):
    rows = random_rows(window)
    want = collections.Counter(zip((r[0] for r in rows), ((w[0], w[1], w[3]) for w in removed([words_of(t) for _, t in rows], window, b" ".join))))
    found = recompress.without_repeats(docs_of(rows), window).collect()
    got = collections.Counter((r.doc_id, (r.n_words, r.n_removed, r.kept_sha256)) for r in found)
    assert got == want
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)


@pytest.mark.parametrize(("window", "gram"), [(3, 3), (20, 8), (40, 48)])
def test_byte_windows(docs_of, window, gram):
    rows = random_rows(window)
    units = [(t or "").encode() for _, t in rows]
    want = collections.Counter(zip((r[0] for r in rows), removed(units, window, bytes)))
    found = suffix_dedup.without_repeats(docs_of(rows), window, gram, shard_bytes=20_000).collect()
    assert collections.Counter((r.doc_id, (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256)) for r in found) == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_passage_in_many_surroundings(docs_of, monkeypatch):
    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage, margin = some(400), some(10)
    rows = [(i, some(300) + passage + (margin if i % 3 else "") + some(300)) for i in range(150)] + [(i, some(250) + "ab " * 200 + some(9)) for i in range(150, 200)]
    want = collections.Counter(zip((r[0] for r in rows), removed([t.encode() for _, t in rows], 200, bytes)))
    largest, real = [], suffix_dedup.split_large

    def watched(distinct, *args):
        size = lambda d: d.groupBy("name").agg(F.sum(F.length("content") + 1).alias("n")).agg(F.max("n")).head()[0] or 0
        found, rest = real(distinct, *args)
        largest.append((size(distinct), size(rest)))
        return found, rest

    monkeypatch.setattr(suffix_dedup, "split_large", watched)
    found = suffix_dedup.without_repeats(docs_of(rows), 200, 48, shard_bytes=8_000).collect()
    assert collections.Counter((r.doc_id, (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256)) for r in found) == want
    assert largest[0][0] > 8_000 >= largest[0][1]


def test_no_rows(docs_of):
    assert recompress.without_repeats(docs_of([])).count() == 0
    assert suffix_dedup.without_repeats(docs_of([])).count() == 0


@pytest.mark.parametrize("name", ["op2_suffix_array_dedup", "op5_recompression_dedup"])
def test_registered(spark, sf, name):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES[name](spark, sf).collect()}
    assert len(got) == len(rows)
    if name.startswith("op2"):
        want = removed([(t or "").encode() for _, t in rows], 200, bytes)
        assert all((g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == w for (i, _), w in zip(rows, want) for g in [got[i]])
    else:
        want = removed([words_of(t) for _, t in rows], 35, b" ".join)
        assert all((g.n_words, g.n_removed, g.kept_sha256) == (w[0], w[1], w[3]) for (i, _), w in zip(rows, want) for g in [got[i]])


def test_middle_symbol_depends_on_the_window_alone():
    rng = np.random.default_rng(4)
    for window in (5, 9, 35):
        rounds = recompress.schedule(window)
        assert sum(limit for _, limit in rounds) == (window - 1) // 2
        for _ in range(60):
            inner = rng.integers(1, 4, window)
            seen = set()
            for _ in range(5):
                left, right = rng.integers(1, 4, rng.integers(0, 40)), rng.integers(1, 4, rng.integers(0, 40))
                text = np.concatenate((left, inner, right)).astype(np.uint64)
                names, starts, _ = recompress.parse(text, np.zeros(len(text), bool), rounds)
                seen.add(int(names[np.searchsorted(starts, len(left) + (window - 1) // 2, side="right") - 1]))
            assert len(seen) == 1


@pytest.mark.parametrize("limit", [100, 1 << 20])
def test_suffix_order(limit):
    rng = random.Random(7)
    for _ in range(120):
        letters, most = rng.choice([b"ab", b"a", b"abc", bytes(range(256))]), rng.choice([2, 5, 200])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(0, rng.choice([3, 20, 60])))) for _ in range(rng.randint(0, 6))]
        strings += [strings[0] + b"xx", b"q" + strings[-1] * 2] if strings else []
        _, at, common = suffix_order(strings, most, limit)
        suffixes, start = {}, 1
        for s in strings:
            suffixes |= {start + j: s[j:] for j in range(len(s))}
            start += len(s) + 1
        assert sorted(at) == sorted(suffixes)
        for k in range(1, len(at)):
            a, b = suffixes[at[k - 1]], suffixes[at[k]]
            shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert a[:most] >= b[:most] and min(shared, most) == min(common[k], most)


def test_queue_spills():
    queue = Queue(1, limit=64)
    for i in range(50):
        queue.put(i % 3, np.arange(i, i + 5))
    assert queue.file is not None
    assert queue.take(1)[0].tolist() == [x for i in range(50) if i % 3 == 1 for x in range(i, i + 5)]
    assert len(queue.take(1)[0]) == 0
