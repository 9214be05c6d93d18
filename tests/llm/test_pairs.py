"""Jaccard join, decontamination and exact search against brute force."""

import random

import pytest

from checks.compare import compare, duck
from feedloom.llm import decontaminate, jaccard, links, topk
from feedloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    ok, line = compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)
    assert ok, line


def grams(text, width=5):
    tokens = (text or "").lower().split()
    return {tuple(tokens)} if 0 < len(tokens) < width else {tuple(tokens[i:i + width]) for i in range(len(tokens) - width + 1)}


def near_rows(seed):
    rng, rows = random.Random(seed), []
    for i in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 8])):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9)}"
            rows.append((len(rows), " ".join(copy)))
    return [*rows, (500, None), (501, ""), (502, " "), (None, rows[0][1]), (7, rows[7][1]), (503, " ".join(f"v{i}" for i in range(30_000)))]


@pytest.mark.parametrize("block_grams", [40, 200_000])
def test_near_duplicates(docs_of, block_grams):
    rows = near_rows(block_grams)
    sets = [grams(t) for _, t in rows]
    lowest = {}
    for (i, _), s in zip(rows, sets):
        if s:
            key = frozenset(s)
            lowest[key] = i if key not in lowest or lowest[key] is None or (i is not None and i < lowest[key]) else lowest[key]
            if i is None or any(r[0] is None and frozenset(g) == key for r, g in zip(rows, sets)):
                lowest[key] = None  # null ids are least
    keys = list(lowest)
    linked = {a: {b for b in keys if a != b and len(a & b) >= 0.8 * len(a | b)} for a in keys}

    def component(key):
        seen, due = {key}, [key]
        while due:
            for other in linked[due.pop()] - seen:
                seen.add(other)
                due.append(other)
        ids = [lowest[k] for k in seen]
        return None if None in ids else min(ids)

    got = jaccard.near_duplicates(docs_of(rows), block_grams=block_grams).collect()
    assert len(got) == len(rows)
    want = sorted(((i, component(frozenset(s)) if s else i, len(linked[frozenset(s)]) if s else 0, lowest[frozenset(s)] if s else i) for (i, _), s in zip(rows, sets)), key=str)
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.copy_id) for r in got), key=str) == want
    kept = jaccard.without_near_duplicates(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({r.doc_id for r in got if r.keeper}, key=str)
    assert sum(r.doc_id in (500, 501, 502) for r in kept.collect()) == 3


def test_blocks_are_bounded_by_sets(spark, docs_of):
    short = spark.range(20_000).selectExpr("'a' AS cluster", "10L AS n_grams")
    assert jaccard.block_counts(short).head().blocks == 5
    rows = [(i, f"one two three four five six seven eight nine ten eleven twelve thirteen w{i}") for i in range(60)]
    got = jaccard.near_duplicates(docs_of(rows), block_sets=7).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 59)} and sum(r.keeper for r in got) == 1


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = jaccard.bands_for(threshold, 0.999, 400)
        assert bands * rows <= 400 and 1 - (1 - threshold ** rows) ** bands >= 0.999
    with pytest.raises(ValueError):
        jaccard.bands_for(0.1, 0.9999, 10)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(999, i) for i in range(600, 700)]
    least = {n: n for e in edges for n in e}
    for _ in least:
        moved = False
        for a, b in edges:
            m = min(least[a], least[b])
            moved |= least[a] != m or least[b] != m
            least[a] = least[b] = m
        if not moved:
            break
    got = {r.node: r.least for r in links.least_members(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: m for n, m in least.items() if n != m}


def test_components_with_hubs_apart(spark, monkeypatch):
    monkeypatch.setattr(links, "HUB_EDGES", 3)
    monkeypatch.setattr(links, "MOST_HUBS", 1000)
    rng = random.Random(6)
    edges = [(500, i) for i in range(60)] + [(70, i) for i in range(70, 140)] + [(300, 400)] + [(300, i) for i in range(301, 340)]
    edges += [(rng.randint(600, 680), rng.randint(600, 680)) for _ in range(120)] + [(70, 500), (5, 5), (70, 500)]
    want = {}
    for n in {n for e in edges for n in e}:
        seen, due = {n}, [n]
        while due:
            at = due.pop()
            for a, b in edges:
                for x, y in ((a, b), (b, a)):
                    if x == at and y not in seen:
                        seen.add(y)
                        due.append(y)
        if min(seen) != n:
            want[n] = min(seen)
    got = {r.node: r.least for r in links.least_members(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()}
    assert got == want


def test_contained_items(spark, docs_of):
    rng = random.Random(5)
    items = [(i, " ".join(f"W{rng.randint(0, 60)}" for _ in range(rng.randint(3, 60)))) for i in range(25)] + [(90, None), (91, ""), (None, " ".join("abcdefgh")), (3, None)]
    rows = []
    for i in range(40):
        filler = [f"f{rng.randint(0, 1000)}" for _ in range(rng.choice([0, 30, 400]))]
        item = (rng.choice(items[:25])[1]).split()
        for _ in range(rng.choice([0, 1, 2])):
            item[rng.randrange(len(item))] = "zz"
        at = rng.randint(0, len(filler))
        rows.append((i, " ".join(filler[:at] + item + filler[at:])))
    rows += [(100, None), (101, ""), (None, "x " + " ".join("abcdefgh")), (5, rows[5][1]), (102, items[0][1].upper() + " tail" * 20_000)]
    full = lambda t: {tuple(w[i:i + 5]) for w in [(t or "").lower().split()] for i in range(len(w) - 4)}
    want = {(i, j, len(full(t) & full(s)), len(full(s))) for i, t in rows for j, s in items if full(s) and len(full(t) & full(s)) >= 0.8 * len(full(s)) - 1e-9}
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS shingle", "1 AS doc_id")
    got = decontaminate.contained_items(docs_of(rows), table)
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got.collect()} == want and len(want) > 5
    clean = decontaminate.clean_documents(docs_of(rows), table)
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((i for i, _ in rows if i not in {w[0] for w in want}), key=str)
    assert decontaminate.contained_items(docs_of([]), table).count() == 0
    assert decontaminate.clean_documents(docs_of(rows), table.limit(0)).count() == len(rows)


def test_exact_top_k(spark):
    rng = random.Random(9)
    rows = [(i, [rng.randint(-9, 9) for _ in range(4)]) for i in range(300)] + [(300 + i, [9, 9, 9, 9]) for i in range(40)]
    rows += [(None, [1, 2, 3, 4]), (400, None), (401, []), (402, [2**31, -(2**31), 5, 7]), (403, [1, 2]), (404, [3, 1]), (17, [5, 5, 5, 5]), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").selectExpr("*", "1 AS ids", "2 AS score")
    queries = df.filter("vec_id % 5 = 0 OR vec_id IN (402, 404, 401)").withColumnRenamed("vec_id", "query_id")
    plain = {(i, tuple(v)) for i, v in rows if i is not None and v is not None}
    asked = {i: min(v for j, v in plain if j == i) for i in {i for i, _ in plain} if i % 5 == 0 or i in (402, 404, 401)}
    want = set()
    for q, vector in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in plain if i != q and len(v) == len(vector))
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(sorted(set(scores))[:5], 1)}
    for options in ({}, {"block_rows": 16, "query_rows": 8}):
        got = topk.exact_top_k(df, queries, 5, **options).collect()
        assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    assert topk.exact_top_k(df.limit(0), queries, 5).count() == 0
    assert topk.exact_top_k(df, queries.limit(0), 5).count() == 0


def test_usable_vectors(spark):
    rows = [([1.0, 2.0],), ([1.0, None],), ([float("nan")],), ([float("inf"), 0.0],), (None,), ([],), ([-0.001],)]
    df = spark.createDataFrame(rows, "v array<float>")
    got = [(topk_row.ok, topk_row.n) for topk_row in df.select(topk.usable(df.v).alias("ok"), topk.integer_components(df.v).alias("n")).collect()]
    assert [ok for ok, _ in got] == [True, False, False, False, False, True, True]
    assert got[0][1] == [256, 512] and got[6][1] == [-1]
