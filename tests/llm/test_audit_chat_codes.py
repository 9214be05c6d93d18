"""The filter audit, chat packs and vector codes against brute-force versions."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from feedloom.llm import chat, codes, interactions
from feedloom.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit ---------------------------------------------------------------------------------

def fails_of(rows):
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        out.append("".join(name for name, bad in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)), ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)),
            ("D", re.search(r"[#$%&*|]", text)), ("E", i is not None and i > least[text])) if bad))
    return out


def audited(rows, labels, parts):
    """Every order applied to every document, one step after the other."""
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    fails, out = fails_of(rows), {}
    for part in set(parts):
        mine = [(rows[j][0], fails[j]) for j in range(len(rows)) if parts[j] == part]
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(range(len(mine)))
            for step, name in enumerate(order, 1):
                removed = [j for j in left if name in mine[j][1]]
                left = [j for j in left if name not in mine[j][1]]
                total[name] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(name in f for _, f in mine) - len(removed), sum(f == name for _, f in mine),
                    sum(mine[j][0] in good for j in removed), sum(mine[j][0] in toxic for j in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {key: tuple(row) for key, row in out.items()}


def audit_rows():
    rng, rows = random.Random(4), []
    for i in range(120):
        words = [rng.choice(["aa", "b#", "Cc", "dd", "éé"]) + str(rng.randint(0, rng.choice([5, 500]))) for _ in range(rng.choice([0, 3, 210, 300]))]
        rows.append((i, " ".join(words)))
    copy = " ".join(f"w{i}" for i in range(250))
    rows += [(200 + i, copy) for i in range(60)] + [(3, rows[3][1]), (3, "other"), (None, copy), (None, copy), (500, None), (501, ""), (502, "x" * 300_000), (199, "A" * 50)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 260, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (200, 1, 1)]
    return rows, labels


def test_audit(spark, docs_of):
    rows, labels = audit_rows()
    docs = docs_of(rows).selectExpr("* EXCEPT (lang, source)", "CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN doc_id % 3 = 1 THEN 'de' END AS lang", "'x' AS part", "1 AS mask").repartition(7)
    parts = ["" if i is None or i % 3 == 2 else ["en", "de"][i % 3] for i, _ in rows]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text")
    got = interactions.audit(docs, marks).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert found == audited(rows, labels, parts) and len(got) == 600 * len(set(parts))
    assert interactions.audit(docs.limit(0), marks).count() == 0
    assert {r.good_lost for r in interactions.audit(docs, marks.limit(0)).collect()} == {0}


def test_audit_hands_on_many_parts(spark, docs_of, monkeypatch):
    rows, labels = audit_rows()
    monkeypatch.setattr(interactions, "CONDITIONS", {"A": interactions.CONDITIONS["A"]})
    docs = docs_of(rows).selectExpr("doc_id", "text", "concat('p', doc_id) AS own")
    got = interactions.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), part="own").collect()
    parts = {"" if i is None else f"p{i}" for i, _ in rows}
    assert len(parts) * 2 * 2 == len(got) and {r.part for r in got} == parts
    with pytest.raises(ValueError):
        interactions.audit(docs, docs, conditions=dict.fromkeys("ABCDEFG", interactions.CONDITIONS["A"]))


def test_wide_fields_do_not_run_over():
    wide = interactions.wide_integers(2)
    total = sum((2**62) * wide[mask] for mask in (1, 1, 1))  # fields hold more than a signed long
    data = np.frombuffer(total.to_bytes(2 * 2 * 5 * 8, "little"), "<u8").reshape(2, 2, 5)
    assert data[0, 0].tolist() == [0, 3 * 2**62, 0, 0, 0] and data[1, 0].tolist() == [3 * 2**62, 0, 0, 0, 0]


# --- chat packs --------------------------------------------------------------------------------------

MARKED = "</s>[INST] ok [/INST]"


def chat_rows():
    rng = random.Random(8)
    said = ["hi", "", MARKED, "\\", "a\\[INST]\\", "[[INST]<s", "ß😀\n", "x " * 400, "[ROLE]"]
    roles = ["user", "assistant", "system", "tool", "[/ROLE]", "", None]
    rows = []
    for c in range(60):
        shared = rng.randint(0, 3)
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "user" if t < shared else rng.choice(roles), "the same" if t < shared else rng.choice(said)))
    rows += [(100 + c, t, ["user", "assistant"][t % 2], f"copy {t}") for c in range(40) for t in range(4)]
    rows += [(200, t, "assistant", "y" * (t % 3)) for t in range(300)] + [(201, t, "assistant", "y" * (t % 3)) for t in range(150)]
    rows += [(300, None, "user", "first"), (300, 0, "user", None), (None, 0, "user", "alone"), (301, 0, "assistant", "twice"), (301, 0, "assistant", "twice"), (302, 0, None, None)]
    rows += [(303, 0, "assistant", "z" * 300_000), (303, 1, "user", " " * 200_000)]
    return rows


def chats_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS pack", "2 AS cid", "3 AS key", "4 AS path", "5 AS depth", "6 AS n").repartition(5)


def digests(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append(((t is not None, t), role or "", text or ""))
    out = {}
    for c, listed in turns.items():
        listed.sort()
        loss = "".join(text for _, role, text in listed if role == "assistant")
        chars = sum(len(chat.escaped(text)) + sum(map(len, chat.ROLES[role])) if role in chat.ROLES else len(chat.escaped(text)) + len(chat.escaped(role)) + 20 for _, role, text in listed)
        whole = "".join(f"{role}\n{text}\n" for _, role, text in listed)
        out[c] = (len(listed), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


@pytest.mark.parametrize("pack_chars", [1, 500, chat.PACK_CHARS])
def test_chat_packs_read_back(spark, pack_chars):
    rows = chat_rows()
    members, nodes = chat.pack(chats_of(spark, rows), pack_chars=pack_chars)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(members, nodes).collect()}
    assert got == digests(rows)
    check_packs(nodes.collect(), rows, once=pack_chars == chat.PACK_CHARS)


def check_packs(nodes, rows, once):
    """Places, positions and intervals, and that every different turn of the tree counts once."""
    packs = collections.defaultdict(list)
    for node in nodes:
        packs[node.pack].append(node)
    counted = collections.Counter()
    for listed in packs.values():
        at, path = 0, []
        for node in sorted(listed, key=lambda n: n.start):
            assert node.start == at and node.length == len(node.ids)
            at += node.length
            del path[node.depth:]
            joined = []
            for one in path:
                if joined and joined[-1][1] == one.start:
                    joined[-1][1] = one.start + one.length
                else:
                    joined.append([one.start, one.start + one.length])
            assert [[a.start, a.end] for a in node.ancestors] == joined and node.position == sum(one.length for one in path)
            path.append(node)
            counted[tuple(tuple(one.ids) for one in path)] += not node.repeated
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append(((t is not None, t), role or "", text or ""))
    tree = {tuple(x[1:] for x in sorted(listed)[:n]) for listed in turns.values() for n in range(1, len(listed) + 1)}
    assert set(counted.values()) == {1} and len(counted) == len(tree)
    if once:
        assert sum(not node.repeated for node in nodes) == len(tree)


def test_training_arrays(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "one two"), (2, 0, "user", "q"), (2, 1, "assistant", "three")]
    _, nodes = chat.pack(chats_of(spark, rows))
    got = sorted(chat.training_arrays(nodes).collect(), key=lambda r: (r.pack, r.start))
    assert len({r.start for r in got}) == 3 and [r.positions[0] for r in got] == [0, 3, 3]
    assert [sum(r.counted) for r in got if len(r.ids) > 3] and not any(any(r.counted) for r in got if r.positions[0] == 0)
    codec = chat.Codec()
    said = [codec.text(np.array([i for i, c in zip(r.ids, r.counted) if c])) for r in got]
    assert sorted(said) == ["", "one two", "three"]


def test_marks_are_escaped_reversibly():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["\\", "[", "]", "<", ">", "/", "s", "INST", "[INST]", "</s>", "ROLE", "é"]) for _ in range(rng.randint(0, 9)))
        clean = chat.escaped(text)
        assert chat.unescaped(clean) == text and not any(mark in clean for mark in chat.MARKS)


def test_no_chats(spark):
    members, nodes = chat.pack(chats_of(spark, [(1, 0, "user", "x")]).limit(0))
    assert members.count() == 0 and nodes.count() == 0 and chat.read_back(members, nodes).count() == 0


# --- vector codes -----------------------------------------------------------------------------------------

def lloyd(rows, parts, entries, rounds):
    rows = [(i, label, v) for i, label, v in rows if v is not None]
    width = max(1, -(-max(len(v) for _, _, v in rows) // parts))
    padded = [[*v, *[0] * (width * parts - len(v))] for _, _, v in rows]
    first = sorted(range(len(rows)), key=lambda j: (rows[j][0] is None, rows[j][0] or 0, padded[j]))[:entries]
    cut = lambda v, p: tuple(v[p * width:(p + 1) * width])
    books = [[cut(padded[j], p) for j in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            met = collections.defaultdict(list)
            for v in padded:
                met[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [tuple(sum(c) // len(met[n]) for c in zip(*met[n])) if n in met else e for n, e in enumerate(books[p])]
    found = [[near(cut(v, p), books[p]) for p in range(parts)] for v in padded]
    errors = [sum(d for d, _ in f) for f in found]
    label_error = collections.Counter()
    for (_, label, _), e in zip(rows, errors):
        label_error[label] += e
    return sorted(((i, label, "".join(f"{n:02x}" for _, n in f), e, label_error[label]) for (i, label, _), f, e in zip(rows, found, errors)), key=str), books


@pytest.mark.parametrize("strip", [3, codes.STRIP])
def test_codes(spark, strip):
    rng = random.Random(6)
    rows = [(i, rng.choice([1, 2, None]), [rng.randint(-3, 3) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, 2, [5] * 8) for i in range(70)] + [(7, 1, [1, 2]), (None, 1, [3] * 8), (None, 1, [3] * 8), (300, None, None), (301, 1, []), (302, 2, [1] * 5), (7, 1, [1, 2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").selectExpr("*", "1 AS position", "2 AS part", "3 AS copies", "4 AS e").repartition(6)
    for options in ({"parts": 4, "entries": 9, "rounds": 4}, {"parts": 3, "entries": 256, "rounds": 2}):
        coded, books = codes.compress(df, **options, strip=strip)
        want, listed = lloyd(rows, **options)
        assert sorted((tuple(r) for r in coded.collect()), key=str) == want
        assert codes.listed(books) == ",".join(str(x) for book in listed for e in book for x in e)
    none, books = codes.compress(df.limit(0))
    assert none.count() == 0 and codes.listed(books) == "" and none.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_codes_of_huge_components(spark):
    rows = [(i, i, [(-1) ** i * i * 2**29, 2**30 + i]) for i in range(12)]
    coded, _ = codes.compress(spark.createDataFrame(rows, "vec_id long, label int, vector array<long>"), parts=2, entries=4, rounds=3)
    assert sorted((tuple(r) for r in coded.collect()), key=str) == lloyd(rows, 2, 4, 3)[0]
    far = spark.createDataFrame([(1, 1, [2**62, 0]), (2, 1, [-2**62, 0])], "vec_id long, label int, vector array<long>")
    coded, _ = codes.compress(far, parts=1, entries=1, rounds=1)
    assert {r.error for r in coded.collect()} == {2**63 - 1}


def test_trie_walk():
    rng = np.random.default_rng(3)
    for values, kind in ((3, np.float64), (2, np.int64), (50, object)):
        leaves = np.unique(rng.integers(0, values, (500, 6)), axis=0)
        book = rng.integers(0, values, (20, 6))
        want = ((leaves[:, None] - book[None]) ** 2).sum(-1)
        for strip in (1, 7, 1000):
            entries, errors = codes.Trie(book.astype(kind), strip).walk(leaves.astype(kind))
            assert (entries == want.argmin(axis=1)).all() and (errors == want.min(axis=1)).all()


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_chat_packs", "op13_filter_audit"])
def test_registered_queries_agree_with_sql(spark, sf, name):
    from checks.compare import compare, duck

    ok, line = compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)
    assert ok, line
