"""Vector code compression: vectors as one codebook number per part, with codebooks refined over a trie of distinct parts.

Vectors are cut into equal parts.  The distinct parts of each position, with their weights, are sorted; a sorted list of
equal-length sequences is a trie whose nodes are runs with a common prefix.  The walk keeps, per depth, the vector of
squared distances to all codebook entries summed over the dimensions so far, so parts with a common prefix share that work;
where one leaf is left below a node, the rest of its dimensions is one edge.  A leaf takes the least entry and adds its weight
and weighted components to that entry.  Leaves are taken in strips, depth first, and numpy handles one depth of a strip at a
time, which bounds the distance vectors held at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import meet_counted, stored

PARTS, ENTRIES, ROUNDS = 4, 256, 4
STRIP = 1024
MOST = 2**63 - 1


class Trie:
    """Walks sorted parts against one codebook (entries x width)."""

    def __init__(self, book: np.ndarray, strip: int = STRIP):
        self.book, self.strip = book, strip
        self.columns = np.ascontiguousarray(book.T)
        squares = self.columns * self.columns
        #: squared length of the entries from each depth on
        self.squares = np.cumsum(squares[::-1], axis=0)[::-1]

    def walk(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least entry of each leaf and its squared distance."""
        entries, errors = np.zeros(len(leaves), np.int64), np.zeros(len(leaves), leaves.dtype)
        for start in range(0, len(leaves), self.strip):
            part = slice(start, start + self.strip)
            self._strip(leaves[part], entries[part], errors[part])
        return entries, errors

    def _strip(self, leaves: np.ndarray, entries: np.ndarray, errors: np.ndarray) -> None:
        width = leaves.shape[1]
        open_ = np.arange(len(leaves))  # leaves below nodes with several of them
        node = np.zeros(len(leaves), np.int64)
        sums = np.zeros((1, len(self.book)), self.book.dtype)  # distances of the nodes so far, per entry
        for depth in range(width):
            here = leaves[open_, depth]
            fresh = np.ones(len(open_), bool)
            fresh[1:] = (node[1:] != node[:-1]) | (here[1:] != here[:-1])
            heads = np.flatnonzero(fresh)
            step = here[heads, None] - self.columns[depth]
            step *= step
            step += sums[node[heads]]
            sums, node = step, np.cumsum(fresh) - 1
            single = np.diff(heads, append=len(open_)) == 1
            if depth == width - 1 or single.all():
                done, rows = slice(None), open_ if depth == width - 1 else open_[heads]
            else:
                done, rows = single, open_[heads[single]]
            if len(rows):
                found = sums[done][node] if depth == width - 1 else sums[done] + self._edge(leaves[rows, depth + 1:], depth + 1)
                best = found.argmin(axis=1)
                entries[rows], errors[rows] = best, found[np.arange(len(rows)), best]
            if depth == width - 1 or single.all():
                return
            left = ~single[node]
            open_, node = open_[left], (np.cumsum(~single) - 1)[node[left]]
            sums = sums[~single]

    def _edge(self, tails: np.ndarray, depth: int) -> np.ndarray:
        """Distances over the depths from `depth` on, where a node has one leaf left: one edge instead of a node per depth."""
        crossed = tails @ self.columns[depth:]
        return (tails * tails).sum(axis=1)[:, None] - 2 * crossed + self.squares[depth]


def _exact(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest numbers in which every sum of squares is exact: double, 64-bit integers, or Python's."""
    most = max(int(leaves.max(initial=0)), int(book.max(initial=0)), -int(leaves.min(initial=0)), -int(book.min(initial=0)))
    bound = 4 * most * most * max(1, leaves.shape[1])
    kind = np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object
    return leaves.astype(kind), book.astype(kind)


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


SUMS = "position int, entry int, n long, total array<decimal(38,0)>"


def _entry_sums(books: list[np.ndarray], strip: int):
    """Per task, position and entry: weight and weighted sum of the parts that are nearest to the entry."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros(book.shape, object) for book in books]
        for batch in batches:
            positions, leaves = batch.column("position").to_numpy(), _rows(batch.column("part"), width)
            counts = batch.column("weight").to_numpy()
            for position in np.unique(positions):
                mine = positions == position
                own, book = _exact(leaves[mine], books[position])
                entry, _ = Trie(book, strip).walk(own)
                weight, part = counts[mine], leaves[mine]
                most = max(int(part.max(initial=0)), -int(part.min(initial=0)), 1)
                if most * int(weight.sum()) >= 2**63:  # products and sums in Python's integers
                    part, weight = part.astype(object), weight.astype(object)
                order = np.argsort(entry, kind="stable")
                edge = np.flatnonzero(np.diff(entry[order], prepend=-1))
                met = entry[order][edge]
                weights[position][met] += np.add.reduceat(weight[order], edge).astype(np.int64)
                totals[position][met] += np.add.reduceat(part[order] * weight[order][:, None], edge, axis=0).astype(object)
        for position, weight in enumerate(weights):
            met = np.flatnonzero(weight)
            yield pa.record_batch({
                "position": pa.array([position] * len(met), pa.int32()), "entry": pa.array(met, pa.int32()), "n": pa.array(weight[met], pa.int64()),
                "total": pa.array([list(totals[position][e]) for e in met], pa.list_(pa.decimal128(38, 0)))})

    return run


def _coded(books: list[np.ndarray], strip: int):
    """Codes and errors of whole vectors; the parts of a batch are walked as one trie per position."""
    width, parts = books[0].shape[1], len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _rows(batch.column("padded"), width * parts)
            digits, errors = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), object)
            for position, book in enumerate(books):
                leaves, place = np.unique(vectors[:, position * width:(position + 1) * width], axis=0, return_inverse=True)
                place = place.reshape(-1)
                own, book = _exact(leaves, book)
                entries, distances = Trie(book, strip).walk(own)
                digits[:, position] = entries[place]
                errors += (distances if distances.dtype == object else distances.astype(np.int64)).astype(object)[place]
            codes = digits.tobytes().hex()
            yield pa.record_batch({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "code": pa.array([codes[i:i + 2 * parts] for i in range(0, len(codes), 2 * parts)], pa.string()),
                "error": pa.array([min(e, MOST) for e in errors], pa.int64())})

    return run


def listed(books: list[np.ndarray]) -> str:
    """All components in decimal, by part, entry and position within the part."""
    return ",".join(str(int(x)) for book in books for x in book.ravel())


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, strip: int = STRIP) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of `vectors` (vec_id, label, vector array<long>) and the final codebooks, one matrix per part.

    The codes: vec_id, label, code (two hex digits per part), error (squared distance summed over the parts) and label_error
    (error summed over the rows with an equal label, nulls together).  A codebook starts as that part of the rows with the
    least vec_ids (nulls last, then by vector); fewer rows give fewer entries.  Equal distances go to the lower entry; an
    entry without parts stays.  Null vectors are left out, null elements are not allowed.  Shorter vectors, and lengths that
    the number of parts does not divide, are filled up with zeros.  Repeated rows count and come back as often as they occur;
    other columns are ignored; no rows give no rows and empty codebooks.  Errors beyond a long stop at its end.

    The codebooks have at most `entries` (256 at most) x vector length numbers, so every task and the driver may hold them.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits number 256 entries")
    rows = vectors.select("vec_id", "label", "vector").filter("vector IS NOT NULL")
    longest = rows.agg(F.max(F.size("vector"))).head()[0]
    if longest is None:
        none = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return none.limit(0), []
    width = max(1, -(-longest // parts))
    zero = F.array_repeat(F.lit(0).cast("long"), F.lit(width * parts) - F.size("vector"))
    rows = rows.select("vec_id", "label", F.concat(F.col("vector").cast("array<long>"), zero).alias("padded"))
    heads = rows.orderBy(F.asc_nulls_last("vec_id"), "padded").limit(entries).select("padded").collect()
    start = np.array([row.padded for row in heads], object)
    books = [start[:, i * width:(i + 1) * width] for i in range(parts)]
    pieces = F.array(*[F.slice("padded", i * width + 1, width) for i in range(parts)])
    distinct = rows.select(F.posexplode(pieces).alias("position", "part")).groupBy("position", "part").agg(F.count("*").alias("weight"))
    distinct = stored(distinct.repartitionByRange("position", "part").sortWithinPartitions("position", "part"))
    for _ in range(rounds):
        sums = distinct.mapInArrow(_entry_sums(books, strip), SUMS).groupBy("position", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)])
        books = [book.copy() for book in books]
        for row in sums.collect():  # one row per part and entry
            books[row.position][row.entry] = [int(row[f"t{i}"]) // row.n for i in range(width)]
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    coded = stored(rows.mapInArrow(_coded(books, strip), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"))
    per_label = stored(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("e"), F.count("*").alias("copies")))
    per_label = per_label.select("label", F.least("e", F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"), "copies")
    return meet_counted(coded, per_label, "label", count="copies").select("vec_id", "label", "code", "error", "label_error"), books


def fingerprint(books: list[np.ndarray]) -> str:
    return hashlib.sha256(listed(books).encode()).hexdigest()
