"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j).  The pairs are never formed: per factor, their sum is half
of (sum v x)^2 - sum (v x)^2, so a text is scored in time linear in its features.  Features are the distinct words of
the whole text, hashed, and its statistics, each as one of a few bins; the only metadata is how the declared number of
characters compares with the real one.  Labels, lang, source and doc_id are no features.

The model is fitted on labelled rows, one per id, at most `sample_rows` of them and with at most `sample_ids` features in
all (those with the least hash of the id, so the choice is the same in every run); everything else reads all rows.  Its size is fixed by the settings, so it may go to every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import stored

BINS = 32
STATISTICS = 20
KEEP_FROM = 0.3
#: Most labelled rows that the model is fitted on.
SAMPLE_ROWS = 20_000
#: Most features of these rows together, 4 bytes each on the driver.
SAMPLE_IDS = 16_000_000


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    factors: int = 8
    epochs: int = 4
    steps: int = 1200  # at least; few rows are passed over more often
    batch: int = 64
    rate: float = 0.08
    decay: float = 1e-5
    sample_rows: int = SAMPLE_ROWS
    sample_ids: int = SAMPLE_IDS
    seed: int = 3

    @property
    def size(self) -> int:
        return STATISTICS * BINS + self.buckets


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, ids: np.ndarray, values: np.ndarray) -> float:
        scaled = self.factors[ids] * values[:, None]
        pairs = (scaled.sum(axis=0) ** 2 - (scaled ** 2).sum(axis=0)).sum() / 2
        return float(self.bias + self.weights[ids] @ values + pairs)

    def score(self, ids: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(ids, values), -30, 30))))


class _Buckets(dict):
    """Bucket of each word seen, bounded by starting anew."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = STATISTICS * BINS + xxhash.xxh3_64_intdigest(word) % self.buckets
        return value


def statistics(text: bytes, tokens: list[bytes], declared: int | None, characters: int) -> np.ndarray:
    """Structure of a text: shares from 0 to 1, and sizes on a logarithmic scale; all 0 without words."""
    if not tokens:
        return np.zeros(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n = len(text), len(tokens)
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    space = counts[32] + counts[9:14].sum()
    marks = counts[33:127].sum() - upper - lower - digit
    common = Counter(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    triples = len(set(zip(tokens, tokens[1:], tokens[2:]))) / max(1, n - 2)
    lines = [x for x in text.split(b"\n") if x.strip()]
    most_mark = max(counts[33:48].max(), counts[58:65].max(), counts[91:97].max(), counts[123:127].max())
    letters = max(1, upper + lower)
    declared = characters if declared is None else declared
    return np.array([
        np.log2(n + 1) / 24, np.log2(size + 1) / 28, min(1, lengths.mean() / 24), (lengths > 20).mean(), (lengths < 3).mean(),
        len(common) / n, max(common.values()) / n, triples, upper / letters, digit / size,
        marks / size, (size - counts[:128].sum()) / size, space / size, counts[46] / n, counts[44] / n,
        most_mark / size, len(set(lines)) / max(1, len(lines)), np.log2(len(lines) + 1) / 20,
        (counts[:9].sum() + counts[14:32].sum() + counts[127]) / size, min(1, abs(declared - characters) / (characters + 1))])


def features(text: str | None, declared: int | None, buckets: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids and values: one id per statistic (its bin), and the distinct hashed words, scaled to length one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    bins = np.minimum((np.sqrt(np.clip(statistics(raw, tokens, declared, len(text)), 0, 1)) * BINS).astype(np.int64), BINS - 1)
    hashed = np.unique(np.fromiter(map(buckets.__getitem__, set(tokens)), np.int64))
    ids = np.concatenate((np.arange(STATISTICS) * BINS + bins, hashed)).astype(np.int32)
    return ids, values_for(len(ids))


def values_for(count: int) -> np.ndarray:
    """Values of a text with so many features: half for a statistic, the words scaled to length one."""
    hashed = count - STATISTICS
    return np.concatenate((np.full(STATISTICS, 0.5), np.full(hashed, 1 / np.sqrt(max(1, hashed))))).astype(np.float32)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings = Settings()) -> Machine:
    """Fit on (label, ids, values) by AdaGrad on the logistic loss.  Without rows every score is one half."""
    random = np.random.default_rng(settings.seed)
    weights = np.zeros(settings.size, np.float32)
    factors = (random.standard_normal((settings.size, settings.factors)) * 0.02).astype(np.float32) if rows else np.zeros((settings.size, settings.factors), np.float32)
    share = sum(label for label, _, _ in rows) / len(rows) if rows else 0.5
    bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    past_w, past_v, past_b = np.full(settings.size, 1e-4, np.float32), np.full(factors.shape, 1e-4, np.float32), 1e-4
    batches = -(-len(rows) // settings.batch)
    for _ in range(max(settings.epochs, -(-settings.steps // batches)) if rows else 0):
        order = random.permutation(len(rows))
        for start in range(0, len(order), settings.batch):
            part = [rows[i] for i in order[start:start + settings.batch]]
            labels = np.array([label for label, _, _ in part], np.float32)
            ids, values = np.concatenate([i for _, i, _ in part]), np.concatenate([v for _, _, v in part])
            bounds = np.concatenate(([0], np.cumsum([len(i) for _, i, _ in part])))
            owner = np.repeat(np.arange(len(part)), np.diff(bounds))
            scaled = factors[ids] * values[:, None]
            sums = np.add.reduceat(scaled, bounds[:-1])
            pairs = (sums ** 2).sum(axis=1) - np.add.reduceat((scaled ** 2).sum(axis=1), bounds[:-1])
            margin = bias + np.add.reduceat(weights[ids] * values, bounds[:-1]) + pairs / 2
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / len(part)
            touched, place = np.unique(ids, return_inverse=True)
            pull = error[owner] * values
            step_w = np.bincount(place, weights=pull, minlength=len(touched)).astype(np.float32) + settings.decay * weights[touched]
            each = pull[:, None] * (sums[owner] - scaled)
            sort = np.argsort(place, kind="stable")
            edge = np.flatnonzero(np.diff(place[sort], prepend=-1))
            step_v = np.add.reduceat(each[sort], edge) + settings.decay * factors[touched]
            past_w[touched] += step_w ** 2
            past_v[touched] += step_v ** 2
            weights[touched] -= settings.rate * step_w / np.sqrt(past_w[touched])
            factors[touched] -= settings.rate / 4 * step_v / np.sqrt(past_v[touched])
            past_b += float(error.sum()) ** 2
            bias -= settings.rate * float(error.sum()) / past_b ** 0.5
    return Machine(bias, weights, factors)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _rows(docs: DataFrame) -> DataFrame:
    declared = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", "text", declared.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Machine:
    """Fit on `labels` (doc_id, quality 0 or 1) of rows that are not held out.

    Labels that are null or neither 0 nor 1 are left out, of several labels of an id the least counts; of several rows of an
    id the one whose features have the least hash, so neither copies nor the order of the rows change the model.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    # the features of bounded many rows: the join goes by the id, then the least hashes are taken
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows)
    rows = _rows(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "n_chars", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, least = _Buckets(settings.buckets), {}
        for batch in batches:
            kept, found, marks = [], [], []
            for i, r in enumerate(batch.to_pylist()):
                ids = features(r["text"], r["n_chars"], buckets)[0]
                mark = xxhash.xxh3_64_intdigest(ids.tobytes()) >> 1
                if mark < least.get(r["doc_id"], 1 << 63):  # of the rows of an id only the least one counts
                    least[r["doc_id"]] = mark
                    kept.append(i)
                    found.append(ids)
                    marks.append(mark)
            batch = batch.take(pa.array(kept, pa.int32()))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "mark": pa.array(marks, pa.int64()),
                                   "ids": pa.array(found, pa.list_(pa.int32()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, quality int, mark long, ids array<int>")
    made = stored(made.groupBy("doc_id", "quality").agg(F.min_by("ids", "mark").alias("ids")))
    # a running sum over narrow rows, `sample_rows` of them at most
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    fits = made.select("doc_id", F.sum(F.size("ids")).over(order).alias("upto")).filter(F.col("upto") <= settings.sample_ids)
    table = made.join(F.broadcast(fits.select("doc_id")), "doc_id").toArrow()
    # views of the collected arrays, and one array of values per number of features: the sample is held once
    shared: dict[int, np.ndarray] = {}
    whole = []
    for chunk in table.to_batches():
        for doc, label, ids in zip(chunk.column("doc_id").to_pylist(), chunk.column("quality").to_pylist(), chunk.column("ids")):
            ids = ids.values.to_numpy()
            if len(ids) not in shared:
                shared[len(ids)] = values_for(len(ids))
            whole.append((str(doc), (label, ids, shared[len(ids)])))
    whole.sort(key=lambda row: row[0])
    return fit([row for _, row in whole], settings)


def scored(docs: DataFrame, machine: Machine, settings: Settings = Settings()) -> DataFrame:
    """Per row of `docs` (doc_id, text, n_chars if there): doc_id, fp, held_out, score, predicted.

    Null texts count as empty; an empty text is scored by its statistics alone.  A null n_chars counts as the real one.
    Null ids are kept and held out; repeated rows get equal answers; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, buckets = Machine(*model.value), _Buckets(settings.buckets)
        for batch in batches:
            declared = batch.column("n_chars").to_pylist()
            scores = [own.score(*features(t.as_py(), d, buckets)) for t, d in zip(batch.column("text"), declared)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": batch.column("fp"), "score": pa.array(scores, pa.float64())})

    rows = _rows(docs).withColumn("fp", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, fp long, score double")
    return out.select("doc_id", "fp", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs`, all columns, that the classifier does not reject."""
    machine = train(docs, labels, settings)
    model = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, buckets = Machine(*model.value), _Buckets(settings.buckets)
        for batch in batches:
            declared = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else [None] * batch.num_rows
            keep = [own.score(*features(t.as_py(), d, buckets)) >= KEEP_FROM for t, d in zip(batch.column("text"), declared)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
