"""Secret scans: fixed patterns, and windows of high Shannon entropy in strings of key-like characters.

Patterns give the kinds assign, access and hex.  The entropy scan looks at candidate strings (runs of key characters) and
at the runs of each character class in them: hex, base32, base36 and base64.  A window slides over each run; the entropy
follows from counts that change by one character in and one out.  Windows at or above the threshold of their class are
joined to spans of kind entropy, unless an allow-list entry covers them.  Keys hold a digit and a letter, of either case.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# The patterns of the base kinds, in the order that breaks ties.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{20,}")
BASE32_RUN = re.compile(r"[A-Z2-7]{20,}")
BASE36_RUN = re.compile(r"[a-z0-9]{20,}|[A-Z0-9]{20,}")


@dataclass(frozen=True)
class EntropyRules:
    """Window length, thresholds in bits per character, and patterns of strings that are no secrets."""

    window: int = 20
    hex_bits: float = 3.0
    base32_bits: float = 3.4
    base36_bits: float = 3.4
    base64_bits: float = 3.75
    allowed: tuple[str, ...] = (  # each starts only where a run starts, so that it takes time linear in the text
        r"(?i)(?<![a-z])[a-z]++://(?![^\x20\x09-\x0D/?#]*@)[^\x20\x09-\x0D?#]*",  # addresses up to the query, without a login
        r"(?<![A-Za-z0-9+/_=-])[/_=+-]*(?:[A-Za-z]+|[A-Z]?[a-z]+[0-9]{1,2}|[0-9]+)(?:[/_=+-]+(?:[A-Z]?[a-z]+[0-9]{1,2}|[A-Za-z]+|[0-9]+))+[/_=+-]*(?![A-Za-z0-9+/_=-])",  # words and numbers with separators
        r"(?i)\b[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\b",  # identifiers in UUID form
        r"(?i)(?<![a-z0-9+/_=-])(?=[a-z0-9+/_=-]*?(?:[a-z0-9]example|example[a-z0-9]))[a-z0-9+/_=-]+",  # marked keys; the word alone marks nothing
        r"(?i)abcdefghijklmnopqrstuvwxyz(?:0123456789)?|0123456789abcdef(?:ghijklmnopqrstuvwxyz)?",  # alphabets
    )


def entropy_windows(text: str, size: int) -> Iterator[tuple[int, float]]:
    """Start and entropy of every window of `size` characters, from counts updated in place."""
    if len(text) < size:
        return
    term = [0.0] + [c * math.log2(c) for c in range(1, size + 2)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, char in enumerate(text):
        n = counts.get(char, 0)
        counts[char] = n + 1
        total += term[n + 1] - term[n]
        if i >= size:
            n = counts[text[i - size]]
            counts[text[i - size]] = n - 1
            total += term[n - 1] - term[n]
        if i >= size - 1:
            yield i - size + 1, math.log2(size) - total / size


def _mixes(text: str) -> bool:
    return any("0" <= c <= "9" for c in text) and any("a" <= c <= "z" or "A" <= c <= "Z" for c in text)


def _joined(spans: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def entropy_spans(text: str, rules: EntropyRules = EntropyRules()) -> list[tuple[int, int]]:
    """Joined spans of windows that look random."""
    found: list[tuple[int, int]] = []
    classes = ((HEX_RUN, rules.hex_bits), (BASE32_RUN, rules.base32_bits), (BASE36_RUN, rules.base36_bits))
    for candidate in CANDIDATE.finditer(text):
        at, whole = candidate.start(), candidate.group()
        if not _mixes(whole):
            continue
        for i, value in entropy_windows(whole, rules.window):
            if value >= rules.base64_bits - 1e-9 and _mixes(whole[i:i + rules.window]):
                found.append((at + i, at + i + rules.window))
        for pattern, bits in classes:  # runs without separators: the whole run mixes
            for run in pattern.finditer(whole):
                if _mixes(run.group()):
                    start = at + run.start()
                    found += [(start + i, start + i + rules.window) for i, value in entropy_windows(run.group(), rules.window) if value >= bits - 1e-9]
    if not found:
        return []
    allowed = _joined(m.span() for pattern in rules.allowed for m in re.finditer(pattern, text) if m.end() > m.start())
    starts = [start for start, _ in allowed]
    before = lambda a: bisect_right(starts, a) - 1  # noqa: E731  the last allowed span that starts at `a` or earlier
    return [(a, b) for a, b in _joined(found) if (i := before(a)) < 0 or allowed[i][1] < b]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    spans: list[tuple[int, int, int]] = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def all_spans(text: str, rules: EntropyRules = EntropyRules()) -> list[tuple[int, int, int]]:
    return sorted(base_spans(text) + [(a, 3, b) for a, b in entropy_spans(text, rules)])


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span, overlaps joined, replaced by a mark."""
    out, at = [], 0
    for start, end in _joined((a, b) for a, _, b in spans):
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, rules: EntropyRules = EntropyRules()) -> DataFrame:
    """Find secrets in every text; one row per row of `docs`.

    doc_id; spans array of (kind, start, end) in code points, end exclusive, by start and kind; text, with secrets replaced.
    A null text counts as empty and stays null.  Null ids and repeated rows are kept as they are; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, clean = batch.column(0), [], []
            for value in batch.column(1):
                text = value.as_py()
                spans = all_spans(text or "", rules)
                found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
                clean.append(redacted(text, spans) if spans else text)
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch({"doc_id": ids, "spans": pa.array(found, kinds), "text": pa.array(clean, pa.string())})

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:long,end:long>>, text string")


def without_secrets(docs: DataFrame, rules: EntropyRules = EntropyRules()) -> DataFrame:
    """All rows and columns of `docs`, with the secrets in `text` replaced and n_chars, if there, brought in line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column("text").to_pylist()
            clean = [text and (redacted(text, spans) if (spans := all_spans(text, rules)) else text) for text in texts]
            columns = batch.columns
            columns[names.index("text")] = pa.array(clean, batch.schema.field("text").type)
            if "n_chars" in names:
                sizes = [n if a == b else len(b) for n, a, b in zip(batch.column("n_chars").to_pylist(), texts, clean)]
                columns[names.index("n_chars")] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
