"""Token counts from flat files: a separator scan.

A token file holds the ids of its documents end to end, each followed by an end-of-document id, and nothing else: no index.
Files are read in blocks of fixed size.  A block finds its separators with one vectorised comparison, and reports the
tokens before the first and after the last one.  Documents that cross blocks are stitched by a prefix scan over a file's
block reports, so a document may span any number of blocks.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import stored
from feedloom.llm.files import opened
from feedloom.session import shared_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of that vocabulary: how text is split before merging, and its free id.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
BLOCK_TOKENS = 1 << 20
TYPE = "<u2"


def encoder(vocabulary: str):
    """Byte-pair encoding from a file of ranks."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, folder: str | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokenise `docs` (doc_id, text) to flat files, one per task; what each file holds: path, ordinal, doc_id.

    A null text has no tokens.  A file of a failed attempt is in no row of the result, which is stored.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name, out, ordinal, encode = f"{uuid.uuid4().hex}.tokens", None, 0, None
        for batch in batches:
            encode = encode or encoder(vocabulary).encode_ordinary
            out = out or system.open_output_stream(f"{path}/{name}")
            for text in batch.column(1):
                ids = np.array([*encode(text.as_py() or ""), END], TYPE)
                out.write(ids.tobytes())
            yield pa.record_batch({"path": pa.array([f"{folder}/{name}"] * batch.num_rows), "ordinal": pa.array(np.arange(ordinal, ordinal + batch.num_rows)),
                                   "doc_id": batch.column(0)})
            ordinal += batch.num_rows
        if out:
            out.close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(run, f"path string, ordinal long, doc_id {kind}"))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for address in batch.column(0).to_pylist():
            system, path = opened(address)
            sizes.append(system.get_file_info(path).size // np.dtype(TYPE).itemsize)
        yield pa.record_batch({"path": batch.column(0), "tokens": pa.array(sizes, pa.int64())})


def _scan(block_tokens: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = opened(address)
                width = np.dtype(TYPE).itemsize
                with system.open_input_file(path) as file:
                    file.seek(block * block_tokens * width)
                    ids = np.frombuffer(file.read(block_tokens * width), TYPE)
                at = np.flatnonzero(ids == end)
                yield pa.record_batch({
                    "path": pa.array([address]), "block": pa.array([block], pa.int64()), "ends": pa.array([len(at)], pa.int64()),
                    "head": pa.array([at[0] if len(at) else None], pa.int64()), "tail": pa.array([len(ids) - (at[-1] + 1 if len(at) else 0)], pa.int64()),
                    "inner": pa.array([(np.diff(at) - 1).astype(np.int64)], pa.list_(pa.int64()))})
    return run


def document_lengths(files: DataFrame, block_tokens: int = BLOCK_TOKENS, end: int = END) -> DataFrame:
    """Lengths of all documents in the files named by `files` (path): path, ordinal, n_tokens, ended.

    n_tokens leaves out the end id.  Tokens after the last end id of a file are a document that is not `ended`.
    """
    sized = files.select("path").distinct().mapInArrow(_sizes, "path string, tokens long")
    count = F.ceil(F.col("tokens") / block_tokens)
    blocks = sized.filter("tokens > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))
    blocks = blocks.repartition(files.sparkSession.sparkContext.defaultParallelism * 4, "path", "block")
    reports = stored(blocks.mapInArrow(_scan(block_tokens, end), "path string, block long, ends long, head long, tail long, inner array<long>"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = reports.withColumn("base", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    # tokens that are open where a block starts: those of the blocks since the last one with an end, and its tail
    scan = scan.withColumn("stretch", F.coalesce(F.sum(F.when(F.col("ends") > 0, 1).otherwise(0)).over(Window.partitionBy("path").orderBy("block")), F.lit(0)))
    open_ = scan.groupBy("path", "stretch").agg(F.sum("tail").alias("open"), F.max(F.struct("base", "ends")).alias("last"))
    carried = open_.select("path", (F.col("stretch") + 1).alias("stretch"), F.col("open").alias("carry"))
    whole = scan.filter("ends > 0").join(carried, ["path", "stretch"], "left")
    first = F.array(F.coalesce("carry", F.lit(0)) + F.col("head"))
    ended = whole.select("path", "base", F.posexplode(F.concat(first, F.col("inner"))).alias("n", "n_tokens"))
    ended = ended.select("path", (F.col("base") + F.col("n")).alias("ordinal"), "n_tokens", F.lit(True).alias("ended"))
    final = Window.partitionBy("path").orderBy(F.desc("stretch"))
    rest = open_.withColumn("turn", F.row_number().over(final)).filter("turn = 1 AND open > 0")
    rest = rest.select("path", (F.col("last.base") + F.col("last.ends")).alias("ordinal"), F.col("open").alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(rest)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Tokens of every row of `docs` (doc_id, text): doc_id, n_tokens, by way of token files in the shared folder.

    Null and empty texts have none.  Null ids and repeated rows are kept; other columns are ignored; no rows give none.
    """
    held = write_token_files(docs, vocabulary=vocabulary)
    lengths = document_lengths(held, block_tokens)
    return held.join(lengths.hint("merge"), ["path", "ordinal"]).select("doc_id", "n_tokens")
