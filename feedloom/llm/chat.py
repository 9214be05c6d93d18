"""Chat formatting: conversations as a prefix tree, packed depth first, with positions and attention intervals.

Conversations that share their first turns share those nodes of the tree.  The different conversations are sorted by their
turns' hashes; this order is the tree's depth-first order, and what a conversation shares with the one before it is how many
first hashes are equal.  Only the turns after that are emitted, as tokens, each with

* its place in the pack (`start`, token offset) and its length,
* the position id of its first token, which counts the tokens of its ancestors only,
* the intervals of the pack that its tokens may attend to besides themselves: its ancestors, adjacent ones joined,
* the tokens that count for the loss: an assistant's text, without the marks of its turn.

The order is cut into packs of bounded size.  A pack opens with the whole conversation at the cut, so it can be used alone; turns
that an earlier pack holds are marked `repeated` there, so that a trainer counts them once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import meet_counted, stored
from feedloom.llm.tokens import VOCABULARY, encoder

# The marks of the template.  None overlaps itself or another one.
MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
ROLES = {"assistant": ("<s>", "</s>"), "user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]")}
OTHER, NAMED = "[ROLE]", "[/ROLE]"  # any other role: its name between these, its text up to the second one again
PACK_CHARS = 1 << 18
STRETCH = 4096  # characters encoded at a time, so that an endless word costs linear time


def escaped(text: str) -> str:
    """Without any mark in it: backslashes are doubled, and one is put behind a mark's first character."""
    text = text.replace("\\", "\\\\")
    for mark in MARKS:
        text = text.replace(mark, f"{mark[0]}\\{mark[1:]}")
    return text


def unescaped(text: str) -> str:
    out, at = [], 0
    while (found := text.find("\\", at)) >= 0:
        out += [text[at:found], text[found + 1:found + 2]]
        at = found + 2
    return "".join([*out, text[at:]])


class Codec:
    """Turns to tokens and back; marks have ids above those of the vocabulary."""

    def __init__(self, vocabulary: str = VOCABULARY):
        self.plain = encoder(vocabulary)
        self.first = self.plain.n_vocab
        self.ids = {mark: self.first + i for i, mark in enumerate(MARKS)}

    def text_ids(self, text: str) -> list[int]:
        return [i for at in range(0, len(text), STRETCH) for i in self.plain.encode_ordinary(text[at:at + STRETCH])]

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids of a turn, and which of them are its text."""
        if role in ROLES:
            opening, end = [self.ids[ROLES[role][0]]], self.ids[ROLES[role][1]]
        else:
            opening, end = [self.ids[OTHER], *self.text_ids(escaped(role)), self.ids[NAMED]], self.ids[NAMED]
        body = self.text_ids(escaped(text))
        return [*opening, *body, end], len(opening), len(opening) + len(body)

    def text(self, ids: np.ndarray) -> str:
        """The formatted text of some tokens."""
        out, at = [], 0
        for mark in [*np.flatnonzero(ids >= self.first), len(ids)]:
            out.append(self.plain.decode_bytes(ids[at:mark].tolist()).decode())
            if mark < len(ids):
                out.append(MARKS[ids[mark] - self.first])
            at = mark + 1
        return "".join(out)

    def decode(self, whole: str) -> tuple[str, str, int]:
        """Role and text of a turn, and the length of its formatted text."""
        for role, (mark, end) in ROLES.items():
            if whole.startswith(mark):
                return role, unescaped(whole[len(mark):-len(end)]), len(whole)
        cut = whole.index(NAMED)
        return unescaped(whole[len(OTHER):cut]), unescaped(whole[cut + len(NAMED):-len(NAMED)]), len(whole)


# --- the order of the tree ----------------------------------------------------------------------

def turn_rows(chats: DataFrame) -> DataFrame:
    """(cid, turn, role, text, key): nulls in role and text count as empty; key is a hash of both."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat_ws(":", F.length(role).cast("string"), role, text)
    key = F.unhex(F.substring(F.sha2(whole, 256), 1, 32))
    cid = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    return chats.select("conv_id", cid.alias("cid"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"), key.alias("key"))


def _shared(one: Column, other: Column) -> Column:
    """How many first elements of two arrays are equal."""
    same = F.zip_with(one, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    unlike = F.array_position(same, False)
    return F.when(unlike > 0, unlike - 1).otherwise(F.size(same)).cast("int")


PLAN = "path_id binary, cid string, copies long, part int, rank long, pack long, opens boolean, shared int, n_turns int, path array<binary>"


def _planned(pack_chars: int):
    """Numbers sorted paths, counts what each shares with the one before it, and cuts packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rank, pack, size, before = part << 33, (part << 33) - 1, 0, None
        for batch in batches:
            ranks, packs, opens, shares = [], [], [], []
            for path, sizes in zip(batch.column("path").to_pylist(), batch.column("sizes").to_pylist()):
                shared = 0
                for mine, last in zip(path, before or ()):
                    if mine != last:
                        break
                    shared += 1
                cut = before is None or size >= pack_chars
                pack, size = (pack + 1, sum(sizes)) if cut else (pack, size + sum(sizes[shared:]))
                ranks.append(rank)
                packs.append(pack)
                opens.append(cut)
                shares.append(shared)
                rank, before = rank + 1, path
            m = batch.num_rows
            sizes = batch.column("path").value_lengths()
            yield pa.record_batch({
                "path_id": batch.column("path_id"), "cid": batch.column("cid"), "copies": batch.column("copies"), "part": pa.array([part] * m, pa.int32()),
                "rank": pa.array(ranks, pa.int64()), "pack": pa.array(packs, pa.int64()), "opens": pa.array(opens, pa.bool_()),
                "shared": pa.array(shares, pa.int32()), "n_turns": sizes.cast(pa.int32()), "path": batch.column("path")})

    return run


def tree_order(rows: DataFrame, pack_chars: int = PACK_CHARS) -> tuple[DataFrame, DataFrame]:
    """Members (conv_id, path_id) and, per different conversation, its place in the depth-first order; both stored.

    Only hashes and lengths of turns travel here, 16 bytes and a few more per turn.  Turns go by number (null first), role,
    then hash.  Copies of a conversation are one path from here on.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "key", F.length("text").alias("n"))))
    chains = rows.groupBy("conv_id", "cid").agg(turns.alias("t")).select(
        "conv_id", "cid", F.col("t.key").alias("path"), F.col("t.n").alias("sizes"))
    named = F.unhex(F.sha2(F.array_join(F.transform("path", F.hex), ""), 256))
    chains = stored(chains.withColumn("path_id", named))
    paths = chains.groupBy("path_id").agg(F.min(F.struct("cid", "path", "sizes")).alias("one"), F.count("*").alias("copies"))
    paths = paths.select("path_id", "one.*", "copies").repartitionByRange("path").sortWithinPartitions("path")
    plan = stored(paths.mapInArrow(_planned(pack_chars), PLAN))
    # the first path of a partition shares turns with the last path of the partition before: one row per partition
    ends = plan.groupBy("part").agg(F.max_by("path", "rank").alias("last"), F.min("rank").alias("rank"), F.min_by("path", "rank").alias("path"))
    before = F.lag("last").over(Window.orderBy("part"))
    ends = ends.withColumn("before", before).select(F.col("rank").alias("_rank"), _shared(F.col("path"), F.coalesce("before", F.array().cast("array<binary>"))).alias("_shared"))
    plan = plan.join(F.broadcast(ends), F.col("rank") == F.col("_rank"), "left")
    plan = plan.withColumn("shared", F.coalesce("_shared", "shared")).drop("_rank", "_shared", "path", "part")
    return chains.select("conv_id", "path_id"), stored(plan)


# --- packing -----------------------------------------------------------------------------------------

NODE = pa.schema([
    ("pack", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("depth", pa.int32()), ("position", pa.int64()),
    ("ancestors", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("ids", pa.list_(pa.int32())),
    ("loss_from", pa.int32()), ("loss_to", pa.int32()), ("repeated", pa.bool_()), ("path_id", pa.binary())])
NODES = ("pack long, start long, length int, depth int, position long, ancestors array<struct<start:long,end:long>>, ids array<int>, "
         "loss_from int, loss_to int, repeated boolean, path_id binary")


class Branch:
    """The nodes from a root to where the walk stands: where each ends, and their joined intervals."""

    def __init__(self) -> None:
        self.ends: list[int] = []
        self.positions = [0]
        self.joined: list[list[int]] = []  # first depth, start, end

    def back_to(self, depth: int) -> None:
        del self.ends[depth:], self.positions[depth + 1:]
        while self.joined and self.joined[-1][0] >= depth:
            self.joined.pop()
        if self.joined:
            self.joined[-1][2] = self.ends[-1]

    def add(self, start: int, length: int) -> None:
        if self.joined and self.joined[-1][2] == start:
            self.joined[-1][2] = start + length
        else:
            self.joined.append([len(self.ends), start, start + length])
        self.ends.append(start + length)
        self.positions.append(self.positions[-1] + length)


def _flushed(rows: list[tuple], ids: list[list[int]], ancestors: list[list[tuple]]) -> pa.RecordBatch:
    """A batch of nodes from (all other fields), their token ids and intervals."""
    lists = {}
    for name, kind, values in (("ids", np.int32, ids), ("ancestors", np.int64, ancestors)):
        flat = np.fromiter(chain.from_iterable(values), kind) if name == "ids" else np.array([i for v in values for i in v], kind).reshape(-1, 2)
        offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
        items = pa.array(flat) if name == "ids" else pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
        lists[name] = pa.ListArray.from_arrays(pa.array(offsets), items)
    plain = iter(zip(*rows))
    return pa.record_batch([lists[f.name].cast(f.type) if f.name in lists else pa.array(next(plain), f.type) for f in NODE], schema=NODE)


def _emitted(vocabulary: str):
    """Turns in depth-first order to nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, branch, pack, rank, at, held = Codec(vocabulary), Branch(), None, None, 0, 0
        out, tokens, seen = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["pack"] != pack:
                    pack, at, rank = row["pack"], 0, None
                if row["rank"] != rank:
                    rank = row["rank"]
                    branch.back_to(row["depth"])  # the first turn of a path that is emitted
                ids, first, last = codec.encode(row["role"], row["text"])
                counts = row["role"] == "assistant"
                out.append((pack, at, len(ids), row["depth"], branch.positions[-1], first if counts else 0, last if counts else 0,
                            row["depth"] < row["shared"], row["path_id"] if row["depth"] + 1 == row["n_turns"] else None))
                tokens.append(ids)
                seen.append([(a, b) for _, a, b in branch.joined])
                branch.add(at, len(ids))
                at, held = at + len(ids), held + len(ids)
                if held > 1 << 20:
                    yield _flushed(out, tokens, seen)
                    out, tokens, seen, held = [], [], [], 0
        if out:
            yield _flushed(out, tokens, seen)

    return run


def pack(chats: DataFrame, vocabulary: str = VOCABULARY, pack_chars: int = PACK_CHARS) -> tuple[DataFrame, DataFrame]:
    """Members (conv_id, path_id) and nodes (see `NODES`) of `chats` (conv_id, turn, role, text), both stored.

    A node is one turn in one pack; `path_id` tells which conversation ends there.  A pack holds whole trees up to
    `pack_chars` characters and the conversation that crosses this size; a larger tree goes on in the next pack.  Null roles
    and texts count as empty, rows with a null conv_id are one conversation, repeated rows are turns of their own; other
    columns are ignored; no rows give none.  A text moves twice: to its conversation, and, if it is emitted, to its pack.
    """
    rows = turn_rows(chats)
    members, plan = tree_order(rows, pack_chars)
    due = rows.drop("conv_id").join(plan.hint("merge"), "cid")
    place = F.row_number().over(Window.partitionBy("cid").orderBy("turn", "role", "key")) - 1
    due = due.withColumn("depth", place).filter(F.col("opens") | (F.col("depth") >= F.col("shared")))
    due = due.select("pack", "rank", "depth", "role", "text", "shared", "n_turns", "path_id")
    nodes = due.repartition("pack").sortWithinPartitions("pack", "rank", "depth").mapInArrow(_emitted(vocabulary), NODES)
    return members, stored(nodes)


# --- reading ------------------------------------------------------------------------------------------

def _walked(nodes: Iterator[dict]) -> Iterator[tuple[dict, int]]:
    """Nodes of a pack, each with how many of the nodes before it are its ancestors, told by its intervals alone."""
    starts: list[int] = []
    for node in nodes:
        while starts and not (node["ancestors"] and node["ancestors"][-1]["start"] <= starts[-1] < node["ancestors"][-1]["end"]):
            starts.pop()
        yield node, len(starts)
        starts.append(node["start"])


def _node_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, token ids as slices of one array."""
    lists = batch.column("ids")
    flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    for i, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
        row["ids"] = flat[offsets[i]:offsets[i + 1]]
        yield row


DIGEST = "path_id binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary)
        rows = (row for batch in batches for row in _node_rows(batch))
        for _, nodes in groupby(rows, key=lambda row: row["pack"]):
            # per depth of the walk: hash of the turns, hash of the text under the loss mask, its length, formatted length
            path, found = [(hashlib.sha256(), hashlib.sha256(), 0, 0)], []
            for node, depth in _walked(nodes):
                del path[depth + 1:]
                turns, loss, loss_chars, chars = path[-1]
                before, said, after = (codec.text(part) for part in np.split(node["ids"], [node["loss_from"], node["loss_to"]]))
                role, text, size = codec.decode(before + said + after)
                turns = turns.copy()
                turns.update(f"{role}\n{text}\n".encode())
                if said:
                    said = unescaped(said)
                    loss = loss.copy()
                    loss.update(said.encode())
                    loss_chars += len(said)
                path.append((turns, loss, loss_chars, chars + size))
                if node["path_id"] is not None:
                    found.append((node["path_id"], depth + 1, turns.hexdigest(), loss_chars, loss.hexdigest(), chars + size))
                if len(found) >= 10_000:
                    yield _digests(found)
                    found = []
            if found:
                yield _digests(found)

    return run


def _digests(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = [field.split(" ")[0] for field in DIGEST.split(", ")]
    return pa.record_batch({name: pa.array(column, kind) for name, kind, column in zip(names, kinds, zip(*found))})


def read_back(members: DataFrame, nodes: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What the packs say of each conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Paths are followed by the attention intervals; a shared turn is decoded once per pack.  A task keeps two hash states per
    turn of the path it stands on.  Copies of a conversation meet the digest of their path.
    """
    sorted_nodes = nodes.select("pack", "start", "ancestors", "ids", "loss_from", "loss_to", "path_id").repartition("pack").sortWithinPartitions("pack", "start")
    digests = sorted_nodes.mapInArrow(_read(vocabulary), DIGEST)
    copies = members.groupBy("path_id").agg(F.count("*").alias("copies"))
    digests = stored(digests.join(copies, "path_id"))
    return meet_counted(members, digests, "path_id", count="copies").drop("path_id")


def training_arrays(nodes: DataFrame) -> DataFrame:
    """One row per node with arrays for training: pack, start, ids, positions, counted (token counts for the loss) and the
    intervals its tokens attend to; a token also attends to the tokens of its node up to itself."""
    at = F.sequence(F.lit(0), F.col("length") - 1)
    counted = F.transform(at, lambda i: ~F.col("repeated") & (i >= F.col("loss_from")) & (i < F.col("loss_to")))
    return nodes.select("pack", "start", "ids", F.transform(at, lambda i: F.col("position") + i).alias("positions"), counted.alias("counted"), "ancestors")
