"""Trie of conversation beginnings by padded matrices of turn ids.

A turn's id is 128 bits of the SHA-256 of its role and text.  Conversations are dealt to shards by range
of (sequence of ids, conv_id), so a node is a run of neighbours and a conversation that many repeat is
still split.  Inside a shard numpy's lexsort orders the padded matrix of ids; masks of changed columns,
accumulated by OR from the left, mark where nodes start at every depth, and ``reduceat`` over these
starts gives all figures of all depths.  Every figure of a subtree is written as a sum over rows, so
it needs no recursion.  Only nodes on the path of a shard's first or last row can go on in a
neighbour: these come out as parts and are added up by key.  What a shard cannot know, how much its
first row shares with the row before it and its last row with the row behind it, comes from a table of
one row per shard.

Memory: a shard holds its ids and words (about 50 bytes a turn); matrices are worked on in blocks of
columns of at most CELLS cells, so one long conversation does not pad the others.  One conversation is
one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.llm.common import WORD, stored

#: Turns that a shard holds, on average.
SHARD_TURNS = 1 << 20
#: Cells of one block of a padded matrix.
CELLS = 1 << 20
#: Conversation ids in one piece of a list that goes over shards.
PIECE = 1 << 16
ID_BYTES = 16
#: Conversations whose heads come from the first of them, and the most turns that do.
FAMILY = 20
HEADS = 4

_NOTHING = hashlib.sha256(b"").hexdigest()
_FINAL, _UNDER_OPEN, _OPEN, _SHARD, _ENDS = range(5)
_FIGURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_SCHEMA = (
    "kind int, shard int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, on_first boolean, "
    "on_last boolean, words_before long, first_path binary, last_path binary, first_words array<long>"
)


def _turn_id(role: Column, text: Column) -> Column:
    """Id of a turn in hexadecimal; the length keeps role and text apart."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * ID_BYTES)


def _turn(t: Column) -> Column:
    return F.struct(t["id"].alias("id"), t["words"].alias("words"))


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each with id and number of words.

    Null turn numbers come first, turns of one number by id; null role or text count as empty.  Rows
    without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    row = F.struct(
        F.col("turn"),
        _turn_id(role, text).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"),
    )
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(row)).alias("turns"))
        .select("conv_id", F.transform("turns", _turn).alias("turns"))
    )


def with_shared_heads(sequences: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Conversations whose first turns are replaced by those of the first of their family.

    The number of turns is the CRC-32 of the decimal conv_id modulo ``heads``; a family holds at most
    2 * family conversations, so no key of the join is hot.
    """
    first = sequences.select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head")
    )
    own = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    )
    none = F.slice("turns", 1, 0)
    return own.join(first, "base", "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("head", F.lit(1), F.col("h")), none),
            F.slice("turns", F.col("h") + 1, F.size("turns") + 1),
        ).alias("turns"),
    )


class _Rows:
    """Sequences of a shard: flat ids and words, and where each row's turns lie."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        conv, sizes, ids, words = [], [], [], []
        for batch in batches:
            conv.append(batch.column(0).to_numpy())
            sizes.append(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
            ids += batch.column(1).to_pylist()
            words.append(batch.column(2).flatten().to_numpy(zero_copy_only=False))
        self.conv = np.concatenate(conv) if conv else np.empty(0, np.int64)
        self.sizes = np.concatenate(sizes).astype(np.int64) if conv else np.empty(0, np.int64)
        halves = np.frombuffer(bytearray().join(ids), ">u8").astype(np.uint64).reshape(-1, 2)
        self.high, self.low = halves[:, 0].copy(), halves[:, 1].copy()
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(words).astype(np.int64) if conv else np.empty(0, np.int64)
        self._sort()
        #: words of all turns before a place of the flat arrays
        self.total = np.concatenate([[0], np.cumsum(self.words)])
        self.end = self.total[self.starts + self.sizes]

    def _cells(self, rows: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded ids of turns k to k + width of some rows, and which cells are turns."""
        at = k + np.arange(width)
        held = at < self.sizes[rows][:, None]
        cell = np.where(held, self.starts[rows][:, None] + at, 0)
        pad = np.uint64(0)
        return np.where(held, self.high[cell], pad), np.where(held, self.low[cell], pad), held

    def _sort(self) -> None:
        """Order by ids, then conv_id; rows that still tie are sorted by further blocks of columns."""
        n, k = len(self.conv), 0
        rank = np.zeros(n, np.int64)
        while True:
            crowd = np.bincount(rank, minlength=n)
            rows = np.flatnonzero((self.sizes > k) & (crowd[rank] > 1))
            if not len(rows):
                break
            width = int(max(1, min(self.sizes[rows].max() - k, CELLS // len(rows))))
            high, low, _ = self._cells(rows, k, width)
            keys = [column for j in reversed(range(width)) for column in (low[:, j], high[:, j])]
            order = np.lexsort([*keys, rank[rows]])
            held = rank[rows][order]
            apart = np.concatenate([[True], held[1:] != held[:-1]])
            changed = apart.copy()
            changed[1:] |= (np.diff(high[order], axis=0) != 0).any(axis=1)
            changed[1:] |= (np.diff(low[order], axis=0) != 0).any(axis=1)
            place = np.arange(len(rows))
            inside = np.maximum.accumulate(np.where(changed, place, 0)) - np.maximum.accumulate(
                np.where(apart, place, 0)
            )
            # rows that ended before k come first among those that tie
            ended = crowd - np.bincount(held, minlength=n)
            rank[rows[order]] = held + ended[held] + inside
            k += width
        order = np.lexsort((self.conv, rank))
        self.conv, self.sizes, self.starts = self.conv[order], self.sizes[order], self.starts[order]

    def shared(self) -> np.ndarray:
        """Leading turns that each row has in common with the row before it; -1 for the first row."""
        out = np.zeros(len(self.conv), np.int64)
        out[0] = -1
        pairs, k = np.arange(1, len(self.conv)), 0
        while True:
            pairs = pairs[np.minimum(self.sizes[pairs], self.sizes[pairs - 1]) > k]
            if not len(pairs):
                return out
            width = int(max(1, min(self.sizes[pairs].max() - k, CELLS // len(pairs))))
            high, low, held = self._cells(pairs, k, width)
            high_before, low_before, held_before = self._cells(pairs - 1, k, width)
            change = (high != high_before) | (low != low_before) | ~held | ~held_before
            same = (~np.logical_or.accumulate(change, axis=1)).sum(axis=1)
            out[pairs] += same
            pairs = pairs[same == width]
            k += width

    def path(self, row: int) -> bytes:
        at = slice(self.starts[row], self.starts[row] + self.sizes[row])
        return np.stack([self.high[at], self.low[at]], 1).astype(">u8").tobytes()


def _keys(path: bytes) -> list[bytes]:
    """A key for every beginning of a path, the empty one included."""
    seen, out = hashlib.sha256(), []
    for at in range(0, len(path) + 1, ID_BYTES):
        out.append(seen.copy().digest())
        seen.update(path[at : at + ID_BYTES])
    return out


def _record(kind: int, n: int, **columns) -> pa.RecordBatch:
    """A batch of the output schema; columns that are not given are null."""
    types = {
        "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
        "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    }
    fields = [part.split(" ") for part in _SCHEMA.split(", ")]
    columns["kind"] = np.full(n, kind, np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], types[t]) if c in columns else pa.nulls(n, types[t]) for c, t in fields],
        names=[c for c, _ in fields],
    )


def _ends(rows: _Rows, shared: np.ndarray) -> dict[int, slice]:
    """Runs of equal whole sequences, by their first row."""
    same = np.zeros(len(shared), bool)
    same[1:] = (shared[1:] == rows.sizes[1:]) & (shared[1:] == rows.sizes[:-1])
    first = np.flatnonzero(~same)
    return dict(
        zip(first.tolist(), map(slice, first.tolist(), [*first[1:].tolist(), len(shared)]), strict=True)
    )


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard: whole ones, parts of those that may go on elsewhere, and its two ends."""
    rows = _Rows(batches)
    n = len(rows.conv)
    if not n:
        return
    shard = TaskContext.get().partitionId()
    shared = rows.shared()
    runs = _ends(rows, shared)
    paths = [rows.path(0), rows.path(n - 1)]
    keys = [_keys(p) for p in paths]
    first_words = rows.total[rows.starts[0] : rows.starts[0] + rows.sizes[0] + 1] - rows.total[rows.starts[0]]
    yield _record(
        _SHARD, 1, shard=[shard], conv_id=[rows.conv[0]], first_path=[paths[0]], last_path=[paths[1]],
        first_words=[first_words],
    )
    # a row is the last of a leaf if the next row does not go through all of it; the last row cannot tell
    leaf = np.zeros(n, np.int64)
    leaf[:-1] = shared[1:] < rows.sizes[:-1]
    # words of the turns that a row does not share with the row before it
    fresh = np.zeros(n, np.int64)
    fresh[1:] = rows.end[1:] - rows.total[rows.starts[1:] + shared[1:]]
    everything = rows.end - rows.total[rows.starts]

    def ends_of(row: int) -> str:
        return hashlib.sha256(",".join(map(str, rows.conv[runs[row]].tolist())).encode()).hexdigest()

    def pieces(row: int, key: bytes) -> Iterator[pa.RecordBatch]:
        held = rows.conv[runs[row]].tolist()
        for a in range(0, len(held), PIECE):
            text = ",".join(map(str, held[a : a + PIECE]))
            yield _record(_ENDS, 1, key=[key], conv_id=[held[a]], ends=[text])

    root_conv = int(rows.conv.min())
    yield _record(
        _OPEN, 1, shard=[shard], key=[keys[0][0]], depth=[0], conv_id=[root_conv], n_convs=[n],
        n_children=[int(((shared < 1) & (rows.sizes > 0)).sum())], n_leaves=[int(leaf.sum())],
        saved_tokens=[int((everything - fresh)[1:].sum())], on_first=[True], on_last=[True],
        words_before=[0],
    )
    if rows.sizes[0] == 0:
        yield from pieces(0, keys[0][0])

    # of each row's node one level above the block: smallest member, and on which path it lies
    carried, carried_on = np.full(n, root_conv), [np.ones(n, bool), np.ones(n, bool)]
    k = 0
    while True:
        at_rows = np.flatnonzero(rows.sizes > k)
        m = len(at_rows)
        if not m:
            return
        width = int(max(1, min(rows.sizes[at_rows].max() - k, CELLS // m)))
        at = (k + np.arange(width))[:, None]
        size, share = rows.sizes[at_rows], shared[at_rows]
        held = at < size
        starts = held & (at >= share)
        place = np.flatnonzero(starts)
        node = (np.cumsum(starts.ravel()) - 1).reshape(width, m)
        conv = np.minimum.reduceat(
            np.where(held, rows.conv[at_rows], np.iinfo(np.int64).max).ravel(), place
        )
        rest = np.where(held, rows.end[at_rows] - rows.total[np.where(held, rows.starts[at_rows] + at, 0)], 0)
        figures = {
            "n_convs": held,
            "n_children": held & (at + 1 < size) & (at + 1 >= share),
            "n_leaves": np.where(held, leaf[at_rows], 0),
            "saved_tokens": np.where(held & ~starts, rest - fresh[at_rows], 0),
        }
        figures = {c: np.add.reduceat(v.ravel().astype(np.int64), place) for c, v in figures.items()}
        level, column = place // m, place % m
        depth = k + 1 + level
        above = np.maximum(level - 1, 0)
        parent = np.where(level > 0, conv[node[above, column]], carried[at_rows[column]])
        # nodes on the paths of the first and last row of the shard
        ends = []
        for row, side in ((0, 0), (n - 1, -1)):
            on = np.zeros(len(place), bool)
            if at_rows[side] == row:
                on[node[held[:, side], side]] = True
            ends.append(on)
        open_node = ends[0] | ends[1]
        first_row = at_rows[column]
        under = [
            np.where(level > 0, on[node[above, column]], before[first_row])
            for on, before in zip(ends, carried_on, strict=True)
        ]
        under_open = under[0] | under[1]
        ended = rows.sizes[first_row] == depth

        def chosen(mask: np.ndarray) -> dict:
            return {
                "depth": depth[mask], "conv_id": conv[mask], **{c: v[mask] for c, v in figures.items()}
            }

        def hashes(mask: np.ndarray) -> list[str]:
            return [
                ends_of(r) if e else _NOTHING
                for r, e in zip(first_row[mask].tolist(), ended[mask].tolist(), strict=True)
            ]

        whole = ~open_node & ~under_open
        yield _record(
            _FINAL, int(whole.sum()), **chosen(whole), parent_conv_id=parent[whole], ends=hashes(whole)
        )
        hang = np.flatnonzero(~open_node & under_open)
        yield _record(
            _UNDER_OPEN, len(hang), **chosen(hang), ends=hashes(hang),
            parent_key=[keys[0 if under[0][i] else 1][depth[i] - 1] for i in hang],
        )
        part = np.flatnonzero(open_node)
        own = [keys[0 if ends[0][i] else 1] for i in part]
        yield _record(
            _OPEN, len(part), **chosen(part), shard=np.full(len(part), shard, np.int32),
            key=[key[depth[i]] for key, i in zip(own, part, strict=True)],
            parent_key=[key[depth[i] - 1] for key, i in zip(own, part, strict=True)],
            on_first=ends[0][part], on_last=ends[1][part],
            words_before=[first_words[depth[i] - 1] if ends[0][i] else 0 for i in part],
        )
        for key, i in zip(own, part, strict=True):
            if ended[i]:
                yield from pieces(int(first_row[i]), key[depth[i]])
        lowest = held[-1]
        carried[at_rows[lowest]] = conv[node[-1, lowest]]
        for on, before in zip(ends, carried_on, strict=True):
            before[at_rows[lowest]] = on[node[-1, lowest]]
        k += width


@F.pandas_udf(T.LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Turns that two paths share at their beginning; -1 if one of them is missing."""

    def one(x: bytes | None, y: bytes | None) -> int:
        if x is None or y is None:
            return -1
        n = min(len(x), len(y))
        u, v = (np.frombuffer(z[:n], np.uint8).reshape(-1, ID_BYTES) for z in (x, y))
        different = (u != v).any(axis=1)
        return int(different.argmax()) if different.any() else n // ID_BYTES

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


def _stream_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each key, which come in order."""

    def result(key: bytes, seen) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.binary()), pa.array([seen.hexdigest()])], names=["key", "ends_sha256"]
        )

    held, seen = None, None
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != held:
                if seen is not None:
                    yield result(held, seen)
                held, seen = key, hashlib.sha256()
            else:
                seen.update(b",")
            seen.update(text.encode())
    if seen is not None:
        yield result(held, seen)


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct beginning of the sequences (conv_id, turns array of id and words).

    conv_id is the smallest member and depth the number of turns; parent_conv_id is null for the root,
    which is there if any sequence is, and is its own leaf if all are empty.  n_leaves and saved_tokens
    are over the subtree, the node included; ends_sha256 hashes the decimal conv_ids, ascending and joined by
    commas, of members that end in the node.  A conv_id that occurs twice counts twice.
    """
    rows = stored(
        sequences.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("path"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
        ),
        "trie-sequences",
    )
    size = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    dealt = rows.repartitionByRange(max(1, -(-size // shard_turns)), "path", "conv_id")
    found = stored(dealt.mapInArrow(shard_nodes, _SCHEMA), "trie-nodes", ["kind"])

    # one row per shard: what it shares with the rows before and behind it
    along = Window.orderBy("first_path", "conv_id")
    shards = (
        found.where(F.col("kind") == _SHARD)
        .withColumn("path_before", F.lag("last_path").over(along))
        .withColumn("path_behind", F.lead("first_path").over(along))
        .withColumn("before", _common("path_before", "first_path"))
        .withColumn("behind", _common("last_path", "path_behind"))
        .select(
            "shard",
            "before",
            F.when(F.col("before") > 0, F.expr("first_words[before]")).otherwise(0).alias("words_shared"),
            # -1 where no row follows: then even an empty last row ends its path
            (F.col("behind") * ID_BYTES < F.length("last_path")).cast("long").alias("last_leaf"),
        )
    )
    first, last = F.col("on_first"), F.col("on_last")
    went_on = first & (F.col("depth") <= F.col("before"))
    parts = (
        found.where(F.col("kind") == _OPEN)
        .join(shards, "shard")
        .withColumn(
            "saved_tokens",
            F.col("saved_tokens") + F.when(went_on, F.col("words_shared") - F.col("words_before")).otherwise(0),
        )
        .withColumn(
            "n_children",
            F.col("n_children") - F.when(first & (F.col("depth") < F.col("before")), 1).otherwise(0),
        )
        .withColumn(
            "n_leaves",
            F.col("n_leaves") + F.when(last, F.col("last_leaf")).otherwise(0),
        )
        .groupBy("key")
        .agg(
            F.min("parent_key").alias("parent_key"),
            F.min("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *(F.sum(c).alias(c) for c in _FIGURES),
        )
    )
    ends = (
        found.where(F.col("kind") == _ENDS)
        .select("key", "ends", "conv_id")
        .repartition("key")
        .sortWithinPartitions("key", "conv_id")
        .select("key", "ends")
        .mapInArrow(_stream_hashes, "key binary, ends_sha256 string")
    )
    open_nodes = stored(
        parts.join(ends, "key", "left").fillna({"ends_sha256": _NOTHING}), "trie-open"
    )
    parents = open_nodes.select(
        F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")
    )
    columns = ["conv_id", "depth", "parent_conv_id", *_FIGURES, "ends_sha256"]
    closed = found.withColumnRenamed("ends", "ends_sha256")
    return (
        closed.where(F.col("kind") == _FINAL)
        .select(columns)
        .unionByName(
            closed.where(F.col("kind") == _UNDER_OPEN)
            .drop("parent_conv_id")
            .join(parents, "parent_key")
            .select(columns)
        )
        .unionByName(open_nodes.join(parents, "parent_key", "left").select(columns))
    )


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of all conversations with the shared heads of their families."""
    sequences = stored(turn_sequences(conversations), "trie-turns")
    return prefix_trie(with_shared_heads(sequences), shard_turns)
