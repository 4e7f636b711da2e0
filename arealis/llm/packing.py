"""Packing documents into sequences: linear grouping of large lengths, best fit of small ones.

Lengths are whole numbers up to the size of a sequence, so a histogram of them, with at most that
many rows however many documents there are, is all that planning needs.  Large pieces in order of
length form groups of equal number; each group counts as large as its largest member, which leaves
few sizes.  Configurations of these sizes are chosen by the best fill that the remaining demand
allows, each used as often as it can be.  Then actual pieces take the places of their group, and small
pieces go, longest first, where they fit best.  The plan names intervals of ranks within a length;
a rank is a window over salted parts of a length, so no length is in one task.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import stored, text_bytes
from arealis.llm.tokens import default_vocabulary, encoded

SEQUENCE = 1024
END_ID = 2
GROUPS = 256
#: A piece of at most this share of a sequence is small.
SMALL = 4
SALTS = 64


def grouped(counts: dict[int, int], groups: int) -> list[list[tuple[int, int, int]]]:
    """Lengths in ascending order cut into parts of equal number: lists of (length, from rank, n)."""
    total = sum(counts.values())
    cuts = [total * k // groups for k in range(1, groups + 1)]
    out, part, seen = [], [], 0
    for length in sorted(counts):
        at = 0
        while at < counts[length]:
            n = min(counts[length] - at, cuts[len(out)] - seen)
            if n:
                part.append((length, at, n))
                at, seen = at + n, seen + n
            if seen == cuts[len(out)]:
                if part:
                    out.append(part)
                else:
                    cuts.pop(len(out))
                    continue
                part = []
    return out


def configurations(demand: dict[int, int], size: int) -> Iterator[tuple[list[int], int]]:
    """(sizes, times) until the demand is met: the largest size left with the best fill for it."""
    left = dict(demand)
    while left:
        top = max(left)
        # best[f]: a choice of further sizes with fill f, larger sizes first
        room = size - top
        best: dict[int, tuple[int, ...]] = {0: ()}
        for s in sorted(left, reverse=True):
            most = left[s] - (s == top)
            for fill in sorted(best, reverse=True):
                for k in range(1, min(most, (room - fill) // s) + 1):
                    best.setdefault(fill + k * s, best[fill] + (s,) * k)
        chosen = [top, *best[max(best)]]
        need = defaultdict(int)
        for s in chosen:
            need[s] += 1
        times = min(left[s] // k for s, k in need.items())
        for s, k in need.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
        yield chosen, times


def plan(counts: dict[int, int], size: int, groups: int = GROUPS, small: int = SMALL):
    """Rows (length, from rank, to rank, first sequence, offset) that place every piece.

    Piece number r of a length, with from <= r < to, goes to sequence ``first + r - from``.  The number
    of rows depends on the size of a sequence and the number of groups, not on the number of pieces.
    """
    bound = size // small
    members = {}
    for part in grouped({k: n for k, n in counts.items() if k > bound}, groups):
        members.setdefault(part[-1][0], []).extend(part)
    rows, sequences = [], 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room: (first sequence, number)
    demand = {k: sum(n for *_, n in part) for k, part in members.items()}
    heads = {k: [list(x) for x in reversed(part)] for k, part in members.items()}
    for chosen, times in configurations(demand, size):
        while times:
            # as many as every place has pieces of one length for
            slots = []
            for s in chosen:
                while heads[s] and not heads[s][-1][2]:
                    heads[s].pop()
                slots.append(heads[s][-1])
            uses = defaultdict(int)
            for slot in slots:
                uses[id(slot)] += 1
            n = min(times, *(slot[2] // uses[id(slot)] or 1 for slot in slots))
            if any(slot[2] < uses[id(slot)] for slot in slots):
                n = 1
            offset = 0
            for s in chosen:
                while not heads[s][-1][2]:
                    heads[s].pop()
                slot = heads[s][-1]
                length, at, _ = slot
                rows.append((length, at, at + n, sequences, offset))
                slot[1], slot[2] = at + n, slot[2] - n
                offset += length
            gaps[size - offset].append((sequences, n))
            sequences, times = sequences + n, times - n
    open_ = [g for g in gaps if g]
    heapq.heapify(open_)
    for length in sorted((k for k in counts if k <= bound), reverse=True):
        at, left = 0, counts[length]
        while left:
            room = min((g for g in gaps if g >= length and gaps[g]), default=None)
            if room is None:
                new = -(-left // (size // length))
                gaps[size].append((sequences, new))
                sequences, room = sequences + new, size
            first, n = gaps[room].pop()
            per = min(room // length, left)
            bins = min(n, left // per)
            if bins < n:
                gaps[room].append((first + bins, n - bins))
            for k in range(per):
                rows.append((length, at, at + bins, first, size - room + k * length))
                at += bins
            left -= per * bins
            gaps[room - per * length].append((first, bins))
    return rows, sequences


def _cutter(vocabulary: str, end_id: int, size: int):
    end = np.array([end_id], np.uint32)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            out = []
            for name, ids in zip(batch.column(0).to_pylist(), encoded(vocabulary, texts), strict=True):
                data = np.concatenate([ids, end])
                n = len(data)
                edges = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    out.append((name, i, a, b - a, zlib.crc32(data[a:b].tobytes())))
            if out:
                columns = list(zip(*out, strict=True))
                kinds = [batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return cut


def pieces(
    docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, size: int = SEQUENCE
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: whole documents, longer ones cut from the end."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _cutter(vocabulary or default_vocabulary(), end_id, size),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
    )


def packed(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    size: int = SEQUENCE,
    groups: int = GROUPS,
) -> DataFrame:
    """The pieces with their place: sequence_id and offset.

    Null text counts as empty: its end id is a piece.  Rows that repeat a doc_id are packed as documents
    of their own.  Without rows there is nothing to pack.  Only doc_id and text are read.
    """
    spark = docs.sparkSession
    salted = stored(
        pieces(docs, vocabulary, end_id, size).withColumn(
            "salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int")
        ),
        "pack-pieces",
    )
    counts = stored(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "pack-counts")
    # at most ``size`` rows
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(histogram, size, groups)
    places = spark.createDataFrame(
        rows, "length long, from_rank long, to_rank long, first_sequence long, offset long"
    )
    before = counts.select(
        "length",
        "salt",
        F.coalesce(
            F.sum("n").over(
                Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("before"),
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("within", F.row_number().over(within) - 1)
        .join(F.broadcast(before), ["length", "salt"])  # at most size * SALTS rows
        .withColumn("rank", F.col("before") + F.col("within"))
    )
    return (
        ranked.join(F.broadcast(places), "length")  # bounded by size and groups, see plan()
        .where("rank >= from_rank and rank < to_rank")
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.col("rank") - F.col("from_rank")).alias("sequence_id"),
            "offset",
        )
    )
