"""Removal of repeated byte strings: blockwise suffix sorting with a difference cover.

A string of ``size`` bytes that starts in two places is found in three steps.

1. Every string of that length has an anchor, its least hashed gram, so equal strings have equal
   anchors at equal places.  Neighbouring strings with one anchor are a stretch.  Stretches whose anchor
   occurs once are done, and so are stretches of equal content: all their strings repeat.
2. What is left, different stretches around one anchor, is sorted in suffix buckets, one at a time; all
   suffixes that can be equal share an anchor and so a bucket.  Inside a bucket the suffixes of a
   difference cover modulo 7 are ranked first, by doubling.  The others are ordered by their first
   bytes; for those that tie, the cover gives a shift at which both are ranked, for each pair of phases,
   so that no tie is followed byte by byte and memory stays at a few words for each suffix.
   Anchors with very many different stretches are not put in a bucket: their stretches are cut into
   pieces of strings that begin about as far before the anchor, which have to share more bytes around it.
   Equal pieces repeat as a whole, different ones go to a bucket, and where there are still very many
   of these they are cut again, down to single strings.  So what is counted is pieces, not strings.
3. The bytes under the repeated strings go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import (
    blocks,
    mix64,
    prefix_hashes,
    stored,
    substring_hashes,
    text_bytes,
)

SIZE = 200
GRAM = 32
#: The cover: every difference modulo 7 is one of two of its members.
PERIOD = 7
COVER = (0, 1, 3)
#: Bytes of text in a suffix bucket, on average.
BUCKET_BYTES = 1 << 20
#: Different stretches around the same bytes from which on they are cut into pieces.
CROWD = 2_000
#: Pieces that a stretch is cut into at most, each time.
CUTS = 4

_PLACE_BITS = np.uint64(31)
_PLACE = np.uint64((1 << 31) - 1)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row, from running minima of blocks."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def stretches(texts: list[bytes], size: int = SIZE, gram: int = GRAM):
    """Per stretch: its text's number, start, number of strings, anchor hash, content hash."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    empty = np.empty(0, np.int64)
    if len(data) < size:
        return empty, empty, empty, empty, empty
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    grams = substring_hashes(prefix, at, at + gram)
    keys = ((grams >> _PLACE_BITS) << _PLACE_BITS) | at.astype(np.uint64)
    anchor = (sliding_minimum(keys, size - gram + 1) & _PLACE).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int32)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= size:
            inside[a] += 1
            inside[b - size + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside)[: len(anchor)])
    if not len(starts):
        return empty, empty, empty, empty, empty
    mine = anchor[starts]
    new = np.append(True, (np.diff(mine) != 0) | (np.diff(starts) != 1))
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    owner = np.searchsorted(offsets, begin, side="right") - 1
    content = substring_hashes(prefix, begin, begin + counts + size - 1)
    return (
        owner,
        begin - offsets[owner],
        counts,
        grams[mine[first]].view(np.int64),
        content.view(np.int64),
    )


def tag(text: Column) -> Column:
    """24 bits that tell rows apart which repeat a doc_id with another text."""
    return F.xxhash64(text).bitwiseAND((1 << 24) - 1)


def _finder(size: int, gram: int, whole: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in blocks([len(x) for x in texts]):
                owner, start, counts, anchor, content = stretches(texts[a:b], size, gram)
                if not len(owner):
                    continue
                if not whole:
                    found, n = np.unique(anchor, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found), pa.array(n)], names=["anchor", "n"]
                    )
                    continue
                rows = pa.array(owner + a)
                marks = batch.column(2).take(rows).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor),
                        pa.array(content),
                        batch.column(1).take(rows),
                        pa.array((start << 32) | (counts << 24) | marks),
                    ],
                    names=["anchor", "content", "doc_id", "place"],
                )

    return find


def ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def repeated_starts(data: np.ndarray, starts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Which of ``starts`` begin a string of ``size`` bytes that begins at another of them as well.

    Every start has ``size`` bytes of its own text behind it.
    """
    padded = np.concatenate([data, np.zeros(size + 8, np.uint8)])
    n = len(data)
    # the seven bytes from every place on
    word = np.zeros(n + size, np.uint64)
    for k in range(PERIOD):
        word = (word << np.uint64(8)) | padded[k : k + n + size]
    # ranks of the cover's suffixes by their first ``depth`` bytes, doubled within their phase
    cover = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    rank = np.zeros(n + size, np.uint64)
    rank[cover] = ranks(word[cover])
    depth, wanted = PERIOD, (size - PERIOD) // PERIOD * PERIOD - PERIOD
    while depth < wanted:
        shift = min(depth, wanted - depth)
        pairs = (rank[cover] << np.uint64(32)) | rank[cover + shift]
        rank = np.zeros(n + size, np.uint64)
        rank[cover] = ranks(pairs)
        depth += shift
    # first bytes, and the last bytes that a shifted rank may not reach
    tie = ranks(word[starts])
    for back in range(PERIOD, size - depth + PERIOD, PERIOD):
        tie = ranks((tie << np.uint64(32)) | ranks(word[starts + size - back]))
    counts = np.bincount(tie.astype(np.int64))
    open_ = np.flatnonzero(counts[tie.astype(np.int64)] > 1)
    phase = starts[open_] % PERIOD
    out = np.zeros(len(starts), bool)
    for a in range(PERIOD):
        for b in range(a, PERIOD):
            k = next(k for k in range(PERIOD) if {(a + k) % PERIOD, (b + k) % PERIOD} <= set(COVER))
            rows = open_[(phase == a) | (phase == b)]
            if len(rows) < 2:
                continue
            _, which, n_equal = np.unique(
                (tie[rows] << np.uint64(32)) | rank[starts[rows] + k],
                return_inverse=True,
                return_counts=True,
            )
            out[rows[n_equal[which] > 1]] = True
    return out


def _sorter(size: int):
    def sort(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = list(pdf["stretch"])
        counts = np.array([len(x) - size + 1 for x in texts])
        offsets = np.cumsum([0, *map(len, texts)])
        starts = np.repeat(offsets[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        found = repeated_starts(np.frombuffer(b"".join(texts), np.uint8), starts, size)
        owner = np.repeat(np.arange(len(texts)), counts)
        at = np.flatnonzero(found)
        new = np.append(True, (np.diff(at) != 1) | (np.diff(owner[at]) != 0))[: len(at)]
        first = at[new]
        last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
        rows = owner[first]
        begin = starts[first] - offsets[rows]
        return pd.DataFrame(
            {
                "doc_id": pdf["doc_id"].iloc[rows].to_numpy(),
                "mark": pdf["mark"].iloc[rows].to_numpy(),
                "begin": pdf["start"].iloc[rows].to_numpy() + begin,
                "end": pdf["start"].iloc[rows].to_numpy() + begin + (last - first) + size,
            }
        )

    return sort


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the asked stretches: doc_id, mark, text, array of (anchor, start, n, crowded)."""
    for batch in batches:
        texts = text_bytes(batch.column(2))
        rows, anchors, starts, parts, crowded = [], [], [], [], []
        for i, asked in enumerate(batch.column(3).to_pylist()):
            for x in asked:
                rows.append(i)
                anchors.append(x["anchor"])
                starts.append(x["start"])
                parts.append(texts[i][x["start"] : x["stop"]])
                crowded.append(x["crowded"])
        if rows:
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken),
                    batch.column(1).take(taken),
                    pa.array(anchors, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(parts, pa.binary()),
                    pa.array(crowded, pa.bool_()),
                ],
                names=["doc_id", "mark", "anchor", "start", "stretch", "crowded"],
            )


def _remover(texts_too: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"][: 5 + texts_too]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + texts_too]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(
                text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True
            ):
                cover = np.zeros(len(text) + 1, np.int32)
                for x in spans or []:
                    cover[x["begin"]] += 1
                    cover[x["end"]] -= 1
                gone = np.cumsum(cover)[: len(text)] > 0
                runs = int(np.count_nonzero(np.diff(np.append(0, gone.astype(np.int8))) == 1))
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if runs else text
                out.append((len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names
            )

    return remove


def _anchored(gram: int):
    """Crowded stretches: doc_id, mark, start, place of the anchor in the stretch, text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for anchor, text in zip(*(batch.column(k).to_pylist() for k in (3, 4)), strict=True):
                prefix = prefix_hashes(np.frombuffer(text, np.uint8))
                at = np.arange(len(text) - gram + 1)
                places.append(int(np.argmax(substring_hashes(prefix, at, at + gram).view(np.int64) == anchor)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(places, pa.int64()), batch.column(4)],
                names=["doc_id", "mark", "start", "at", "stretch"],
            )

    return find


def _pieces(size: int, gram: int, width: int):
    """Pieces of stretches: strings that begin from ``k * width`` bytes before the anchor on, ``width`` of them.

    Equal strings begin equally far before their anchors.  All strings of a piece hold the same bytes
    around the anchor, whose hash is the piece's key, so equal strings are in pieces of one key.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(4))
            start, place = (batch.column(k).to_numpy() for k in (2, 3))
            for a, b in blocks([len(x) for x in texts]):
                offsets = np.cumsum([0, *map(len, texts[a:b])])
                prefix = prefix_hashes(np.frombuffer(b"".join(texts[a:b]), np.uint8))
                last = np.diff(offsets) - size
                low = (place[a:b] - last) // width
                counts = place[a:b] // width - low + 1
                rows = np.repeat(np.arange(b - a), counts)
                k = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts - low, counts)
                near, far = k * width, np.minimum((k + 1) * width - 1, size - gram)
                at = place[a:b][rows]
                first, last = np.maximum(at - far, 0), np.minimum(at - near, last[rows])
                around = substring_hashes(
                    prefix, offsets[rows] + at - near, offsets[rows] + at - far + size
                )
                taken = pa.array(rows + a)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(taken),
                        batch.column(1).take(taken),
                        pa.array(start[a:b][rows] + first),
                        pa.array(at - first),
                        pa.array(
                            [texts[a + i][x : y + size] for i, x, y in zip(rows, first, last, strict=True)],
                            pa.binary(),
                        ),
                        pa.array(mix64(around + k.astype(np.uint64)).view(np.int64)),
                    ],
                    names=["doc_id", "mark", "start", "at", "stretch", "side"],
                )

    return cut


def crowded_spans(
    crowd: DataFrame, size: int = SIZE, gram: int = GRAM
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Spans of pieces of crowded stretches that repeat as a whole, and the pieces to be sorted.

    ``crowd`` has different stretches: doc_id, mark, start, at (the anchor's place in it), stretch.
    """
    kind = crowd.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "mark", "start", "at", "stretch"]
    schema = f"doc_id {kind}, mark long, start long, at long, stretch binary, side long"
    spans, pieces, width = [], [], size - gram + 1
    while width > 1 and not crowd.isEmpty():
        width = -(-width // CUTS)
        found = stored(crowd.select(*names).mapInArrow(_pieces(size, gram, width), schema), "suffix-pieces")
        kinds = stored(
            found.groupBy("side", "stretch").agg(
                F.count("*").alias("copies"),
                F.min(F.struct("doc_id", "mark", "start", "at")).alias("one"),
            ),
            "suffix-kinds",
        )
        spans.append(
            found.join(
                kinds.where("copies > 1").select("side", "stretch"), ["side", "stretch"], "left_semi"
            ).select(
                "doc_id",
                "mark",
                F.col("start").alias("begin"),
                (F.col("start") + F.octet_length("stretch")).alias("end"),
            )
        )
        if width == 1:  # different pieces are different strings
            break
        several = kinds.groupBy("side").agg(F.count("*").alias("kinds"), F.min("copies").alias("least"))
        several = several.where("kinds > 1 and least = 1")
        # at most one side for CROWD pieces, so a side with very many of them is no key of a shuffle
        crowds = F.broadcast(several.where(F.col("kinds") > CROWD).select("side"))
        few = several.where(F.col("kinds") <= CROWD).select("side")
        crowd = kinds.join(crowds, "side", "left_semi").select("one.*", "stretch")
        pieces.append(
            kinds.join(crowds, "side", "left_anti")
            .join(few, "side", "left_semi")
            .select("one.doc_id", "one.mark", "one.start", "stretch", "side")
        )
    return spans, pieces


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """doc_id, mark, begin, end of byte runs covered by repeated strings; runs may overlap."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(text.alias("text"), "doc_id", tag(text).alias("mark"))
    often = (
        rows.select("text")
        .mapInArrow(_finder(size, gram, False), "anchor long, n long")
        .groupBy("anchor")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select("anchor")
    )
    often = stored(often, "suffix-anchors")
    shared = stored(
        rows.mapInArrow(
            _finder(size, gram, True), f"anchor long, content long, doc_id {kind}, place long"
        ).join(often, "anchor", "left_semi"),
        "suffix-shared",
    )
    contents = stored(
        shared.groupBy("anchor", "content").agg(
            F.count("*").alias("copies"),
            F.min(F.struct("doc_id", "place")).alias("one"),
        ),
        "suffix-contents",
    )
    start, strings = F.shiftright("place", 32), F.shiftright("place", 24).bitwiseAND(255)
    equal = shared.join(
        contents.where("copies > 1").select("anchor", "content"), ["anchor", "content"], "left_semi"
    ).select(
        "doc_id",
        F.col("place").bitwiseAND((1 << 24) - 1).alias("mark"),
        start.alias("begin"),
        (start + strings + size - 1).alias("end"),
    )
    several = (
        contents.groupBy("anchor")
        .agg(F.count("*").alias("kinds"), F.min("copies").alias("least"))
        .where("kinds > 1 and least = 1")
        .select("anchor", (F.col("kinds") > CROWD).alias("crowded"))
    )
    asked = (
        contents.join(several, "anchor")
        .select("anchor", "crowded", "one.doc_id", F.col("one.place").alias("place"))
        .select(
            F.col("doc_id").alias("asked_id"),
            F.col("place").bitwiseAND((1 << 24) - 1).alias("asked_mark"),
            F.struct(
                "anchor",
                start.alias("start"),
                (start + strings + size - 1).alias("stop"),
                "crowded",
            ).alias("part"),
        )
        .groupBy("asked_id", "asked_mark")
        .agg(F.collect_list("part").alias("parts"))
    )
    parts = stored(
        docs.select("doc_id", tag(text).alias("mark"), text.alias("text"))
        .join(asked, F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("mark") == F.col("asked_mark")))
        .select("doc_id", "mark", "text", "parts")
        .mapInArrow(
            _cutter,
            f"doc_id {kind}, mark long, anchor long, start long, stretch binary, crowded boolean",
        ),
        "suffix-parts",
    )
    crowd = (
        parts.where("crowded")
        .select("doc_id", "mark", "start", "anchor", "stretch")
        .mapInArrow(_anchored(gram), f"doc_id {kind}, mark long, start long, at long, stretch binary")
    )
    whole, pieces = crowded_spans(crowd, size, gram)
    unsorted = parts.where("not crowded").select(
        "doc_id", "mark", "start", "stretch", F.col("anchor").alias("side")
    )
    for more in pieces:
        unsorted = unsorted.unionByName(more)
    total = unsorted.agg(F.sum(F.octet_length("stretch"))).first()[0] or 0
    buckets = int(total // BUCKET_BYTES + 1)
    found = (
        unsorted.withColumn("bucket", F.pmod(F.xxhash64("side"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(_sorter(size), f"doc_id {kind}, mark long, begin long, end long")
    )
    for more in [equal, *whole]:
        found = found.unionByName(more)
    return found


def without_repeats(
    docs: DataFrame, size: int = SIZE, gram: int = GRAM, texts_too: bool = True
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes.

    Texts are UTF-8 bytes, null is empty, and texts shorter than ``size`` lose nothing.  Rows that
    repeat a doc_id are documents of their own, and equal ones repeat each other.  Other columns are not
    read.  ``kept_bytes`` is left out if ``texts_too`` is false.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    found = (
        repeated_spans(docs, size, gram)
        .groupBy(F.col("doc_id").alias("span_id"), F.col("mark").alias("span_mark"))
        .agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    )
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return (
        docs.select("doc_id", tag(text).alias("mark"), text.alias("text"))
        .join(
            found,
            F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("mark") == F.col("span_mark")),
            "left",
        )
        .select("doc_id", "text", "spans")
        .mapInArrow(_remover(texts_too), schema + ", kept_bytes binary" * texts_too)
    )


def repeated_bytes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The digest columns of ``without_repeats``."""
    return without_repeats(docs, size, texts_too=False)
