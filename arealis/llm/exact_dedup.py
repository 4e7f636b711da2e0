"""Exact duplicates: counting quotient filters per partition, merged, then byte verification.

Every partition puts the fingerprints of its texts into counting quotient filters, one for each range
of the leading bits.  A filter keeps each fingerprint as quotient and remainder: the run lengths of the
quotients in unary bits, the remainders in sorted order, and counters for those above one.  Filters of
one range merge without loss, because quotient and remainder give the fingerprint back.  Only texts
whose fingerprint is counted more than once are compared byte by byte.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import stored

#: Bits of a fingerprint behind the leading bits that name its range.
TAIL_BITS = 40
#: Fingerprints that a range holds on average.
RANGE_SIZE = 1 << 18


def pack_filter(tails: np.ndarray, counts: np.ndarray) -> bytes:
    """A counting quotient filter over sorted distinct ``TAIL_BITS``-bit fingerprints."""
    quotient_bits = min(24, max(1, int(len(tails) - 1).bit_length()))
    remainder_bits = np.uint64(TAIL_BITS - quotient_bits)
    runs = np.bincount((tails >> remainder_bits).astype(np.int64), minlength=1 << quotient_bits)
    unary = np.zeros(len(tails) + len(runs), np.uint8)
    unary[np.cumsum(runs + 1) - 1] = 1
    width = (TAIL_BITS - quotient_bits + 7) // 8
    remainders = (tails & ((np.uint64(1) << remainder_bits) - np.uint64(1))).astype("<u8")
    more = np.flatnonzero(counts > 1)
    return b"".join(
        [
            struct.pack("<BII", quotient_bits, len(tails), len(more)),
            np.packbits(unary).tobytes(),
            remainders.view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
            more.astype("<u4").tobytes(),
            counts[more].astype("<u8").tobytes(),
        ]
    )


def unpack_filter(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints in sorted order and their counts."""
    quotient_bits, n, n_more = struct.unpack_from("<BII", data)
    at = struct.calcsize("<BII")
    slots = n + (1 << quotient_bits)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, (slots + 7) // 8, at), count=slots)
    at += (slots + 7) // 8
    width = (TAIL_BITS - quotient_bits + 7) // 8
    parts = np.zeros((n, 8), np.uint8)
    parts[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    quotients = np.cumsum(unary)[unary == 0].astype(np.uint64)
    tails = (quotients << np.uint64(TAIL_BITS - quotient_bits)) | parts.view("<u8")[:, 0]
    counts = np.ones(n, np.int64)
    more = np.frombuffer(data, "<u4", n_more, at)
    counts[more] = np.frombuffer(data, "<u8", n_more, at + 4 * n_more)
    return tails, counts


def merge_filters(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    tails, counts = zip(*map(unpack_filter, filters), strict=True)
    merged, place = np.unique(np.concatenate(tails), return_inverse=True)
    total = np.zeros(len(merged), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return merged, total


def _builder(range_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        if not held:
            return
        found, counts = np.unique(
            np.concatenate(held).view(np.uint64) >> np.uint64(64 - range_bits - TAIL_BITS),
            return_counts=True,
        )
        ranges = (found >> np.uint64(TAIL_BITS)).astype(np.int64)
        tails = found & np.uint64((1 << TAIL_BITS) - 1)
        names, starts = np.unique(ranges, return_index=True)
        ends = [*starts[1:].tolist(), len(ranges)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int64()),
                pa.array(
                    [pack_filter(tails[a:b], counts[a:b]) for a, b in zip(starts, ends)], pa.binary()
                ),
            ],
            names=["range", "filter"],
        )

    return build


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    tails, counts = merge_filters(list(pdf["filter"]))
    tails = tails[counts > 1].astype(np.int64)
    return pd.DataFrame({"range": np.full(len(tails), pdf["range"].iloc[0]), "tail": tails})


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty.  The largest doc_id of equal texts stays, null ids last; rows that
    repeat both doc_id and text are counted and flagged alike.  Other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select("doc_id", F.xxhash64(text).alias("print"), F.sha2(text, 256).alias("text_sha256")),
        "exact-prints",
    )
    range_bits = max(4, min(20, (rows.count() // RANGE_SIZE).bit_length()))
    shift = 64 - range_bits
    of_range = F.shiftrightunsigned("print", shift)
    of_tail = F.shiftrightunsigned("print", shift - TAIL_BITS).bitwiseAND((1 << TAIL_BITS) - 1)
    repeated = (
        rows.select("print")
        .mapInArrow(_builder(range_bits), "range long, filter binary")
        .groupBy("range")
        .applyInPandas(_repeated, "range long, tail long")
    )
    repeated = stored(repeated, "exact-repeated")
    same = (
        docs.select("doc_id", text.alias("text"))
        .withColumn("print", F.xxhash64("text"))
        .withColumns({"range": of_range, "tail": of_tail})
        .join(repeated, ["range", "tail"], "left_semi")
        .groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(
            F.xxhash64("text").alias("print"),
            F.sha2("text", 256).alias("text_sha256"),
            "keep_id",
            "group_size",
        )
    )
    return (
        rows.join(same, ["print", "text_sha256"], "left")
        .select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id"))
            .otherwise(F.col("keep_id"))
            .alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            "text_sha256",
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    )
