"""Shared by the operators of this subpackage: stored tables, folds, words, shingles, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.session import scratch_path

#: Bytes of text that one numpy pass works on; a longer document is a pass of its own.
BLOCK_BYTES = 1 << 20
#: Ranges of more bytes are hashed one by one.
LONG_RANGE = 1 << 10
#: Bytes that part words: space and 0x09 to 0x0D.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str | Column, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids fall into fold 0."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.crc32(text) % folds, F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling base and of its inverse modulo 2**64, at least n of each.

    Tables for whole blocks are kept; larger ones, for longer texts, are not.
    """
    if "up" in _powers and len(_powers["up"]) >= n:
        return _powers["up"][:n], _powers["down"][:n]
    size, made = max(n, BLOCK_BYTES + 2), {}
    for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
        row = np.full(size, base, np.uint64)
        row[0] = 1
        with np.errstate(over="ignore"):
            made[name] = np.multiply.accumulate(row)
    if size <= 2 * BLOCK_BYTES:
        _powers.update(made)
    return made["up"][:n], made["down"][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences, times an inverse power, are hashes of substrings."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def substring_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    with np.errstate(over="ignore"):
        return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time through a mixer; long ranges by BLAKE2.

    Unlike the rolling hashes above these are not linear, so no family of texts hashes alike.
    """
    size = (end - start).astype(np.int64)
    out = mix64(size.astype(np.uint64) + np.uint64(_BASE))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    window = np.lib.stride_tricks.sliding_window_view(padded, 8)
    alive = np.flatnonzero((size > 0) & (size <= LONG_RANGE))
    at = 0
    while len(alive):
        chunk = window[start[alive] + at].copy().view("<u8").ravel()
        left = np.minimum(size[alive] - at, 8).astype(np.uint64)
        chunk &= np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left)
        with np.errstate(over="ignore"):
            out[alive] = mix64(out[alive] * np.uint64(_BASE) + mix64(chunk + np.uint64(at + 1)))
        at += 8
        alive = alive[size[alive] > at]
    for i in np.flatnonzero(size > LONG_RANGE):
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(sizes: list[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes together, or one longer row."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size + 1
    if start < len(sizes):
        yield start, len(sizes)


def words(
    texts: list[bytes], apart: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the lower-cased texts, start and end of every word, each text's first word.

    ``apart`` says which bytes part words; blanks must be among them.
    """
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    space = apart[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    start, end = edge[0::2], edge[1::2]
    firsts = np.cumsum([0, *(len(x) + 1 for x in texts)])
    return data, start, end, np.searchsorted(start, firsts)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles.

    A text of fewer words gives its whole sequence as one shingle, one without words none.
    """
    data, start, end, first = words(texts)
    found = span_hashes(data, start, end)
    factors = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        if len(found) >= width:
            rows = len(found) - width + 1
            sums = found[:rows] * factors[0]
            for k in range(1, width):
                sums += found[k : k + rows] * factors[k]
            sums = mix64(sums)
        else:
            sums = found[:0]
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                out.append(np.unique(sums[a : b - width + 1]))
            elif b > a:
                short = np.sum(found[a:b] * factors[: b - a]) + np.uint64(b - a)
                out.append(mix64(np.array([short], np.uint64)))
            else:
                out.append(found[:0])
    return out


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of the edges (a, b), as (node, component) with the smallest node.

    Alternates the large-star and small-star steps until no edge changes; the minimum of a node's
    neighbours folds before the shuffle, so a hub is not collected anywhere.  Nodes without an
    edge are not in the result.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        f"{label}-edges",
    )
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, f"{label}-round")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = tuple(found)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
