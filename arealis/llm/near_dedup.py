"""Near-duplicate documents: circulant MinHash, banding and exact Jaccard verification.

Two permutations of 32-bit words make every signature coordinate: the first scatters the shingles,
the second, shifted circularly by k, gives coordinate k.  Sets that share a band are candidates.

Inside a band nobody compares all with all.  Every set is compared with one pivot (the set
that meets most others), which gives the difference D(u) to the pivot.  Two sets u and v that are similar enough without
both being linked to the pivot must share elements of D(u) and D(v): with
``d = |D(u)| + |D(v)| - 2 |D(u) & D(v)|`` the number of elements in which u and v differ, similarity
asks for ``d <= (1 - j) / (1 + j) * (|u| + |v|)``, and if D(u) and D(v) are disjoint then each of them
alone is that close to the pivot.  So a prefix of the differences, rarest elements first, finds every
remaining pair; how frequent a passage is in the family does not matter.  All links are confirmed on
full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import blocks, components, mix64, shingle_sets, stored, text_bytes

WIDTH = 5
#: Similarity in hundredths that links two documents.
PERCENT = 85
BANDS = 16
#: Coordinates of a band.  A pair at the threshold meets in some band but for 7 in a million.
ROWS = 4


def first_permutation(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit shingle hashes over the circle of 32-bit words."""
    return (mix64(x ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def second_permutation(x: np.ndarray) -> np.ndarray:
    """A bijection on 32-bit words, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def circulant_signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row per non-empty set: coordinate k is the least image under the k-shifted permutation."""
    offsets = np.cumsum([0, *map(len, sets)])[:-1]
    scattered = first_permutation(np.concatenate(sets))
    out = np.empty((len(sets), size), np.uint32)
    for k in range(size):
        shifted = scattered - np.uint32(k + 1)
        out[:, k] = np.minimum.reduceat(second_permutation(shifted), offsets)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(signatures), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signatures), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            key = mix64(key ^ signatures[:, k]) + np.uint64(k)
        keys[:, band] = key
    return keys.view(np.int64)


def set_keys(sets: list[np.ndarray]) -> list[bytes]:
    """128-bit order-free digests of whole sets."""
    offsets = np.cumsum([0, *map(len, sets)])[:-1]
    values = np.concatenate(sets)
    halves = [
        np.add.reduceat(mix64(values ^ np.uint64(salt)), offsets)
        for salt in (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)
    ]
    return [a + b for a, b in zip(*(map(int.to_bytes, h.tolist(), [8] * len(h)) for h in halves))]


def _signer(width: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in blocks([len(x) for x in texts]):
                sets = shingle_sets(texts[a:b], width)
                full = [s for s in sets if len(s)]
                keys: list[bytes | None] = [None] * len(sets)
                found: list[list[int] | None] = [None] * len(sets)
                if full:
                    held = iter(
                        zip(
                            set_keys(full),
                            band_keys(circulant_signatures(full, bands * rows), bands, rows).tolist(),
                            strict=True,
                        )
                    )
                    for i, s in enumerate(sets):
                        if len(s):
                            keys[i], found[i] = next(held)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(found, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands"],
                )

    return sign


def signatures(
    docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, set_key and band keys of every row; key and bands are null without words."""
    return docs.select("doc_id", "text").mapInArrow(
        _signer(width, bands, rows),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, set_key binary, "
        "bands array<long>",
    )


def _set_reader(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in blocks([len(x) for x in texts]):
                full = [s for s in shingle_sets(texts[a:b], width) if len(s)]
                if full:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(set_keys(full), pa.binary()),
                            pa.array([s.view(np.int64) for s in full], pa.list_(pa.int64())),
                        ],
                        names=["set_key", "shingles"],
                    )

    return read


def stars(sets: DataFrame) -> DataFrame:
    """Distinct (pivot, member) over all bands.

    The pivot of a band is its set that meets most others over all of its own bands: in a family of
    edited copies that is the text they were made from, which keeps the differences to it small.
    """
    banded = sets.select("set_key", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(banded.join(sizes, "band"), "near-bands")
    met = shared.groupBy("set_key").agg(F.sum("n").alias("met"))
    pivots = (
        shared.join(met, "set_key")
        .groupBy("band")
        .agg(F.max(F.struct("met", "set_key")).getField("set_key").alias("pivot"))
    )
    return (
        shared.join(pivots, "band")
        .where("set_key <> pivot")
        .select("pivot", F.col("set_key").alias("member"))
        .distinct()
    )


def compared(pairs: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Sizes, difference to the pivot and whether the pair is linked, from full sets."""
    members = shingles.select(F.col("set_key").alias("member"), F.col("shingles").alias("own"))
    pivots = shingles.select(F.col("set_key").alias("pivot"), F.col("shingles").alias("base"))
    only = F.array_except("own", "base")
    return (
        pairs.join(members, "member")
        .join(pivots, "pivot")
        .select(
            "pivot",
            "member",
            F.size("own").alias("n"),
            F.size("base").alias("n_pivot"),
            F.concat(only, F.array_except("base", "own")).alias("diff"),
            (F.size("own") - F.size(only)).alias("shared"),
        )
        .withColumn(
            "linked", F.expr(f"100 * shared >= {percent} * (n + n_pivot - shared)")
        )
        .drop("shared")
    )


def remaining_links(star: DataFrame, percent: int) -> DataFrame:
    """Links between members of one pivot of which at most one is linked to the pivot itself."""
    gap, total = 100 - percent, 100 + percent
    star = star.withColumn("pair_id", F.monotonically_increasing_id())
    star = stored(star, "near-star")
    open_ = (
        star.groupBy("pivot")
        .agg(F.count("*").alias("members"), F.min("linked").alias("all_linked"))
        .where("members > 1 and not all_linked")
        .select("pivot")
    )
    family = star.join(open_, "pivot", "left_semi").withColumn("size", F.size("diff"))
    elements = family.select(
        "pair_id", F.explode("diff").alias("el"), F.xxhash64("pivot", "el").alias("key")
    ).select("pair_id", "key")
    often = elements.groupBy("key").agg(F.count("*").alias("df"))
    # An element that no other member of the family differs in cannot be shared, but it counts
    # for the place of those behind it.
    ordered = (
        elements.join(often, "key")
        .groupBy("pair_id")
        .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("order"))
    )
    limits = family.select(
        "pair_id",
        "n",
        "size",
        "linked",
        # d is at most this against any partner that can be linked
        F.expr(f"floor({gap} * (n + n * 100 / {percent}) / {total})").alias("most"),
        F.expr(f"(size + {gap} * (n - n_pivot) / {total}) / 2").alias("near"),
    )
    places = (
        ordered.join(limits, "pair_id")
        .select("pair_id", "n", "size", "linked", "most", "near", F.posexplode("order").alias("p", "e"))
        .where("e.df > 1 and p <= most and (not linked or p <= near)")
        .select("pair_id", "n", "size", "linked", "p", F.col("e.key").alias("key"), "most")
    )
    places = stored(places, "near-prefix")
    left = places.where("2 * p <= most").drop("most")
    right = places.drop("most").select(
        "key", *(F.col(c).alias(f"{c}_2") for c in ("pair_id", "n", "size", "linked", "p"))
    )
    d = f"floor({gap} * (n + n_2) / {total})"
    pairs = (
        left.join(
            right,
            (left.key == right.key)
            & F.expr("pair_id <> pair_id_2 and not (linked and linked_2)")
            & F.expr(f"2 * p <= size - size_2 + {d} and 2 * p_2 <= size_2 - size + {d}"),
        )
        .select(
            F.least("pair_id", "pair_id_2").alias("i"), F.greatest("pair_id", "pair_id_2").alias("k")
        )
        .distinct()
    )
    sides = [
        family.select(
            F.col("pair_id").alias(name),
            *(F.col(c).alias(f"{c}_{name}") for c in ("pivot", "member", "n", "diff")),
        )
        for name in ("i", "k")
    ]
    return (
        pairs.join(sides[0], "i")
        .join(sides[1], "k")
        .where("pivot_i = pivot_k")
        .withColumn(
            "d", F.size("diff_i") + F.size("diff_k") - 2 * F.size(F.array_intersect("diff_i", "diff_k"))
        )
        .where(f"{total} * d <= {gap} * (n_i + n_k)")
        .select(F.col("member_i").alias("a"), F.col("member_k").alias("b"))
    )


def near_duplicates(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null and blank texts have no shingles and are linked with nothing.  Rows of equal text, also
    rows that share a doc_id, are one set; the component is named by its smallest doc_id, nulls last.
    A null doc_id without links keeps a null component.  Other columns of ``docs`` are not read.
    """
    signed = stored(signatures(docs, width, bands, rows), "near-signatures")
    sets = (
        signed.where("set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.first("bands").alias("bands"),
        )
    )
    pairs = stored(stars(sets), "near-pairs")
    wanted = pairs.select(F.explode(F.array("pivot", "member")).alias("set_key")).distinct()
    wanted = (
        sets.select("set_key", "first_id")
        .join(wanted, "set_key", "left_semi")
        .select(F.col("first_id").alias("wanted_id"))
        .distinct()
    )
    shingles = (
        docs.select("doc_id", "text")
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
        .select("text")
        .mapInArrow(_set_reader(width), "set_key binary, shingles array<long>")
        .dropDuplicates(["set_key"])
    )
    star = stored(compared(pairs, stored(shingles, "near-shingles"), percent), "near-compared")
    links = star.where("linked").select(F.col("pivot").alias("a"), F.col("member").alias("b"))
    joined = components(links.unionByName(remaining_links(star, percent)), "near")
    groups = (
        sets.select("set_key", "first_id")
        .join(joined, F.col("set_key") == F.col("node"), "left")
        .select("set_key", "first_id", F.coalesce("component", "set_key").alias("component"))
    )
    named = groups.join(
        groups.groupBy("component").agg(F.min("first_id").alias("component_id")), "component"
    ).select("set_key", "component_id")
    return (
        signed.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("set_key").isNull(), F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
