"""Toxicity: non-negative positive-unlabelled learning on hashed words and word beginnings.

Confirmed toxic documents are the positives; everything else, whatever its label says, is unlabelled
text with an unknown share of toxic documents.  With class prior p and logistic loss the risk is
``p * R(positives, +) + max(0, R(unlabelled, -) - p * R(positives, -))``: what the unlabelled text seems to
lose for holding positives is taken back, and the bracket, which must not fall below zero in truth, is
pushed up again when a flexible model drives it there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import blocks, fold, prefix_hashes, stored, substring_hashes, text_bytes, words

DIMENSIONS = 1 << 20
#: Bytes of a word's beginning that make features besides the whole word.
BEGINNINGS = (4, 5, 6)
#: Bounds of the training sample: documents confirmed as toxic, and unlabelled ones.
POSITIVES = 4_000
UNLABELLED = 20_000
#: Features that the classifier keeps.
FEATURES = 4_096
THRESHOLD = 0.3
HELD_OUT = 2
STEPS = 400
RATE = 0.1
DECAY = 1e-4

_APART = np.zeros(256, bool)
_APART[:0x30] = _APART[0x3A:0x41] = _APART[0x5B:0x61] = _APART[0x7B:0x80] = True


def feature_bins(texts: list[bytes], keep: np.ndarray | None = None) -> list[np.ndarray]:
    """Per text the sorted distinct bins of its words and their beginnings; only kept ones if asked."""
    data, start, end, first = words(texts, _APART)
    prefix = prefix_hashes(data)
    owner = np.searchsorted(first[1:], np.arange(len(start)), side="right")
    bins, owners = [], []
    for salt, size in enumerate((None, *BEGINNINGS)):
        long = slice(None) if size is None else np.flatnonzero(end - start >= size)
        a = start[long]
        b = end[long] if size is None else a + size
        found = substring_hashes(prefix, a, b) + np.uint64(salt * 0x9E3779B1)
        found = ((found * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)
        mine = owner[long]
        if keep is not None:
            held = keep[found]
            found, mine = found[held], mine[held]
        bins.append(found)
        owners.append(mine)
    both = np.unique(np.concatenate(owners) * DIMENSIONS + np.concatenate(bins))
    cuts = np.searchsorted(both, np.arange(len(texts) + 1) * DIMENSIONS)
    return [both[a:b] % DIMENSIONS for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, DIMENSIONS), np.int32)
    for batch in batches:
        texts = text_bytes(batch.column(1))
        toxic = batch.column(0).to_pylist()
        for a, b in blocks([len(x) for x in texts]):
            for y, bins in zip(toxic[a:b], feature_bins(texts[a:b]), strict=True):
                totals[int(y), bins] += 1
    seen = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int64()), *(pa.array(totals[i, seen], pa.int64()) for i in (1, 0))],
        names=["bin", "toxic", "other"],
    )


def _sampler(names: np.ndarray):
    keep = np.zeros(DIMENSIONS, bool)
    keep[names] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in blocks([len(x) for x in texts]):
                found = [np.searchsorted(names, x) for x in feature_bins(texts[a:b], keep)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(found, pa.list_(pa.int64()))],
                    names=["toxic", "features"],
                )

    return rows


def fit_nnpu(
    rows: list[np.ndarray],
    positive: np.ndarray,
    n_features: int,
    prior: float,
    steps: int = STEPS,
    rate: float = RATE,
    decay: float = DECAY,
    floor: float = 0.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model over binary features by non-negative PU risk (Adam)."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.empty(0, np.int64)
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    weights = np.zeros(n_features + 1)
    weights[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        z = weights[-1] + np.bincount(owner, weights[column], len(rows))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # the loss of calling a row negative is -log(1 - p)
        minus = np.logaddexp(0, z)
        rest = minus[~positive].sum() / n_u - prior * minus[positive].sum() / n_p
        slope = np.where(positive, -prior * p / n_p, p / n_u)
        if rest >= floor:
            slope = slope + np.where(positive, prior * (p - 1) / n_p, 0.0)
        else:
            slope = -slope
        grad = np.append(np.bincount(column, slope[owner], n_features), slope.sum())
        grad[:-1] += decay * weights[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        weights -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weights by bin and bias, from the rows outside the held-out fold; None without positives."""
    known = (
        labels.where((fold("doc_id") != HELD_OUT) & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("known_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = known.agg(F.count("*"), F.sum("toxic")).first()
    if not sizes[0] or not sizes[1]:
        return None
    prior = min(0.9, max(1e-4, sizes[1] / sizes[0]))
    n_docs = docs.count()
    def place(identity: str) -> Column:
        return F.conv(F.substring(F.md5(F.col(identity).cast("string")), 1, 8), 16, 10).cast("double") / 2**32

    usable = docs.select("doc_id", "text").where((fold("doc_id") != HELD_OUT) & F.col("doc_id").isNotNull())
    # drawn on ids alone: the sample's bound bounds the broadcast, and no text is shuffled
    chosen = known.where((F.col("toxic") == 1) & (place("known_id") < POSITIVES / sizes[1])).select("known_id")
    drawn_rows = (
        usable.join(F.broadcast(chosen), F.col("doc_id") == F.col("known_id"), "left")
        # the unlabelled rows stand for all text, so confirmed documents are among them as well
        .withColumn("in_p", F.col("known_id").isNotNull())
        .withColumn("in_u", place("doc_id") < UNLABELLED / max(1, n_docs))
        .withColumn("toxic", F.explode(F.array(F.when(F.col("in_p"), 1), F.when(F.col("in_u"), 0))))
        .where("toxic is not null")
        .select("toxic", "text")
    )
    sample = stored(drawn_rows, "toxicity-sample")
    drawn = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = drawn.get(1, 0), drawn.get(0, 0)
    if not n_p or not n_u:
        return None
    counted = stored(
        sample.mapInArrow(_counter, "bin long, toxic long, other long")
        .groupBy("bin")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")),
        "toxicity-counts",
    )
    # A feature is at least as frequent in all text as the toxic share of it alone makes it, so its
    # frequency bounds that share, however the labelled rows were chosen.
    bound = (
        counted.where((F.col("toxic") >= 10) & (F.col("toxic") >= 0.05 * n_p))
        .agg(F.min((F.col("other") + 2 * F.sqrt(F.col("other") + 1)) / n_u / (F.col("toxic") / n_p)))
        .first()[0]
    )
    prior = max(1e-4, min(prior, bound or prior))
    in_p, in_u = F.col("toxic") / n_p, F.col("other") / n_u
    in_n = F.greatest((in_u - prior * in_p) / (1 - prior), F.lit(0.0))
    chance = in_n + 1.0 / n_u
    lift = in_p / (in_n + 3.0 / n_u)
    # how many standard deviations the positives lie above what chance gives
    sure = (in_p - chance) / F.sqrt(chance / n_p)
    chosen = (
        counted.where((F.col("toxic") >= 3) & (lift > 3) & (sure > 5))
        .orderBy((F.log(lift) * F.col("toxic")).desc(), "bin")
        .limit(FEATURES)
    )
    names = np.sort(np.array([r.bin for r in chosen.collect()], np.int64))
    held = sample.mapInArrow(_sampler(names), "toxic int, features array<long>").collect()
    weights, bias = fit_nnpu(
        [np.array(r.features, np.int64) for r in held],
        np.array([r.toxic == 1 for r in held]),
        len(names),
        prior,
    )
    dense = np.zeros(DIMENSIONS, np.float32)
    dense[names] = weights
    return dense, bias


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    The score sees the text alone; null counts as empty and has the score of a text without known
    features.  Without confirmed toxic documents every score is 0.  Rows that repeat a doc_id are
    scored one by one; a null doc_id is scored and never learnt from.
    """
    model = train(docs, labels)
    held_out = (fold("doc_id") == HELD_OUT).alias("held_out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = docs.select("doc_id", held_out, "text")
    if model is None:
        return base.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        keep = weights != 0
        for batch in batches:
            texts = text_bytes(batch.column(2))
            out = np.empty(len(texts))
            for a, b in blocks([len(x) for x in texts]):
                for i, bins in enumerate(feature_bins(texts[a:b], keep), a):
                    out[i] = bias + float(weights[bins].sum())
            out = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(out),
                    pa.array((out >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return base.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
