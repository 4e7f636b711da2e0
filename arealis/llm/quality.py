"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Small boosted trees propose rules, one for the path to each of their nodes; a lasso logistic
regression keeps few of them with a weight; the kept rules are compiled into one Spark column over the
statistics, which numpy takes in one pass over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from arealis.llm.common import BLOCK_BYTES, fold, stored, text_bytes

THRESHOLD = 0.7
HELD_OUT = 2
#: Bound of the labelled rows that the rules are learnt from.
SAMPLE = 20_000
TREES = 60
DEPTH = 3
CUTS = 48
STEP = 0.2
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)

#: A conjunction: (statistic, above, bound) with above meaning ``>`` and else ``<=``.
Rule = tuple[tuple[str, bool, float], ...]


_CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "symbols": b"#$%&*@^~=+_<>{}[]\\/",
    "bars": b"|",
    "exclaimed": b"!?",
    "stops": b".,;:",
    "digits": b"0123456789",
    "blanks": b" \t\n\r",
    "breaks": b"\n",
}
NAMES = ["length", *_CLASSES, "word_length", "distinct_words", "distinct_lines"]
_MEMBER = np.stack([np.isin(np.arange(256), list(x)) for x in _CLASSES.values()], 1).astype(float)


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row per text, a column per name in ``NAMES``; every share of nothing is 0."""
    counts = np.zeros((len(texts), 256))
    split = np.empty((len(texts), 4))
    for i, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        for a in range(0, len(data), BLOCK_BYTES):
            counts[i] += np.bincount(data[a : a + BLOCK_BYTES], minlength=256)
        tokens, lines = text.split(), text.split(b"\n")  # at the bytes of BLANKS
        split[i] = len(tokens), len(set(tokens)), len(lines), len(set(lines))
    # characters start at every byte but the continuations of UTF-8
    length = counts.sum(1) - counts[:, 0x80:0xC0].sum(1)
    size = np.maximum(length, 1)
    n_tokens, n_lines = np.maximum(split[:, 0], 1), split[:, 2]
    return np.column_stack(
        [
            np.log1p(length),
            counts @ _MEMBER / size[:, None],
            size / n_tokens,
            split[:, 1] / n_tokens,
            split[:, 3] / n_lines,
        ]
    )


def measured(df: DataFrame) -> DataFrame:
    """The table with the statistics of ``text``, its last column, in place of it."""
    kept = df.drop("text").schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(text_bytes(batch.column(len(kept))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(found[:, k]) for k in range(len(NAMES)))],
                names=[*kept.names, *NAMES],
            )

    schema = StructType([*kept, *(StructField(n, DoubleType()) for n in NAMES)])
    return df.mapInArrow(rows, schema)


@dataclass(frozen=True)
class RuleModel:
    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        """The score over columns named like the statistics."""

        def holds(rule: Rule) -> Column:
            parts = [F.col(n) > b if above else F.col(n) <= b for n, above, b in rule]
            return reduce(lambda a, b: a & b, parts)

        terms = [F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.weights]
        z = reduce(lambda a, b: a + b, terms, F.lit(self.bias))
        return 1 / (1 + F.exp(-z))


def grow(binned: np.ndarray, residual: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int):
    """A regression tree as nested (feature, bin, left, right), or a leaf value."""
    total, mass = residual[rows].sum(), weight[rows].sum()
    best = (1e-9, -1, -1)
    if depth and len(rows) >= 20:
        for f in range(binned.shape[1]):
            g = np.cumsum(np.bincount(binned[rows, f], residual[rows], CUTS + 1))[:-1]
            h = np.cumsum(np.bincount(binned[rows, f], weight[rows], CUTS + 1))[:-1]
            n = np.cumsum(np.bincount(binned[rows, f], minlength=CUTS + 1))[:-1]
            gain = g**2 / (h + 1) + (total - g) ** 2 / (mass - h + 1) - total**2 / (mass + 1)
            gain[(n < 5) | (len(rows) - n < 5)] = 0
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), f, at)
    if best[1] < 0:
        return total / (mass + 1)
    left = binned[rows, best[1]] <= best[2]
    return (
        best[1],
        best[2],
        grow(binned, residual, weight, rows[left], depth - 1),
        grow(binned, residual, weight, rows[~left], depth - 1),
    )


def tree_values(tree, binned: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(binned), tree)
    f, at, left, right = tree
    return np.where(binned[:, f] <= at, tree_values(left, binned), tree_values(right, binned))


def paths(tree, names: list[str], edges: list[np.ndarray], head: Rule = ()) -> list[Rule]:
    """The conjunctions that lead to every node below the root."""
    if not isinstance(tree, tuple):
        return []
    f, at, left, right = tree
    out = []
    for above, below in ((False, left), (True, right)):
        rule = (*head, (names[f], above, float(edges[f][at])))
        out += [rule, *paths(below, names, edges, rule)]
    return out


def applied(rules: list[Rule], columns: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones((len(next(iter(columns.values()))), len(rules)))
    for k, rule in enumerate(rules):
        for name, above, bound in rule:
            out[:, k] *= columns[name] > bound if above else columns[name] <= bound
    return out


def patterns(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows of a binary matrix, the mean label of each, and how many rows it stands for."""
    bits = np.packbits(x.astype(bool), axis=1)
    _, first, back, mass = np.unique(bits, axis=0, return_index=True, return_inverse=True, return_counts=True)
    return x[first], np.bincount(back.ravel(), y, len(mass)) / mass, mass


def lasso_logistic(
    x: np.ndarray,
    y: np.ndarray,
    mass: np.ndarray,
    penalty: float,
    start: np.ndarray | None = None,
    rounds: int = 300,
    settled: float = 1e-4,
) -> np.ndarray:
    """Weights, the bias last and free of penalty, by accelerated proximal gradient.

    ``mass`` is the number of sample rows behind a row. Ends when no weight moves by ``settled``.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1]) if start is None else start.copy()
    share = mass / mass.sum()
    vector = np.ones(x.shape[1])
    for _ in range(20):
        vector = x.T @ (share * (x @ vector))
        norm = np.linalg.norm(vector)
        vector /= norm
    rate, z, t = 4 / norm, w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ z, -30, 30)))
        new = z - rate * (x.T @ (share * (p - y)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        moved = np.abs(new - w).max()
        z, w = new + (old - 1) / t * (new - w), new
        if moved < settled:
            break
    return w


def fit_rules(columns: dict[str, np.ndarray], y: np.ndarray, check: np.ndarray) -> RuleModel:
    """Rules and weights; ``check`` marks the rows that choose the penalty."""
    names, y = list(columns), y.astype(float)
    share = min(0.999, max(0.001, y.mean() if len(y) else 0.5))
    base = float(np.log(share / (1 - share)))
    if len(y) < 20 or y.min() == y.max():
        return RuleModel(base, ())
    edges = [np.unique(np.quantile(columns[n], np.linspace(0, 1, CUTS + 2)[1:-1])) for n in names]
    binned = np.stack(
        [np.searchsorted(e, columns[n], side="left") for n, e in zip(names, edges, strict=True)], 1
    )
    rng, z, rules = np.random.default_rng(7), np.full(len(y), base), {}
    fit = np.flatnonzero(~check) if (~check).any() else np.arange(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        rows = rng.choice(fit, max(1, len(fit) * 2 // 3), replace=False)
        tree = grow(binned, y - p, p * (1 - p), rows, DEPTH)
        z += STEP * tree_values(tree, binned)
        rules |= dict.fromkeys(paths(tree, names, edges))
    if not rules:
        return RuleModel(base, ())
    found = list(rules)
    x = applied(found, columns)
    # of rules that hold for the same rows the first, a shortest one, stands for all
    _, first = np.unique(np.packbits(x.astype(bool), axis=0), axis=1, return_index=True)
    first.sort()
    found, x = [found[k] for k in first], x[:, first]
    held = patterns(x[fit], y[fit])
    best, start = (np.inf, None), None
    for penalty in PENALTIES:
        start = lasso_logistic(*held, penalty, start)
        q = x[check] @ start[:-1] + start[-1] if check.any() else x @ start[:-1] + start[-1]
        loss = np.logaddexp(0, np.where(y[check] if check.any() else y, -q, q)).mean()
        if loss < best[0] - 1e-4:
            best = (loss, start)
    w = best[1]
    kept = np.flatnonzero(np.abs(w[:-1]) > 1e-6)
    return RuleModel(float(w[-1]), tuple((found[k], float(w[k])) for k in kept))


def train(docs: DataFrame, labels: DataFrame) -> RuleModel:
    """From at most about ``SAMPLE`` labelled rows outside the held-out fold, drawn by their doc_id."""
    known = (
        labels.where((fold("doc_id") != HELD_OUT) & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("known_id"))
        .agg(F.max("quality").alias("quality"))
        .where("known_id is not null")
    )
    n = known.count()
    place = F.conv(F.substring(F.md5(F.col("known_id").cast("string")), 1, 8), 16, 10).cast("double")
    known = known.where(place < 2.0**32 * SAMPLE / max(1, n))
    # the sample's bound bounds the broadcast; the texts of all documents stay where they are
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known), F.col("doc_id") == F.col("known_id"))
        .select("doc_id", "quality", "text")
    )
    data = stored(measured(rows), "quality-sample").orderBy("doc_id", *NAMES).toPandas()
    columns = {k: data[k].to_numpy(float) for k in NAMES}
    check = np.arange(len(data)) % 5 == 0
    return fit_rules(columns, data["quality"].to_numpy(), check)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null text counts as empty.  Without labels of both kinds the score is the share of good labels, or
    one half.  A null doc_id is scored and never learnt from; other columns are not read.
    """
    model = train(docs, labels)
    held_out = (fold("doc_id") == HELD_OUT).alias("held_out")
    return measured(docs.select("doc_id", held_out, "text")).select("doc_id", "held_out", model.column().alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
