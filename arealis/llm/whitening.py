"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Entries are read as whole numbers ``floor(scale * entry)``, so sums and scatter are exact whatever the
partitions.  Tasks centre by the rounded mean before they multiply; what rounding the mean leaves over
is taken out exactly on the driver, which holds one matrix of dimensions x dimensions and no row.  With
P the pivoting, ``P' A P = L L'``; right rotations make the columns of L orthogonal.  Their squared norms
are the eigenvalues of A and the normalised columns its components, and A itself is never rotated.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import stored

SCALE = 256
COMPONENTS = 4
#: Whole numbers up to this size keep sums of products within 38 digits for 2**44 vectors.
LARGEST = 1 << 40
#: Numbers that one numpy product works on.
CELLS = 1 << 21
SWEEPS = 60

_EPS = np.finfo(float).eps


def whole_entries(vector: str, scale: int = SCALE) -> Column:
    """The vector as whole numbers; null if it is null or has an entry without such a number."""
    entry = lambda c: c.cast("double") * F.lit(float(scale))
    # NaN compares as larger than every number
    fits = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(entry(c)) <= F.lit(float(LARGEST)), F.lit(False)))
    return F.when(fits, F.transform(F.col(vector), lambda c: F.floor(entry(c)) + F.lit(0).cast("long")))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length as matrices of at most CELLS numbers, with their positions."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        held = np.flatnonzero(sizes == size)
        step = max(1, CELLS // max(1, int(size)))
        for a in range(0, len(held), step):
            at = held[a : a + step]
            yield at, flat[starts[at][:, None] + np.arange(size)]


def _products(x: np.ndarray) -> np.ndarray:
    """x' x of whole numbers, exactly: in doubles where they hold every sum, else in Python integers."""
    bound = int(np.abs(x).max(initial=0)) ** 2 * max(1, len(x))
    if bound < 2**53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T @ y


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}
    for batch in batches:
        for at, x in _matrices(batch.column(0)):
            held = totals.setdefault(x.shape[1], [0, 0])
            held[0] += len(at)
            held[1] = held[1] + x.sum(axis=0).astype(object)  # at most 2**21 numbers below 2**41
    for size, (n, s) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([size] * size, pa.int32()),
                pa.array(range(size), pa.int32()),
                pa.array([n] * size, pa.int64()),
                pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0)),
            ],
            names=["size", "i", "n", "s"],
        )


def _scatter(centres: dict[int, np.ndarray]):
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                size = x.shape[1]
                totals[size] = totals.get(size, 0) + _products(x - centres[size])
        for size, m in totals.items():
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(i), size), pa.int32()),
                    pa.array(i, pa.int32()),
                    pa.array(j, pa.int32()),
                    pa.array([Decimal(int(v)) for v in m[i, j]], pa.decimal128(38, 0)),
                ],
                names=["size", "i", "j", "s"],
            )

    return partial


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pivots and the lower trapezoidal factor of ``a[pivots][:, pivots]``, one column per rank.

    A diagonal entry counts as used up when what is left of it is rounding of what it was, so
    badly scaled dimensions keep their directions.
    """
    left = np.array(a, float)
    first = np.diag(left).copy()
    d = len(left)
    order, columns = np.arange(d), []
    for k in range(d):
        diagonal = np.diag(left)
        alive = np.where(diagonal[k:] > 8 * d * _EPS * first[order[k:]], diagonal[k:], -1.0)
        p = k + int(np.argmax(alive))
        if alive[p - k] <= 0:
            break
        if p != k:
            left[[k, p]] = left[[p, k]]
            left[:, [k, p]] = left[:, [p, k]]
            order[[k, p]] = order[[p, k]]
            for column in columns:
                column[[k, p]] = column[[p, k]]
        column = np.zeros(d)
        column[k:] = left[k:, k] / np.sqrt(left[k, k])
        left[k:, k:] -= np.outer(column[k:], column[k:])
        columns.append(column)
    return order, np.stack(columns, 1) if columns else np.zeros((d, 0))


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs (a tournament)."""
    ring = list(range(n + n % 2))
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        pairs = [
            (min(a, b), max(a, b))
            for a, b in zip(ring[:half], reversed(ring[half:]), strict=True)
            if max(a, b) < n
        ]
        if pairs:
            yield np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Squared column norms, falling, and normalised columns of the factor made orthogonal by rotations."""
    g = np.array(factor.T, float, order="C")  # a row here is a column of the factor
    rounds = list(_rounds(len(g)))
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            x, y = g[p], g[q]
            alpha, beta = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
            gamma = np.einsum("ij,ij->i", x, y)
            cosine = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, float(cosine.max()))
            turn = cosine > _EPS
            if not turn.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                zeta = (beta - alpha) / (2 * gamma)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)[:, None]
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            g[p], g[q] = c * x - s * y, s * x + c * y
        if worst <= 4 * g.shape[1] * _EPS:
            break
    else:
        raise RuntimeError(f"columns are not orthogonal after {sweeps} sweeps")
    norms = np.einsum("ij,ij->i", g, g)
    order = np.argsort(-norms, kind="stable")
    return norms[order], (g[order] / np.sqrt(norms[order])[:, None]).T


class Whitener:
    """Mean, components and eigenvalues of the distinct vectors of one length."""

    def __init__(self, n: int, sums: list[int], scatter: list[list[Fraction]], components: int) -> None:
        self.n, self.sums = n, sums
        covariance = np.array([[float(v / n) for v in row] for row in scatter])
        order, factor = pivoted_cholesky(covariance)
        values, vectors = one_sided_jacobi(factor)
        self.values = values[:components]
        self.vectors = np.zeros((len(sums), len(self.values)))
        self.vectors[order] = vectors[:, :components]
        # either sign is right; the largest entry is made positive so that reruns agree
        top = np.abs(self.vectors).argmax(axis=0) if len(self.values) else np.empty(0, int)
        self.vectors *= np.where(self.vectors[top, np.arange(len(top))] < 0, -1.0, 1.0)
        trace = sum((scatter[i][i] for i in range(len(sums))), Fraction(0)) / n
        self.explained = self.values / float(trace) if trace else self.values

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centred = x - np.array([float(Fraction(s, self.n)) for s in self.sums])
        return centred @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 per row, exactly; null beyond 64 bits."""
        far = self.n * (int(np.abs(x).max(initial=0))) + max(map(abs, self.sums), default=0)
        if max(1, len(self.sums)) * far * far < 2**63:
            shifted = self.n * x - np.array(self.sums, np.int64)
            return (shifted * shifted).sum(axis=1).tolist()
        shifted = self.n * x.astype(object) - np.array(self.sums, object)
        found = (shifted * shifted).sum(axis=1) if x.shape[1] else [0] * len(x)
        return [int(v) if v < 2**63 else None for v in found]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """One whitener per length of vector from the column ``x`` of distinct whole vectors."""
    sums: dict[int, dict[int, tuple[int, int]]] = {}
    totals = distinct.mapInArrow(_sums, "size int, i int, n long, s decimal(38,0)").groupBy("size", "i")
    for r in totals.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        sums.setdefault(r.size, {})[r.i] = (r.n, int(r.s))
    counts = {size: held[0][0] for size, held in sums.items()}
    # rounded means: near enough that products stay small, and whole so that they stay exact
    centres = {
        size: np.array([round(Fraction(held[i][1], counts[size])) for i in range(size)], np.int64)
        for size, held in sums.items()
    }
    products: dict[int, dict[tuple[int, int], int]] = {}
    cells = distinct.mapInArrow(_scatter(centres), "size int, i int, j int, s decimal(38,0)")
    for r in cells.groupBy("size", "i", "j").agg(F.sum("s").alias("s")).collect():
        products.setdefault(r.size, {})[r.i, r.j] = int(r.s)
    out = {}
    for size, held in products.items():
        n = counts[size]
        s = [held_sum for _, held_sum in (sums[size][i] for i in range(size))]
        rest = [s[i] - n * int(centres[size][i]) for i in range(size)]
        scatter = [
            [held[min(i, j), max(i, j)] - Fraction(rest[i] * rest[j], n) for j in range(size)]
            for i in range(size)
        ]
        out[size] = Whitener(n, s, scatter, components)
    return out


def _identity_errors(distinct: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """Per length the largest entry of the whitened vectors' covariance minus the identity."""
    most = max((len(m.values) for m in models.values()), default=0)
    if not most:
        return {}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                model = models.get(x.shape[1])
                if model is None or not len(model.values):
                    continue
                w = np.zeros((len(x), most))
                w[:, : len(model.values)] = model.whitened(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), x.shape[1]), pa.int32()), *(pa.array(c) for c in w.T)],
                    names=["size", *(f"w{k}" for k in range(most))],
                )

    schema = ", ".join(["size int", *(f"w{k} double" for k in range(most))])
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    covariances = distinct.mapInArrow(project, schema).groupBy("size").agg(
        *(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)
    )
    return {
        r["size"]: max(
            abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if j < len(models[r["size"]].values)
        )
        for r in covariances.collect()
    }


def whitened(
    vectors: DataFrame,
    vector: str = "embedding",
    identity: str = "vec_id",
    scale: int = SCALE,
    components: int = COMPONENTS,
) -> DataFrame:
    """Row by row the first ``components`` whitened coordinates.

    One row per usable row of ``vectors`` and component: the identity, component, n, deviation,
    whitened, explained, identity_error.  Rows whose vector is null or holds a null, non-finite or
    larger entry than 2**40 / scale have no part.  Rows may repeat ids or vectors, ids may be null;
    the fit takes every distinct vector once.  Components beyond the rank do not exist: a single
    distinct vector, or vectors without entries, give no rows.  Vectors of another length are
    another space with a fit of its own.  Eigenvalues that are equal leave their components free; the choice is
    the same for all rows and runs.  A deviation beyond 64 bits is null.  Other columns are ignored.
    """
    usable = vectors.select(F.col(identity).alias("id"), whole_entries(vector, scale).alias("x")).where(
        F.size("x") > 0
    )
    distinct = stored(usable.select("x").distinct(), "whitening-fit")
    models = fit(distinct, components)
    errors = _identity_errors(distinct, models)
    kind = vectors.schema[identity].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast((models, errors))  # matrices of the model

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, errors = shared.value
        for batch in batches:
            for at, x in _matrices(batch.column(1)):
                model = models.get(x.shape[1])
                k = 0 if model is None else len(model.values)
                if not k:
                    continue
                repeat = np.repeat(np.arange(len(at)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at[repeat])),
                        pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                        pa.array(np.full(len(repeat), model.n), pa.int64()),
                        pa.array(model.deviation(x), pa.int64()).take(pa.array(repeat)),
                        pa.array(model.whitened(x).ravel()),
                        pa.array(np.tile(model.explained, len(at))),
                        pa.array(np.full(len(repeat), errors[x.shape[1]])),
                    ],
                    names=[identity, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return usable.mapInArrow(
        rows,
        f"`{identity}` {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double",
    )
