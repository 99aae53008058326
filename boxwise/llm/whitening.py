"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Vectors become integers, x = floor(scale * c) + shift, and the distinct ones are the
fit list.  Its covariance V (divisor n) comes from one pass that centres before it
multiplies: (n * x - S) / n, with n * x - S an exact integer.  V is factored by a
Cholesky decomposition with diagonal pivots, V = G G^T with G of as many columns as V
has rank, and one-sided Jacobi rotations make the columns of G orthogonal: their squared
norms are the eigenvalues of V, the normalised columns its unit eigenvectors.  V itself
is never diagonalised, so small eigenvalues keep their relative precision.

Spark does the work that grows with the rows: the distinct vectors by a hash
aggregation (equal vectors meet map-side, so a hot one costs nothing), the sums and the
scatter matrix as one partial result a task, combined in two levels.  The driver gets
about the square root of the number of tasks of d x d partial sums, and factors one
d x d matrix.

Defined results: rows whose vector is null, holds a null, NaN or infinite entry, or an
entry whose x does not fit a long are left out, as are vectors of another length than
the commonest one (of equally common lengths the largest); repeated rows and ids count
once in the fit and get a row each; components with no variance are left out, so a
table of equal vectors, and an empty table, give no rows; a deviation that does not fit a
long is null; very long vectors cost d^2 memory in a task; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.session import materialize

SCALE, SHIFT = 64, 1_000_000
HALF = 31                                            # x is summed in two halves, so no task's sum overflows


# --------------------------------------------------------------- the matrix ---

def pivoted_cholesky(a: np.ndarray, tolerance: float = 1e-13) -> np.ndarray:
    """G with a = G G^T for a symmetric positive semidefinite ``a``: the row with the
    largest rest of the diagonal is the next pivot, so G is lower triangular in the
    order of pivots.  Stops where the rest is under ``tolerance`` of the first pivot."""
    d = len(a)
    rest, g, order = a.diagonal().astype(float).copy(), np.zeros((d, d)), []
    first = rest.max(initial=0.0)
    for k in range(d):
        p = int(rest.argmax())
        if rest[p] <= tolerance * first or rest[p] <= 0:
            return g[:, :k]
        column = a[:, p] - g[:, :k] @ g[p, :k]
        column[order] = 0.0
        order.append(p)
        g[:, k] = column / math.sqrt(rest[p])
        g[p, k] = math.sqrt(rest[p])
        rest -= g[:, k] ** 2
        rest[order] = -1.0
    return g


def _pairs(r: int):
    """Rounds of disjoint column pairs that meet every pair once (circle method)."""
    ring = list(range(r + r % 2))
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        both = [(min(a, b), max(a, b)) for a, b in zip(ring[:half], ring[:half - 1:-1]) if max(a, b) < r]
        if both:
            yield np.array(both).T
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(g: np.ndarray, sweeps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of g g^T, unit eigenvectors as columns), falling: pairs of columns
    are rotated until all are orthogonal to working precision."""
    g = g.copy()
    rounds = list(_pairs(g.shape[1]))
    for _ in range(sweeps):
        worst = 0.0
        for i, j in rounds:
            x, y = g[:, i], g[:, j]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(a * b)
            cosine = np.abs(c) / np.where(size > 0, size, 1)
            worst = max(worst, cosine.max())
            turn = cosine > 1e-16
            c = np.where(turn, c, 1.0)
            z = (b - a) / (2 * c)
            t = np.where(turn, np.where(z >= 0, 1, -1) / (np.abs(z) + np.sqrt(1 + z * z)), 0.0)
            cos = 1 / np.sqrt(1 + t * t)
            g[:, i], g[:, j] = x * cos - y * (t * cos), x * (t * cos) + y * cos
        if worst < 1e-15:
            break
    norms = np.sqrt((g * g).sum(0))
    order = np.argsort(-norms, kind="stable")
    norms, g = norms[order], g[:, order]
    vectors = g / norms
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(norms))])
    return norms ** 2, vectors * sign                 # the largest entry of a component is positive


# ------------------------------------------------------------ the Spark job ---

def _integers(df: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """(vec_id, x) of the rows that count."""
    largest = 2.0 ** 62
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("c")) \
        .filter(f"c IS NOT NULL AND forall(c, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < {largest / scale!r}D)")
    lengths = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0].d if lengths else 0
    return rows.filter(F.size("c") == d).selectExpr(
        "vec_id", f"transform(c, v -> cast(floor(v * {scale}D) AS bigint) + {shift}L) AS x")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), flat.dtype)


def _partial(df: DataFrame, state, merge, column: str = "x") -> list:
    """State of all rows: ``state(matrix)`` of each batch, merged pairwise in each task,
    then in about the square root of as many tasks, then here.  A state is a tuple of
    arrays, as bytes on the way."""
    def packed(s):
        import pickle
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(s)], pa.binary())], names=["s"])

    def first(batches):
        s = None
        for b in batches:
            if b.num_rows:
                new = state(_matrix(b.column(column)))
                s = new if s is None else merge(s, new)
        if s is not None:
            yield packed(s)

    def again(batches):
        import pickle
        s = None
        for b in batches:
            for x in b.column("s").to_pylist():
                s = pickle.loads(x) if s is None else merge(s, pickle.loads(x))
        if s is not None:
            yield packed(s)

    import pickle
    parts = materialize(df.select(column).mapInArrow(first, "s binary"), "whitening-partials")
    tasks = max(1, math.isqrt(parts.count()))
    s = None
    for r in parts.repartition(tasks).mapInArrow(again, "s binary").collect():
        s = pickle.loads(r.s) if s is None else merge(s, pickle.loads(r.s))
    return s


def _added(a, b):
    return tuple(x + y for x, y in zip(a, b))


def _merged_moments(a, b):
    """(n, mean, scatter about the mean) of two parts together."""
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


@dataclass
class Whitening:
    n: int
    sums: list[int]                                   # exact
    components: np.ndarray                            # d x k, unit columns
    eigenvalues: np.ndarray                           # k, falling
    trace: float
    identity_error: float = 0.0

    def gaps(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers where they suffice, Python's otherwise."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), 1)
        if 2 * self.n * most < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.gaps(x).astype(float) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list:
        """Exact sums of squares of n * x - S; None where they do not fit a long."""
        g = self.gaps(x)
        if g.dtype != object and (len(g) == 0 or int(np.abs(g).max(initial=0)) ** 2 * max(1, g.shape[1]) < 1 << 63):
            return (g * g).sum(1).tolist()
        sums = [sum(int(v) ** 2 for v in row) for row in g]
        return [v if v < 1 << 63 else None for v in sums]


def fit(integers: DataFrame, components: int) -> Whitening | None:
    """The whitening of the distinct vectors of (vec_id, x); None without any variance."""
    spread = materialize(integers.select("x").distinct(), "whitening-fit")

    def halves(x):
        return len(x), (x >> HALF).sum(0), (x & ((1 << HALF) - 1)).sum(0)

    # halves add up in 64 bits for 2^31 rows; Python's integers put them together
    total = _partial(spread, halves, lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] + b[2]))
    if total is None or not len(total[1]):
        return None
    n, sums = total[0], [(int(h) << HALF) + int(low) for h, low in zip(total[1], total[2])]
    model = Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)

    def scatter(x):
        y = model.centred(x)
        return (y.T @ y,)

    v = _partial(spread, scatter, _added)[0] / n
    eigenvalues, vectors = one_sided_jacobi(pivoted_cholesky(v))
    if not len(eigenvalues):
        return None
    model.trace = float(np.trace(v))
    model.components, model.eigenvalues = vectors[:, :components], eigenvalues[:components]

    def moments(x):
        w = model.whitened(x)
        mean = w.mean(0)
        return len(w), mean, (w - mean).T @ (w - mean)

    measured = _partial(spread, moments, _merged_moments)
    model.identity_error = float(np.abs(measured[2] / n - np.eye(len(model.eigenvalues))).max())
    return model


def whiten(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per row that counts and component from 1, falling by eigenvalue: vec_id,
    component, n (distinct vectors), deviation, whitened, explained (share of the
    trace), identity_error (largest entry of the fit list's whitened covariance minus the
    identity)."""
    rows = materialize(_integers(df, id_col, vector_col, scale, shift), "whitening-rows")
    model = fit(rows, components)
    schema = T.StructType([rows.schema["vec_id"], T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        return rows.selectExpr("vec_id", "1 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained",
                               "0D AS identity_error").limit(0)

    def task(batches):
        for b in batches:
            x = _matrix(b.column("x"))
            w = model.whitened(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(model.deviation(x), pa.int64()), lists],
                                             names=schema.names)

    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    return (rows.mapInArrow(task, schema)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
                    "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"),
                    F.lit(model.identity_error).alias("identity_error")))
