"""Whitening of embeddings by slicing the spectrum of their covariance.

The covariance is summed by Spark, a dimension-sized block per task. Its leading eigenvalues are found one by one: the LDL' factors of the
shifted covariance have as many positive pivots as there are eigenvalues above the shift, so bisection over shifts isolates the k-th
largest; Rayleigh quotient iteration then converges on it cubically, and two more counts certify that it is the k-th.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Entries become whole numbers: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries beyond this are held at it; a double has no digits behind the point there.
LARGEST = 1 << 61
#: Threshold of the pivot choice (fixed value of Bunch and Kaufman).
ALPHA = (1 + 17**0.5) / 8
EPS = float(np.finfo(np.float64).eps)

OUTPUTS = T.StructType([
    T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
    T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
])


# ── Eigenvalues of a symmetric matrix by counts ──


def pivots(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``a`` above ``shift``: positive pivots of P(a - shift)P' = LDL', with pivots of one or two rows."""
    m = a - shift * np.eye(len(a))
    above = 0
    while len(m):
        column = np.abs(m[1:, 0])
        most = column.max(initial=0.0)
        two = False
        if most > 0 and abs(m[0, 0]) < ALPHA * most:
            r = 1 + int(column.argmax())
            other = np.abs(m[r])
            other[r] = 0
            if abs(m[0, 0]) * other.max() < ALPHA * most * most:
                two = abs(m[r, r]) < ALPHA * other.max()
                k = 1 if two else 0
                if k != r:
                    order = np.arange(len(m))
                    order[[k, r]] = order[[r, k]]
                    m = m[np.ix_(order, order)]
        if two:
            # Such a block always has one eigenvalue of each sign.
            above += 1
            m = m[2:, 2:] - m[2:, :2] @ np.linalg.solve(m[:2, :2], m[:2, 2:])
        else:
            above += bool(m[0, 0] > 0)
            m = m[1:, 1:] - np.outer(m[1:, 0], m[0, 1:] / m[0, 0]) if m[0, 0] else m[1:, 1:]
    return above


def leading(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit vectors as rows.

    Vectors of equal eigenvalues are some orthonormal basis. Each result is certified: as many eigenvalues lie above it as its number says, up to
    rounding; otherwise an ArithmeticError is raised.
    """
    d = len(a)
    norm = float(np.abs(a).sum(axis=1).max(initial=0.0))
    if not norm:
        return np.zeros(count), np.eye(d)[:count]
    tiny = 4 * EPS * norm * max(d, 8) ** 0.5
    known: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in known:
            known[shift] = pivots(a, shift)
        return known[shift]

    # Every eigenvalue is within the norm.
    known[1.01 * norm], known[-1.01 * norm] = 0, d
    values, vectors = [], np.zeros((0, d))
    for k in range(1, count + 1):
        low = max(s for s, n in known.items() if n >= k)
        high = min(s for s, n in known.items() if n < k)
        while True:
            while not (above(low) == k and above(high) == k - 1) and high - low > tiny:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= k else (low, middle)
            found = _rayleigh(a, (low + high) / 2, vectors, tiny)
            if low - tiny <= found[0] <= high + tiny and above(found[0] - 2 * tiny) >= k > above(found[0] + 2 * tiny):
                break
            if high - low <= tiny:
                raise ArithmeticError(f"eigenvalue {k} of the covariance is not certified")
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        values.append(found[0])
        vectors = np.vstack([vectors, found[1]])
    return np.array(values), vectors


def _rayleigh(a: np.ndarray, shift: float, found: np.ndarray, tiny: float) -> tuple[float, np.ndarray]:
    """From two steps of inverse iteration at ``shift``, Rayleigh quotient iteration to an eigenvalue and its vector."""
    d = len(a)
    # Any start with a part along the vector will do.
    x = _apart(np.cos(np.arange(1, d + 1) ** 2 * 0.7), found)
    best = (float("inf"), 0.0, x)
    for step in range(20):
        rho = shift if step < 2 else float(x @ a @ x)
        try:
            y = np.linalg.solve(a - rho * np.eye(d), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(a - (rho + tiny) * np.eye(d), x)
        x = _apart(y / np.abs(y).max(), found)
        rho = float(x @ a @ x)
        rest = float(np.linalg.norm(a @ x - rho * x))
        if step >= 2 and rest >= best[0] / 2:
            # Converged: it only gets better by rounding.
            if rest < best[0]:
                best = (rest, rho, x)
            break
        best = min(best, (rest, rho, x), key=lambda b: b[0])
    return best[1], best[2]


def _apart(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Unit vector of the part of ``x`` orthogonal to the rows found; twice, so that rounding leaves nothing along them."""
    for _ in range(2):
        x = x - found.T @ (found @ x)
        size = np.linalg.norm(x)
        if size < 1e-12:
            x, size = np.random.default_rng(len(found)).standard_normal(len(x)), 1.0
        x = x / size
    x = x - found.T @ (found @ x)
    return x / np.linalg.norm(x)


# ── Sums over all vectors ──


def _vectors(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their whole-number vectors."""
    for batch in batches:
        if batch.num_rows:
            c = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield batch, np.clip(np.floor(SCALE * c), -LARGEST, LARGEST).astype(np.int64) + OFFSET


class Centred:
    """Exact n * x - S of vectors, and x - S / n from it."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.middle = np.array([s // n for s in sums], dtype=np.int64)
        # n * x - S = n * (x - middle) - rest, where rest < n.
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = x - self.middle
        most = int(np.abs(near).max(initial=0)) + 1
        if (most * self.n) ** 2 * x.shape[1] < 1 << 62:
            exact = self.n * near - self.rest
            return exact, exact / self.n
        return self.n * near.astype(object) - self.rest.astype(object), near - self.rest / self.n


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(d, dtype=np.int64), np.zeros(d, dtype=np.int64), 0
        for batch, x in _vectors(batches, d):
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(np.append(high, n)), pa.array(np.append(low, 0))], names=["k", "high", "low"])

    return run


def _products(d: int, centred: Centred, onto: np.ndarray):
    """Sums of products of the centred vectors, taken ``onto`` some vectors, one row per entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((len(onto), len(onto))), np.zeros(len(onto))
        for _, x in _vectors(batches, d):
            z = centred.of(x)[1] @ onto.T
            total += z.T @ z
            first += z.sum(axis=0)
        every = np.concatenate([total.ravel(), first])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(every))), pa.array(every)], names=["k", "value"])

    return run


def _summed(rows: DataFrame, make, size: int) -> np.ndarray:
    """Sums by place: as many rows reach the driver as a matrix has entries, whatever the number of vectors."""
    found = rows.mapInArrow(make, "k long, value double").groupBy("k").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[found.column("k").to_numpy()] = found.column("value").to_numpy()
    return out


def whiten(vectors: DataFrame, vector: Column, components: int = COMPONENTS, keep: list[str] | None = None) -> DataFrame:
    """A row per vector and component: the columns of ``vectors`` (or those to ``keep``), component, n, deviation, whitened, explained, identity_error.

    Rows with a null vector, or null or non-finite entries, are left out; so are vectors of another length than most have (ties: the longer), which
    stand in no common space. Repeated rows each count. There are no more components than dimensions. A component without any spread (an
    eigenvalue of nothing but rounding) has a null ``whitened`` and no part in identity_error, which is null if all are such; explained is null if there is no spread at all.
    Entries of equal eigenvalues may be whitened by any basis of their space. ``deviation`` is null where the exact sum exceeds a long. No vectors, no rows.
    An input column of an output's name is replaced.
    """
    outputs = {f.name for f in OUTPUTS}
    kept = [c for c in (vectors.columns if keep is None else keep) if c.lower() not in outputs]
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.select((F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_"))).alias("row"), vector.cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0)).where(finite)
    empty = T.StructType([rows.schema["row"], *OUTPUTS])
    flat = lambda made: made.select(*[F.col("row").getField(c).alias(c) for c in kept], *[f.name for f in OUTPUTS])

    length = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return flat(vectors.sparkSession.createDataFrame([], empty))
    d = length["d"]
    rows = rows.where(F.size("vector") == d)

    found = rows.select("vector").mapInArrow(_sums(d), "k long, high long, low long").groupBy("k").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    sums = {r["k"]: (int(r["high"]) << 32) + int(r["low"]) for r in found.collect()}
    n = sums.pop(d) >> 32
    centred = Centred(n, [sums[k] for k in range(d)])

    covariance = _summed(rows.select("vector"), _products(d, centred, np.eye(d)), d * d + d)[: d * d].reshape(d, d) / n
    covariance = (covariance + covariance.T) / 2
    values, axes = leading(covariance, min(components, d))
    trace = float(np.trace(covariance))
    real = values > 16 * EPS * d * max(float(values[0]), 0.0)
    onto = axes / np.sqrt(np.where(real, values, 1.0))[:, None]

    error = None
    if real.any():
        p = int(real.sum())
        again = _summed(rows.select("vector"), _products(d, centred, onto[real]), p * p + p) / n
        spread = again[: p * p].reshape(p, p) - np.outer(again[p * p:], again[p * p:])
        error = float(np.abs(spread - np.eye(p)).max())
    explained = [float(v) / trace if trace > 0 else None for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(values)
        for batch, x in _vectors(batches, d):
            exact, z = centred.of(x)
            if exact.dtype == object:
                deviation = [int(v) if v < 1 << 63 else None for v in (exact * exact).sum(axis=1)]
            else:
                deviation = (exact * exact).sum(axis=1)
            white, size = (z.astype(np.float64) @ onto.T).ravel(), len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("row").take(pa.array(np.repeat(np.arange(size), m))), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), size)), pa.array(np.full(size * m, n)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(size), m))), pa.array(white, mask=~np.tile(real, size)),
                pa.array(explained * size, pa.float64()), pa.array([error] * (size * m), pa.float64()),
            ], names=["row", *[f.name for f in OUTPUTS]])

    return flat(rows.mapInArrow(run, empty))
