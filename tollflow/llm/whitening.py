"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

1. Vectors become whole numbers; equal ones count once in the fit.
2. Exact sums per dimension, then the scatter of the centred vectors: every
   task adds up its own rows, Spark adds the tasks' sums by matrix entry.
   Only the matrix (dimension squared) reaches the driver, no vectors.
3. Pivoted Cholesky of the scatter, V = L L'; pivots in the noise end it, so
   the rank is known.
4. One-sided Jacobi rotates the columns of L until they are orthogonal.  Their
   squared norms are the eigenvalues of V, the normalised columns its components.

Vectors of different lengths are whitened apart, each length by its own fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollflow.llm.common import finite_vector, packed, read_table, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 62)          # scaled entries from here on are no longs


def whole_numbers(name: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * c) + offset of every entry as longs; NULL where the vector is not usable."""
    value = finite_vector(name)
    fits = F.forall(value, lambda c: F.abs(c * scale) < LARGEST)
    return F.when(fits, F.transform(value, lambda c: F.floor(c * scale) + F.lit(offset)))


# ---- the factorisation -------------------------------------------------------------
def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): v[order][:, order] = L L' with L of d x rank, largest pivots first."""
    d = len(v)
    order, low, left = np.arange(d), np.zeros((d, d)), np.diag(v).astype(float).copy()
    noise = d * np.finfo(float).eps * left.sum()
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= noise:
            return low[:, :k], order
        for a in (order, left, low):
            a[[k, p]] = a[[p, k]]
        low[k, k] = np.sqrt(left[k])
        low[k + 1:, k] = (v[order[k + 1:], order[k]] - low[k + 1:, :k] @ low[k, :k]) / low[k, k]
        left[k + 1:] -= low[k + 1:, k] ** 2
    return low, order


def _rounds(n: int):
    """Every pair of 0..n-1 once, in rounds of disjoint pairs (round-robin tournament)."""
    seats = list(range(n)) + ([-1] if n % 2 else [])
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if a >= 0 and b >= 0]
        yield np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def jacobi(low: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms, unit columns) of ``low`` rotated until its columns are orthogonal, largest first."""
    a, small = low.copy(), 4 * np.finfo(float).eps
    rounds = list(_rounds(a.shape[1])) if a.shape[1] > 1 else []
    for _ in range(sweeps):
        turned = False
        for i, j in rounds:
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > small * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            i, j, x, y = i[turn], j[turn], x[:, turn], y[:, turn]
            ratio = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(ratio >= 0, 1.0, -1.0) / (np.abs(ratio) + np.hypot(1, ratio))
            c = 1 / np.hypot(1, t)
            a[:, i], a[:, j] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    norms = (a * a).sum(0)
    by_size = np.argsort(-norms, kind="stable")
    return norms[by_size], a[:, by_size] / np.sqrt(norms[by_size])


@dataclass
class Whitening:
    """Fit of one vector length: exact count and sums, eigenvalues and components (columns)."""
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    error: float = 0.0

    def __post_init__(self):
        # the mean as a whole number and the rest, so centring loses nothing
        self.base = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([s % self.n / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sum)^2, exact; None beyond a long."""
        far = float(np.abs(self.centred(x)).max(initial=0)) + 1
        if self.n * (float(np.abs(x).max(initial=0)) + 1) < 2.0 ** 62 \
                and (self.n * far) ** 2 * x.shape[1] < 2.0 ** 62:
            t = self.n * x - np.array(self.sums, dtype=np.int64)
            return (t * t).sum(1).tolist()
        t = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return [v if v < 1 << 63 else None for v in (t * t).sum(1).tolist()]


def _by_length(batches, kind=np.int64):
    for batch in batches:
        if len(batch):
            for d, part in batch.groupby(batch["x"].map(len)):
                yield int(d), np.stack(part["x"].to_numpy()).astype(kind)


def matrix_sums(points: DataFrame, rows_of, kind=np.int64, longest: int | None = None) -> dict[int, dict]:
    """Per length the sum over all points (column x) of w'w and w, where w = rows_of(length, x): one pass.

    Tasks return their own sums by matrix entry, upper triangle (j = -1: the
    sums of w).  Points of more than ``longest`` entries are left out.
    """
    def run(batches):
        total = {}
        for d, x in _by_length(batches, kind):
            if longest is not None and d > longest:
                continue
            w = rows_of(d, x)
            square, line = total.get(d, (0.0, 0.0))
            total[d] = square + w.T @ w, line + w.sum(0)
        for d, (square, line) in total.items():
            i, j = np.triu_indices(len(square))
            yield pd.DataFrame({"dim": np.int32(d), "i": np.concatenate([i, np.arange(len(line))]),
                                "j": np.concatenate([j, np.full(len(line), -1)]),
                                "v": np.concatenate([square[i, j], line])})
    entries = points.mapInPandas(run, "dim int, i int, j int, v double") \
        .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toPandas()     # dimension squared rows
    out = {}
    for d, part in entries.groupby("dim"):
        at = part[part["j"] >= 0]
        m = np.zeros((part["i"].max() + 1,) * 2)
        m[at["i"], at["j"]] = m[at["j"], at["i"]] = at["v"]
        out[int(d)] = {"square": m, "line": part[part["j"] < 0].sort_values("i")["v"].to_numpy()}
    return out


def _exact_sums(points: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length the number of points and their exact sums per dimension."""
    def run(batches):
        total = {}
        for d, x in _by_length(batches):
            high, low = x >> 32, x & 0xFFFFFFFF
            n, h, lo = total.get(d, (0, 0, 0))
            total[d] = n + len(x), h + high.sum(0), lo + low.sum(0)
        for d, (n, h, lo) in total.items():
            yield pd.DataFrame({"dim": np.int32(d), "i": np.arange(d), "n": n, "high": h, "low": lo})
    exact = {c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")}
    rows = points.mapInPandas(run, "dim int, i int, n long, high long, low long") \
        .groupBy("dim", "i").agg(*exact.values()).orderBy("dim", "i").collect()   # dimension rows
    out = {}
    for r in rows:
        out.setdefault(r["dim"], (int(r["n"]), []))[1].append((int(r["high"]) << 32) + int(r["low"]))
    return out


def fit(points: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """Whitening of every vector length in ``points`` (column x: distinct arrays of longs).

    Components whose variance is nothing but rounding noise are left out, so a
    length with a single point, or with equal points, has none.
    """
    sums = _exact_sums(points)
    start = {d: Whitening(n, s, 0.0, np.zeros(0), np.zeros((d, 0))) for d, (n, s) in sums.items()}
    models = {}
    for d, found in matrix_sums(points, lambda d, x: start[d].centred(x)).items():
        n, line = start[d].n, found["line"] / start[d].n
        v = found["square"] / n - np.outer(line, line)      # line: rounding of the centring, near 0
        low, order = pivoted_cholesky(v)
        values, turned = jacobi(low)
        columns = np.zeros((d, len(values)))
        columns[order] = turned
        models[d] = Whitening(n, start[d].sums, float(np.trace(v)), values[:components],
                              columns[:, :components])
    for d, found in matrix_sums(points, lambda d, x: models[d].whitened(x)).items():
        n, line = models[d].n, found["line"] / models[d].n
        cov = found["square"] / n - np.outer(line, line)
        models[d].error = float(np.abs(cov - np.eye(len(cov))).max(initial=0))
    return models


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE,
           offset: int = OFFSET) -> DataFrame:
    """doc (the input row), n, deviation, whitened (array), explained (array), identity_error.

    One row per usable input row.  Rows whose ``embedding`` is NULL, empty, or
    holds a NULL or non-finite entry, or one whose whole number is beyond a
    long, are left out.  Repeated vectors count once in the fit.  A vector
    length without variance gives rows with empty arrays.  ``deviation`` is NULL
    where the exact number is beyond a long.  An empty table gives no rows.
    """
    rows = stored(packed(vectors).withColumn("x", whole_numbers("doc.embedding", scale, offset))
                  .where("x is not null"), "whitening-rows")
    models = fit(stored(rows.select("x").distinct(), "whitening-points"), components)

    def run(batches):
        for batch in batches:
            doc, xs = batch.column(0), batch.column(1)
            length = pc.list_value_length(xs).to_numpy()
            for d in np.unique(length):
                m, at = models[int(d)], pa.array(np.flatnonzero(length == d))
                x = xs.take(at).flatten().to_numpy().reshape(-1, d)
                n, k = len(x), len(m.values)
                w, part = m.whitened(x), m.values / m.trace if m.trace else m.values
                cut = pa.array(np.arange(n + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(at), pa.array(np.full(n, m.n)), pa.array(m.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(cut, pa.array(w.ravel())),
                     pa.ListArray.from_arrays(cut, pa.array(np.tile(part, n))),
                     pa.array(np.full(n, m.error))],
                    ["doc", "n", "deviation", "whitened", "explained", "identity_error"])

    numbers = T.ArrayType(T.DoubleType())
    return rows.mapInArrow(run, T.StructType([
        rows.schema["doc"], T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", numbers), T.StructField("explained", numbers),
        T.StructField("identity_error", T.DoubleType())]))


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """``whiten`` of all embeddings, one row per row and component."""
    out = whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select(
        F.col("doc.vec_id").alias("vec_id"), "n", "deviation", "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "z")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("z.whitened").alias("whitened"), F.col("z.explained").alias("explained"), "identity_error")
