"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, so counts and sums over all vectors are exact and
a vector is centred without rounding, as (n * x - S) / n. The covariance is never
formed: a pass over the vectors multiplies it with a block of columns, each task
adding up X'(X Q) of its centred rows and Spark adding up the tasks' sums. A few
Lanczos steps bound the spectrum from below; then polynomial filters damp all
below the block's smallest Ritz value, QR makes the block orthonormal again, and
a Rayleigh-Ritz step measures the residual of every wanted component. Iteration
ends when all residuals are certified to be rounding.

The driver holds blocks of dimension x (components + guard), whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Scaled entries beyond this are taken as this, so that sums of a task's rows fit into 64 bits.
LARGEST = 1 << 40
_GUARD, _LANCZOS, _MOST_ROUNDS = 16, 8, 500
_LONGEST = (1 << 63) - 1


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, dim, x``: floor(scale * entry) + shift of each entry as packed 64-bit numbers.

    Vectors that are null or hold a null or non-finite entry are left out; ids
    may be null or repeated. An empty vector has dimension 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("v")))
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
            fine = np.isfinite(values)
            bad = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~fine], minlength=len(sizes)) > 0
            x = np.clip(np.floor(scale * np.where(fine, values, 0.0)), -LARGEST, LARGEST).astype("<i8") + shift
            ends = (8 * np.concatenate([[0], np.cumsum(sizes)])).astype(np.int64)
            packed = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(x)]).cast(pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(sizes.astype(np.int32)), packed], names=["vec_id", "dim", "x"])
            yield out.filter(pa.array(~bad))

    slim = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    kind = slim.schema["vec_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"vec_id {kind}, dim int, x binary")


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    packed = batch.column("x")
    first = packed.offset
    ends = np.frombuffer(packed.buffers()[1], np.int32)[first : first + len(packed) + 1]
    return np.frombuffer(packed.buffers()[2], "<i8")[ends[0] // 8 : ends[-1] // 8].reshape(-1, dim)


@dataclass(frozen=True)
class Centre:
    """Count and sums of the fit list, as tasks need them."""

    n: int
    sums: np.ndarray

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as whole numbers: 64-bit ones where they fit, else Python's."""
        if self.n * (LARGEST + SHIFT) < _LONGEST:
            return x * self.n - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(float) / self.n


class Vectors:
    """Vectors of one dimension, with exact count and sums, and passes over their centred rows."""

    def __init__(self, whole: DataFrame):
        """``whole`` is a written table of ``whole_vectors``. The dimension is that of most vectors (of equals the
        larger); others are left out as broken ones are."""
        sizes = [(r.n, r.dim) for r in whole.groupBy("dim").agg(F.count("*").alias("n")).collect() if r.dim]
        self.n, self.dim = max(sizes, default=(0, 0))
        self.frame = whole.where(F.col("dim") == self.dim)
        self.centre, self.trace = Centre(self.n, np.zeros(0, object)), 0.0
        if self.n:
            self.centre = Centre(self.n, self._summed(lambda x: x.sum(axis=0), "long", "decimal(38,0)", None, object))
            both = self.add_up(lambda d: np.concatenate([d.sum(axis=0), [(d * d).sum()]]))
            self.rest, self.trace = both[:-1] / self.n, both[-1] / self.n  # rest: what rounding leaves of the mean

    def _summed(self, make: Callable[[np.ndarray], np.ndarray], sent: str, summed: str, centre: Callable[[np.ndarray], np.ndarray] | None, kind: type = float) -> np.ndarray:
        """Sums over all rows of what ``make`` gives for some of them; one pass, one row a cell to the driver."""
        dim, at_once = self.dim, max(1, (1 << 20) // self.dim)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                x = _matrix(batch, dim)
                for k in range(0, len(x), at_once):
                    some = x[k : k + at_once]
                    part = make(centre(some) if centre else some)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "v"])

        cells = self.frame.select("x").mapInArrow(run, f"cell long, v {sent}").groupBy("cell").agg(F.sum(F.col("v").cast(summed)).alias("v")).collect()
        out = np.zeros(len(cells), kind)
        for r in cells:
            out[r.cell] = int(r.v) if kind is object else r.v
        return out

    def add_up(self, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        return self._summed(make, "double", "double", self.centre.centred)

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``q``."""
        return self.add_up(lambda d: d.T @ (d @ q)).reshape(q.shape) / self.n


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors as columns, by falling eigenvalue; ``residual`` is the largest one, ``passes`` over the data."""

    vectors: np.ndarray
    values: np.ndarray
    residual: float
    passes: int


def lower_bound(times: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int) -> float:
    """A lower estimate of a covariance's spectrum from a few Lanczos steps, 0 at least."""
    q, before, beta = start / np.linalg.norm(start), np.zeros_like(start), 0.0
    basis, alphas, betas = [], [], []
    for _ in range(min(steps, len(start))):
        basis.append(q)
        w = times(q[:, None])[:, 0]
        alphas.append(float(q @ w))
        w = w - alphas[-1] * q - beta * before
        for b in basis:
            w -= (b @ w) * b
        beta = float(np.linalg.norm(w))
        betas.append(beta)
        if beta <= 1e-12 * abs(alphas[0]):
            break
        before, q = q, w / beta
    low, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1))
    return max(0.0, float(low[0] - betas[-1] * abs(vectors[-1, 0])))


def filtered(times: Callable[[np.ndarray], np.ndarray], x: np.ndarray, vx: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the covariance times ``x``: at most 1 on [low, high], scaled to 1 at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = half / (top - middle)
    tau = 2 / sigma
    now = (vx - middle * x) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (tau - sigma)
        x, now = now, (times(now) - middle * now) * (2 * following / half) - (sigma * following) * x
        sigma = following
    return now


def principal(vectors: Vectors, components: int = COMPONENTS, guard: int = _GUARD, tolerance: float = 1e-13, seed: int = 11) -> Components:
    """The leading components, by Chebyshev-filtered subspace iteration until every residual is certified.

    A residual |V q - e q| must be ``tolerance`` of the largest eigenvalue, or
    have stopped falling within a hundred times of that. Of equal eigenvalues any
    basis may come. Directions without variance are no components.
    """
    dim, passes = vectors.dim, 0
    wanted = min(components, dim)
    if not vectors.n or vectors.trace <= 0:
        return Components(np.zeros((dim, 0)), np.zeros(0), 0.0, 0)

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return vectors.times(q)

    random = np.random.default_rng(seed)
    block = min(dim, wanted + guard)
    low = lower_bound(times, random.normal(size=dim), _LANCZOS) if block < dim else 0.0
    x = random.normal(size=(dim, block))
    best, worse = np.inf, 0
    for _ in range(_MOST_ROUNDS):
        q, _ = np.linalg.qr(x)
        q, _ = np.linalg.qr(q)
        vq = times(q)
        h = q.T @ vq
        values, u = np.linalg.eigh((h + h.T) / 2)
        values, u = values[::-1], u[:, ::-1]
        x, vx = q @ u, vq @ u
        residual = float(np.max(np.linalg.norm(vx - x * values, axis=0)[:wanted]))
        limit = tolerance * values[0]
        best, worse = min(best, residual), worse + 1 if residual > best / 2 else 0
        if block == dim or residual <= limit or (worse >= 2 and residual <= 100 * limit):
            there = values[:wanted] > 1e-13 * values[0]
            return Components(x[:, :wanted][:, there], values[:wanted][there], residual, passes)
        high = max(float(values[-1]), 1e-14 * values[0])
        low = min(low, high / 2) if low >= high else low
        grows = lambda e: np.arccosh(max(1.0 + 1e-6, 2 * (e - low) / (high - low) - 1))
        # The first component may outgrow the last wanted one by eight digits in a round, no more.
        degree = int(np.clip(8 * np.log(10) / max(1e-9, grows(values[0]) - grows(values[wanted - 1])), 2, 20))
        x = filtered(times, x, vx, low, high, float(values[0]), degree)
        x /= np.linalg.norm(x, axis=0)
    raise RuntimeError(f"components not certified after {_MOST_ROUNDS} rounds: residual {residual}")


@dataclass(frozen=True)
class Whitening:
    vectors: Vectors
    components: Components
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.components.values / self.vectors.trace if len(self.components.values) else np.zeros(0)

    def transform(self) -> DataFrame:
        """``vec_id, deviation, whitened``: the exact sum of (n * x - S)^2 (null beyond 64 bits) and the whitened vector."""
        vectors, centre, dim = self.vectors, self.vectors.centre, self.vectors.dim
        project = self.components.vectors / np.sqrt(self.components.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(0, batch.num_rows, 2_000):
                    some = batch.slice(k, 2_000)
                    exact = centre.exact(_matrix(some, dim))
                    if exact.dtype == object or float(np.abs(exact).max(initial=0)) ** 2 * dim >= _LONGEST:
                        far = [sum(int(v) ** 2 for v in row) for row in exact]
                        far = pa.array([v if v <= _LONGEST else None for v in far], pa.int64())
                    else:
                        far = pa.array((exact * exact).sum(axis=1))
                    w = (exact.astype(float) / centre.n) @ project
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32)), pa.array(w.ravel()))
                    yield pa.RecordBatch.from_arrays([some.column("vec_id"), far, lists], names=["vec_id", "deviation", "whitened"])

        kind = vectors.frame.schema["vec_id"].dataType.simpleString()
        if not project.shape[1]:
            return vectors.frame.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return vectors.frame.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def fit_whitening(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fits on all vectors that are whole; null vectors and such with null or non-finite entries are left out.

    Repeated rows count each. Where vectors differ in length those of the most
    frequent one stay. A list of none or of equal vectors alone has no component.
    """
    vectors = Vectors(written(whole_vectors(df, id_col, vector_col), "vectors"))
    found = principal(vectors, components)
    if not len(found.values):
        return Whitening(vectors, found, 0.0)
    project, rest = found.vectors / np.sqrt(found.values), vectors.rest

    def covariance(d: np.ndarray) -> np.ndarray:
        w = (d - rest) @ project
        return w.T @ w

    size = len(found.values)
    measured = vectors.add_up(covariance).reshape(size, size) / vectors.n
    return Whitening(vectors, found, float(np.max(np.abs(measured - np.eye(size)))))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each whole vector of ``embeddings`` and component: its place on it, whitened."""
    fit = fit_whitening(table(spark, sf_dir, "embeddings"))
    rows = fit.transform().select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*(F.lit(float(e)) for e in fit.explained)).cast("array<double>")
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.vectors.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(fit.identity_error).alias("identity_error"))
