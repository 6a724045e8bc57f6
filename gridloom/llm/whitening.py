"""Whitening of embeddings by a randomised range finder.

The covariance of n vectors is never asked for by its dimension at first: a random block of
a few more directions than components is multiplied by it in passes over all centred rows, and made
orthonormal again after each (power passes). Rayleigh-Ritz on the last product gives
components and their residuals. While residuals are above rounding, more passes follow; if they do not
get there, the block is expanded to the full dimension, where one pass gives the covariance itself
and the same Rayleigh-Ritz step is exact.

Every pass is a job over all rows that adds up, in each task, a matrix of dimension x directions;
these are summed by blocks of rows, so that the driver gets one matrix whatever the number of tasks.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import lean, partitions, stage

COMPONENTS = 32
#: Directions beyond the components asked for.
OVERSAMPLE = 10
#: Power passes before the block is expanded.
PASSES = 6
#: Residuals of components, as a share of the largest eigenvalue, that count as rounding.
TOLERANCE = 1e-13
#: Eigenvalues below this share of the largest are rounding: such components have no variance to divide by.
RANK = 1e-12
#: Entries become floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Rows of a matrix that travel together, and rows of a batch that are multiplied at once.
BLOCK, ROWS = 16, 4096
#: Entries beyond this are no exact numbers in a double.
_EXACT = 1 << 53


def integers(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key (long) and x (array of long): floor(64 * entry) + 1000000 for every usable vector.

    Null vectors, empty ones, and those that hold a null or non-finite entry take no part. Null and repeated
    keys do. Entries whose x is beyond 2**53 are an error.
    """
    c = F.col(f"`{vector}`").cast("array<double>")
    usable = embeddings.select(F.col(f"`{key}`").cast("long").alias("key"), c.alias("c")).where((F.size("c") > 0) & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    large = F.raise_error(F.lit("an entry is too large to be taken as a whole number"))
    return usable.select("key", F.transform("c", lambda v: F.when(F.abs(v) < _EXACT // SCALE // 2, F.floor(v * SCALE) + SHIFT).otherwise(large.cast("long"))).alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pieces(batches, *columns):
    """Arrays of at most ROWS rows: x as a matrix, then other columns."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            yield (_matrix(part["x"]), *(part[c] for c in columns))


def _sum(rows: DataFrame, shape: tuple[int, ...], add: Callable, kind=np.float64) -> np.ndarray:
    """The sum of what add(x) gives for all matrices x of rows: an array of this shape.

    Tasks send their sums in blocks of rows, and a block is summed wherever it belongs: neither a
    task nor the driver holds more than a matrix at once.
    """
    height = -(-shape[0] // BLOCK)

    def partial(batches):
        total = None
        for (x,) in _pieces(batches):
            total = add(x) if total is None else total + add(x)
        if total is None:
            return
        at = range(0, shape[0], BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK for k in at], pa.int32()), pa.array([total[k : k + BLOCK].tobytes() for k in at], pa.binary())], names=["block", "body"])

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, body in zip(b["block"].to_pylist(), b["body"].to_pylist(), strict=True):
                m = np.frombuffer(body, kind)
                held[k] = held[k] + m if k in held else m
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([m.tobytes() for m in held.values()], pa.binary())], names=["block", "body"])

    kinds = "block int, body binary"
    sums = rows.select("x").mapInArrow(lean(partial), kinds).repartition(min(height, partitions(rows.sparkSession)), "block").mapInArrow(lean(merge), kinds)
    found = {r["block"]: np.frombuffer(r["body"], kind) for r in sums.collect()}
    return np.concatenate([found[k] for k in range(height)]).reshape(shape) if found else np.zeros(shape, kind)


def ritz(q: np.ndarray, vq: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest Ritz values of V and their vectors, from an orthonormal q and V q, and their largest residual."""
    t = q.T @ vq
    e, w = np.linalg.eigh((t + t.T) / 2)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    residual = np.linalg.norm(vq @ w - (q @ w) * e, axis=0)
    return e, q @ w, float(residual.max(initial=0))


class Fit:
    """Count, sums by dimension, trace of the covariance, eigenvalues and components of all rows."""

    def __init__(self, n: int, total: np.ndarray, trace: float, values: np.ndarray, vectors: np.ndarray, full: bool, passes: int):
        self.n, self.total, self.trace, self.values, self.vectors = n, total, trace, values, vectors
        #: Whether the block was expanded to the full dimension, and the products with V before that.
        self.full, self.passes = full, passes

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, from whole numbers: the one rounding is the last division."""
        return (self.n * (x - SHIFT) - (self.total - self.n * SHIFT)) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def fit(rows: DataFrame, components: int = COMPONENTS, oversample: int = OVERSAMPLE, passes: int = PASSES, seed: int = 11) -> Fit | None:
    """The components of integers() rows, of one length; None where there is no row.

    The driver holds matrices of dimension x directions only. Rows whose deviation from the mean,
    times n, is beyond whole numbers of 64 bits are an error.
    """
    far = F.greatest(F.array_max("x") - SHIFT, SHIFT - F.array_min("x"))
    first = rows.select(F.size("x").alias("d"), far.alias("far")).agg(F.min("d"), F.max("d"), F.count("*"), F.max("far")).first()
    d, most, n, far = first
    if not n:
        return None
    if d != most:
        raise ValueError(f"vectors of several lengths, from {d} to {most}")
    if n * max(far, 1) >= 1 << 61:
        raise OverflowError("sums of whole numbers are beyond 64 bits")
    sums = _sum(rows, (d, 1), lambda x: (x - SHIFT).sum(0)[:, None], np.int64)[:, 0] + n * SHIFT
    model = Fit(n, sums, 0.0, np.zeros(0), np.zeros((d, 0)), False, 0)
    k = min(components, d)
    width = min(d, components + oversample)

    def product(q):
        return _sum(rows, (d, q.shape[1] + 1), lambda x: (lambda c: np.column_stack([c.T @ (c @ q), (c * c).sum(0)]))(model.centred(x))) / n

    q, last, converged = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0], np.inf, False
    for done in range(1, passes + 1) if width < d else ():
        vq = product(q)
        vq, model.trace = vq[:, :-1], float(vq[:, -1].sum())
        values, vectors, residual = ritz(q, vq, k)
        model.passes, goal = done, TOLERANCE * max(values[0], 0)
        converged = residual <= goal
        # at this pace the passes that are left would not get there
        if converged or done > 2 and residual * min(1, residual / last) ** (passes - done) > goal:
            break
        last, q = residual, np.linalg.qr(vq)[0]
    if not converged:
        # all directions, where Rayleigh-Ritz is exact
        model.full = True
        v = product(np.eye(d))
        v, model.trace = v[:, :-1], float(v[:, -1].sum())
        values, vectors, _ = ritz(np.eye(d), v, k)
    real = values > RANK * max(values[0], 0)
    model.values, model.vectors = values[real], vectors[:, real]
    return model


def _deviation(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """The sum over dimensions of (n * x - total)**2, as whole numbers; an error beyond 64 bits."""
    gap = n * (x - SHIFT) - (total - n * SHIFT)
    if float((gap.astype(np.float64) ** 2).sum(1).max(initial=0)) >= 2.0**63:
        raise OverflowError("a deviation is beyond 64 bits")
    return (gap * gap).sum(1)


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Components are numbered from 1 by falling eigenvalue; those without variance (eigenvalues at the
    level of rounding) can't be whitened and have no rows: none at all where all vectors are
    equal. Usable vectors: see integers; repeated rows and keys count as often as they come. Vectors of several
    lengths are an error. An empty table, or one without usable vectors, gives no rows. identity_error
    is measured: a pass over all rows sums up the whitened values and their products.
    """
    spark = embeddings.sparkSession
    rows = stage(integers(embeddings, key, vector))  # small numbers, which the passes read again and again
    model = fit(rows, components)
    k = 0 if model is None else len(model.values)
    error = 0.0
    if k:
        # centred before multiplying: rows are, and so are their projections, but for rounding
        got = _sum(rows, (k, k + 1), lambda x: (lambda w: np.column_stack([w.T @ w, w.sum(0)]))(model.whitened(x))) / model.n
        error = float(np.abs(got[:, :-1] - np.outer(got[:, -1], got[:, -1]) - np.eye(k)).max())
    shared = spark.sparkContext.broadcast(model)  # dimension x components numbers
    schema = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches):
        m = shared.value
        for x, keys in _pieces(batches, "key"):
            if not k:
                return
            w, far = m.whitened(x), _deviation(x, m.n, m.total)
            size = len(x) * k
            at = pa.array(np.repeat(np.arange(len(x)), k))
            arrays = [keys.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(size, m.n)), pa.array(np.repeat(far, k)), pa.array(w.reshape(-1)), pa.array(np.tile(m.values / m.trace, len(x))), pa.array(np.full(size, error))]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(lean(run), schema).withColumnRenamed("key", key)
