"""Embedding whitening by shifted CholeskyQR: the rows stay where they are, only d x d matrices come to the driver.

Every pass sums, over the partitions, the Gram matrix of the centred rows after the triangular solves of the passes
before it. The Cholesky factor of that sum is one more triangular factor; a shift keeps it defined where the columns are
nearly dependent. When the solved rows are orthonormal, the product of the factors is the R of the centred rows, and the
singular vectors of that small matrix are the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from skeinlog.llm.common import reachable

SCALE, SHIFT = 64, 1_000_000
#: Entries are whole numbers up to this size, so that sums over 2^20 times as many rows stay exact in 64 bits.
LARGEST = 1 << 42
COMPONENTS = 32
#: Rows that a task solves at once, and passes after which the factors are taken as they are.
BLOCK, PASSES = 8192, 8
#: Below this share of the largest eigenvalue a direction of solved rows is one without rows.
FLAT = 1e-9
OUT = ("component", "n", "deviation", "whitened", "explained", "identity_error")
_EPS = np.finfo(np.float64).eps


def valid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is there and holds only finite entries, at least one."""
    v = F.col(column)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False)))


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows of whole numbers."""
    c = np.asarray(column.flatten()).astype(np.float64).reshape(-1, dims)
    x = np.floor(SCALE * c)
    if len(x) and np.abs(x).max() > LARGEST - SHIFT:
        raise ValueError(f"an entry of a vector is larger than {LARGEST // SCALE}")
    return x.astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            yield part, _whole(part.column("vector"), dims)


def _solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of the upper triangular r, column by column."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _summed(rows: DataFrame, dims: int, width: int, each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of each(whole numbers of a block), width numbers: one row a task, added on the driver side
    of an aggregate by position."""
    kind = pa.float64()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for _, x in _blocks(batches, dims):
            total += each(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(kind))], ["part"])

    got = rows.mapInArrow(partial, "part array<double>").select(F.posexplode("part").alias("k", "v")).groupBy("k").agg(
        F.sum("v").alias("v")
    ).toArrow()
    out = np.zeros(width)
    out[np.asarray(got["k"])] = np.asarray(got["v"])
    return out


@dataclass(frozen=True)
class Whitening:
    """What a fit found: n rows, exact sums by dimension, components as columns, their eigenvalues and shares."""

    n: int
    sums: np.ndarray  # whole numbers
    components: np.ndarray  # dims x k, unit columns by falling eigenvalue
    values: np.ndarray  # eigenvalues of the covariance, divisor n
    explained: np.ndarray
    passes: int

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less its mean, from an exact difference of whole numbers."""
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)


def _sizes(rows: DataFrame) -> int:
    """The length that most vectors have; of several such the least. 0 without vectors."""
    got = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return got[0]["d"] if got else 0


def _factors(rows: DataFrame, n: int, sums: np.ndarray) -> tuple[np.ndarray, int]:
    """R of the centred rows: shifted CholeskyQR, repeated until what is left of the rows is orthonormal.

    Along a direction in which the rows do not vary there is no unit vector: once a factor has made that plain (variance
    below 10^-18 of the largest), the pass counts it as one there, and it is taken out of R at the end.
    """
    dims, factors, r = len(sums), [], np.eye(len(sums))

    def gram(x: np.ndarray) -> np.ndarray:
        q = (n * x - sums) / n
        for f in factors:
            q = _solve(q, f)
        return (q.T @ q).ravel()

    empty = np.zeros((dims, 0))
    for done in range(1, PASSES + 1):
        g = _summed(rows, dims, dims * dims, gram).reshape(dims, dims)
        g = (g + g.T) / 2
        values, vectors = np.linalg.eigh(g)
        if values[-1] <= 0:
            return np.zeros((dims, dims)), done
        still = vectors[:, values < FLAT * values[-1]] if factors else empty
        moving = values[still.shape[1] :]
        if factors and np.all(np.abs(moving - 1) < 1e-13 * dims):
            break
        shift = 0.0
        if not factors or moving[0] < 1e-3 * moving[-1]:
            shift = min(11 * (n * dims + dims * (dims + 1)) * _EPS / 2, 1e-2) * float(moving[-1])
        factor = np.linalg.cholesky(g + still @ still.T + shift * np.eye(dims)).T
        factors.append(factor)
        r = factor @ r
    return r - still @ (still.T @ r), done


def fit(vectors: DataFrame, most: int = COMPONENTS, column: str = "embedding") -> tuple[Whitening, DataFrame]:
    """Fits on all valid vectors (see valid) of the commonest length; other lengths are dropped as well.

    Returns the fit and the rows that it read: all other columns, packed in `row`, and `vector`. An entry c counts as
    floor(64 c) + 1000000, a whole number. Components along which nothing varies are left out, so that there may be fewer
    than `most`, and none for an empty table, one row, or copies of one row. The driver holds matrices of dims x dims.
    """
    reachable(vectors.sparkSession)
    others = [F.col(f"`{c}`") for c in vectors.columns if c != column] or [F.lit(None).cast("string").alias("none")]
    rows = valid(vectors, column).select(F.struct(*others).alias("row"), F.col(column).cast("array<double>").alias("vector"))
    dims = _sizes(rows)
    rows = rows.where(F.size("vector") == dims)
    none = np.zeros((dims, 0))
    if not dims:
        return Whitening(0, np.zeros(0, np.int64), none, np.zeros(0), np.zeros(0), 0), rows

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, np.int64)
        for _, x in _blocks(batches, dims):
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([[n, *total.tolist()]], pa.list_(pa.int64()))], ["part"])

    vector = rows.select("vector")
    got = vector.mapInArrow(counted, "part array<long>").select(F.posexplode("part").alias("k", "v")).groupBy("k").agg(
        F.sum("v").alias("v")
    ).collect()
    whole = np.array([r["v"] for r in sorted(got, key=lambda r: r["k"])], np.int64)
    n, sums = int(whole[0]), whole[1:]
    r, passes = _factors(vector, n, sums)
    _, s, vt = np.linalg.svd(r)
    total = float((s**2).sum())
    held = int((s > dims * _EPS * s[0] * 16).sum()) if total else 0
    k = min(most, held)
    value = s[:k] ** 2 / n
    return Whitening(n, sums, vt[:k].T.copy(), value, s[:k] ** 2 / total if k else value, passes), rows


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """The largest entry of the covariance of the whitened rows, less the identity, in one more pass over all of them."""
    k = len(w.values)
    if not k:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        y = w.whitened(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    got = _summed(rows.select("vector"), w.dims, k + k * k, moments)
    mean = got[:k] / w.n
    return float(np.abs(got[k:].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(w: Whitening, x: np.ndarray) -> list[int]:
    """Sums over the dimensions of (n x - S)^2, exact whatever their size."""
    y = w.n * x - w.sums
    if len(y) and int(np.abs(y).max()) ** 2 * w.dims >= 1 << 63:
        return [sum(int(v) ** 2 for v in row) for row in y.tolist()]
    return (y * y).sum(axis=1).tolist()


def whiten(vectors: DataFrame, most: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """One row for each valid vector and component: `row` (all other columns of vectors), component (from 1, by falling
    eigenvalue), n, deviation (decimal, exact), whitened, explained and identity_error.

    Vectors that are null, empty, or hold a null or a number that is not finite are dropped, and those whose length is not
    the commonest. Repeated rows and ids count as often as they come; ids may be null. Where no component is left (empty
    table, one row, nothing but copies of one row) the result is empty. Entries beyond 2^36 are refused.
    """
    w, rows = fit(vectors, most, column)
    error, k, dims = identity_error(rows, w), len(w.values), w.dims
    number = DecimalType(38, 0)
    if not k:
        kinds = zip(OUT, (IntegerType(), LongType(), number, DoubleType(), DoubleType(), DoubleType()), strict=True)
        told = StructType([rows.schema["row"], *[StructField(c, t) for c, t in kinds]])
        return vectors.sparkSession.createDataFrame([], told)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, dims):
            y = w.whitened(x)
            yield pa.RecordBatch.from_arrays([
                part.column("row"), pa.array([str(d) for d in _deviations(w, x)]), pa.array(y.tolist(), pa.list_(pa.float64())),
            ], ["row", "deviation", "w"])

    wide = StructType([rows.schema["row"], StructField("deviation", StringType()), StructField("w", ArrayType(DoubleType()))])
    held = rows.mapInArrow(projected, wide)
    share = F.array(*[F.lit(float(v)) for v in w.explained])
    return held.select("row", F.col("deviation").cast(number), F.posexplode("w").alias("__k", "whitened")).select(
        "row", (F.col("__k") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("__k") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
