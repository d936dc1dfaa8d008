"""Whitening of embeddings with a covariance found by polarisation.

Every entry c of a vector becomes the integer x = floor(1024 c) + 100000.  Four
scans read the table; nothing is shuffled but one short table of sums a task:

1. count and sum per dimension, hence the integer centre of each dimension;
2. the sum of (x_i - m_i)^2 of every dimension and of (x_i - m_i + x_j - m_j)^2
   of every pair of dimensions, in exact integers.  Twice a covariance is the
   variance of a pair's sum less the two variances, so the differences give the
   whole covariance matrix, without one rounding; ``eigh`` of it gives the
   components;
3. the covariance of the whitened rows, centred per task and merged, which is
   compared with the identity;
4. the output.

The sums are Python integers where 64 bits could overflow.  They leave a task as
32-bit limbs, which Spark adds as longs, so no size of table or entry rounds or
overflows.  The driver holds dimensions x dimensions numbers.

Defined cases: rows whose vector is null or holds null or non-finite entries are
dropped, and so are rows whose length is not the commonest one (of equally
common lengths the longest); empty vectors have no component.  floor(1024 c)
is held within +-2^62.  A direction without variance (eigenvalue at most
1e-12 of the largest) cannot be scaled to one and is no component, so a table of
equal rows gives an empty result, as does an empty table.  Repeated rows and null
ids count like any other.  ``deviation`` is null where it exceeds 38 digits.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
_LIMB = 32
_MOST = 1 << 62
#: Whole numbers below this, squared and added over a batch of 2^20 rows, stay in 64 bits.
_NARROW = 1 << 20
#: An eigenvalue below this share of the largest is no variance but rounding.
FLAT = 1e-12


def integers(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the batch that remain, and their x as rows of whole numbers (objects where 64 bits are narrow)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    length = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(length == dims)
    flat = vectors.take(pa.array(at)).flatten()
    c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dims)  # null entries become NaN
    ok = np.isfinite(c).all(axis=1)
    with np.errstate(over="ignore"):
        f = np.clip(np.floor(SCALE * c[ok]), -float(_MOST), float(_MOST))
    x = f.astype(np.int64)
    if len(x) and np.abs(f).max() > 1 << 40:
        x = x.astype(object)
    return at[ok], x + SHIFT


def narrowed(x: np.ndarray) -> np.ndarray:
    """As 64-bit numbers where squares of sums over a batch fit, else as Python integers."""
    if x.dtype != object and (not x.size or np.abs(x).max() < _NARROW) and len(x) <= 1 << 20:
        return x
    return x.astype(object)


def limbs(values: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Each whole number as (position, limb number, limb): 32-bit limbs, the last one signed."""
    at, number, limb = [], [], []
    for k, v in enumerate(values):
        j = 0
        while not -(1 << (_LIMB - 1)) <= v < 1 << (_LIMB - 1):
            at.append(k), number.append(j), limb.append(v & ((1 << _LIMB) - 1))
            v >>= _LIMB
            j += 1
        at.append(k), number.append(j), limb.append(v)
    return at, number, limb


def exact_sums(df: DataFrame, vec_col: str, dims: int, width: int, per_batch) -> list[int]:
    """Exact totals over all rows of the ``width`` whole numbers that ``per_batch(x)`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            _, x = integers(batch.column(0), dims)
            if len(x):
                total = [a + int(b) for a, b in zip(total, per_batch(x))]
        at, number, limb = limbs(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(number, pa.int32()), pa.array(limb, pa.int64())],
                                         ["at", "number", "limb"])

    rows = (df.select(vec_col).mapInArrow(run, "at int, number int, limb long")
            .groupBy("at", "number").agg(F.sum("limb").alias("limb")).collect())
    out = [0] * width
    for r in rows:
        out[r["at"]] += r["limb"] << (_LIMB * r["number"])
    return out


def pair_squares(x: np.ndarray, centre: np.ndarray) -> Iterator[int]:
    """Sum of (d_i + d_j)^2 over the rows, d = x - centre: for each i first d_i^2, then all j behind it."""
    d = narrowed(x - centre)
    for i in range(d.shape[1]):
        yield (d[:, i] ** 2).sum()
        yield from ((d[:, i:i + 1] + d[:, i + 1:]) ** 2).sum(axis=0)


def covariance(n: int, rest: list[int], squares: list[int]) -> list[list[int]]:
    """n^2 times the covariance, exact.  ``rest``: sums of d per dimension; ``squares`` as of :func:`pair_squares`."""
    dims, it = len(rest), iter(squares)
    spread = {}  # n^2 times the variance of d_i, or of d_i + d_j
    for i in range(dims):
        spread[i, i] = n * next(it) - rest[i] ** 2
        for j in range(i + 1, dims):
            spread[i, j] = n * next(it) - (rest[i] + rest[j]) ** 2
    out = [[0] * dims for _ in range(dims)]
    for (i, j), v in spread.items():
        out[i][j] = out[j][i] = v if i == j else (v - spread[i, i] - spread[j, j]) // 2
    return out


@dataclass
class Whitening:
    n: int
    dims: int
    centre: np.ndarray  # whole numbers m_i = floor(S_i / n)
    rest: np.ndarray  # S_i - n m_i, in [0, n)
    values: np.ndarray  # eigenvalues of the components kept, falling
    vectors: np.ndarray  # components x dimensions, unit rows
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows x components."""
        d = (x - self.centre).astype(np.float64) - (self.rest / self.n).astype(np.float64)
        return d @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact: n^2 d.d - 2 n d.r + r.r."""
        d = x - self.centre
        wide = d.dtype == object or not d.size or int(np.abs(d).max()) * max(self.n, int(np.abs(d).max())) * self.dims >= _MOST
        d = d.astype(object) if wide else d
        rest = self.rest if wide else self.rest.astype(np.int64)
        own = int((self.rest ** 2).sum())
        dd, dr = (d * d).sum(axis=1), (d * rest).sum(axis=1)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + own for a, b in zip(dd, dr)]


def dimensions(df: DataFrame, vec_col: str) -> int:
    """The commonest length of the vectors (of equally common ones the longest); 0 if there is none."""
    valid = F.col(vec_col).isNotNull() & ~F.exists(vec_col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    top = df.filter(valid).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    return top["d"] if top else 0


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of ``df``, or None if no row or no direction remains."""
    dims = dimensions(df, vec_col)
    if not dims:
        return None
    n, *sums = exact_sums(df, vec_col, dims, dims + 1, lambda x: [len(x), *x.astype(object).sum(axis=0)]
                          if x.dtype == object else [len(x), *x.sum(axis=0)])
    centre = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    small = all(abs(m) < 1 << 50 for m in centre)
    middle = np.array(centre, dtype=np.int64 if small else object)
    squares = exact_sums(df, vec_col, dims, dims * (dims + 1) // 2, lambda x: pair_squares(x, middle))
    cov = covariance(n, rest, squares)
    v = np.array([[c / (n * n) for c in row] for row in cov])  # correctly rounded quotients of whole numbers
    values, vectors = np.linalg.eigh(v)
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > FLAT * values[-1]]
    trace = sum(cov[i][i] for i in range(dims)) / (n * n)
    if not order or trace <= 0:
        return None
    return Whitening(n, dims, middle, np.array(rest, dtype=object), values[order], vectors[:, order].T, values[order] / trace)


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of all whitened rows, less the identity.

    Each task centres its rows before multiplying; the tasks' moments are merged
    about the common mean, which the driver gets first (one row)."""
    k = len(model.values)
    upper = [(i, j) for i in range(k) for j in range(i, k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, moment = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, x = integers(batch.column(0), model.dims)
            if not len(x):
                continue
            w = model.whiten(x)
            m = w.mean(axis=0)
            c = w - m
            gap, both = m - mean, n + len(w)
            moment += c.T @ c + np.outer(gap, gap) * (n * len(w) / both)
            mean += gap * (len(w) / both)
            n = both
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())),
                 pa.array([[moment[p] for p in upper]], pa.list_(pa.float64()))], ["n", "mean", "moment"])

    parts = df.select(vec_col).mapInArrow(run, "n long, mean array<double>, moment array<double>").persist()
    try:
        means = parts.agg(*[(F.sum(F.col("n") * F.col("mean")[i]) / model.n).alias(f"m{i}") for i in range(k)]).head()
        spread = [F.sum(F.col("moment")[p] + F.col("n") * (F.col("mean")[i] - means[i]) * (F.col("mean")[j] - means[j]))
                  / model.n for p, (i, j) in enumerate(upper)]
        cov = parts.agg(*[s.alias(f"c{p}") for p, s in enumerate(spread)]).head()
    finally:
        parts.unpersist()
    return max(abs(cov[p] - (i == j)) for p, (i, j) in enumerate(upper))


SCHEMA = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           model: Whitening | None = None) -> DataFrame:
    """One row for each remaining vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    model = model or fit(df, vec_col, components)
    src = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    schema = f"`id` {src.dtypes[0][1]}, {SCHEMA}"
    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error, k = identity_error(df, model, vec_col), len(model.values)
    most = 10 ** 38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = integers(batch.column(1), model.dims)
            if not len(x):
                continue
            rows = len(x)
            dev = pa.array([Decimal(v) if v < most else None for v in model.deviation(x)], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, model.n)), dev.take(each), pa.array(model.whiten(x).ravel()),
                 pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * k, error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
