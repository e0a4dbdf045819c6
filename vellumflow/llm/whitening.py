"""Whitening of embeddings by a covariance that is exact before it is decomposed.

Entries become whole numbers, ``floor(64 * c) + 1000000``. The fit list holds each distinct
vector once, n of them with sums S. With the centred value ``y = n * x - S``, a whole number,
the tasks add up ``y_i ** 2`` of every dimension and ``(y_i + y_j) ** 2`` of every pair, without
rounding; since ``(y_i + y_j)^2 = y_i^2 + y_j^2 + 2 y_i y_j``, the difference of these variances
is twice the covariance of the pair. Only the sums, one per pair of dimensions, reach the
driver, which divides by ``n ** 3`` once, takes the eigenvectors of a matrix as wide as the
vectors, and ships it to the tasks that project the rows.

Squares are added as 64-bit integers: a value is cut into limbs of 24 bits, so that no sum of a
block overflows, and Python's whole numbers take over where the centred values need more than 62 bits.

Results for odd input. Rows whose vector is null or holds a null, NaN or infinite entry are left
out. So are vectors of another width than the usual one: the width with most distinct vectors, of
equals the larger. Ids may be null or repeated: each row gives its own results. An entry whose
whole number needs more than 64 bits is an error. ``deviation`` is null where it needs more than
64 bits. A component without variance (rank of the data, a single distinct vector) has ``explained``
0 and ``whitened`` null, and ``identity_error`` leaves it out (null if no component is left). An
empty table, or vectors of no width, give no rows. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from vellumflow.llm.tables import Tables

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Bits of a limb, and rows whose products of limbs fit one 64-bit sum.
LIMB, BLOCK = 24, 1 << 13
#: Wide vectors are taken in blocks of at most this many numbers.
CELLS = 1 << 20


# --- whole numbers --------------------------------------------------------------------------


def rounded(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, x): the vectors that can be used, as arrays of whole numbers."""
    c = F.col(vector)
    scaled = lambda e: F.lit(float(SCALE)) * e.cast("double")
    whole = lambda e: F.floor(scaled(e)).cast("long") + F.lit(SHIFT).cast("long")
    entry = lambda e: F.when(F.abs(scaled(e)) < float(1 << 62), whole(e)).otherwise(F.raise_error(F.lit("an entry needs more than 64 bits")))
    finite = lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf"))
    usable = c.isNotNull() & F.forall(c, lambda e: F.coalesce(finite(e), F.lit(False)))
    return vectors.where(usable).select(F.col(id).alias("id"), F.transform(c, entry).alias("x")).where("size(x) > 0")


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The column ``x`` of a batch as a matrix."""
    return np.asarray(batch.column(batch.schema.get_field_index("x")).flatten()).reshape(batch.num_rows, width)


def square_sum(z: np.ndarray, bound: int) -> list[int]:
    """Exact sums of the squares of each column of ``z``, whose values are below ``bound``."""
    if z.dtype == object:
        return [sum(v * v for v in column) for column in z.T.tolist()]
    limbs = max(1, -(-bound.bit_length() // LIMB))
    total = [0] * z.shape[1]
    for start in range(0, len(z), BLOCK):
        rest, parts = np.abs(z[start : start + BLOCK]), []
        for _ in range(limbs):
            parts.append(rest & ((1 << LIMB) - 1))
            rest = rest >> LIMB
        for a in range(limbs):
            for b in range(a, limbs):
                sums = np.einsum("ij,ij->j", parts[a], parts[b]).tolist()
                for k, s in enumerate(sums):
                    total[k] += (s << (LIMB * (a + b))) * (1 if a == b else 2)
    return total


def _centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    """n * x - S without rounding; numbers of any size once 62 bits don't hold them."""
    if fit.bound.bit_length() > 61:
        return x.astype(object) * fit.n - np.array(fit.sums, object)
    # Differences to the lowest value first, so that no product overflows on the way.
    low = np.array(fit.low, np.int64)
    return (x - low) * fit.n + np.array([fit.n * a - s for a, s in zip(fit.low, fit.sums)], np.int64)


# --- the fit list ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """What the fit list says: rows, sums and lowest values per dimension, bound of |n * x - S|."""

    n: int
    sums: list[int]
    low: list[int]
    bound: int

    @property
    def width(self) -> int:
        return len(self.sums)


def _usual_width(distinct: DataFrame) -> int | None:
    row = distinct.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return row["width"] if row else None


def _moments(distinct: DataFrame, width: int) -> Fit:
    """Sums and extremes per dimension: one row per task and dimension is shuffled."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, [0] * width, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, width)
            base = x.min(axis=0)
            # Sums of the differences to the lowest value in two halves: exact for any batch.
            gap = x.astype(object) - base if int(x.max()) - int(x.min()) >= 1 << 62 else x - base
            if gap.dtype == object:
                sums = [sum(column) for column in gap.T.tolist()]
            else:
                top, bottom = (gap >> 31).sum(axis=0).tolist(), (gap & ((1 << 31) - 1)).sum(axis=0).tolist()
                sums = [(t << 31) + b for t, b in zip(top, bottom)]
            total = [t + s + len(x) * int(b) for t, s, b in zip(total, sums, base)]
            n += len(x)
            low = base if low is None else np.minimum(low, base)
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            columns = [range(width), [n] * width, [str(t) for t in total], low, high]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "n", "total", "low", "high"])

    parts = distinct.mapInArrow(task, "i long, n long, total string, low long, high long")
    found = parts.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    ).orderBy("i").collect()  # one row per dimension
    n = found[0]["n"]
    sums, low = [int(r["total"]) for r in found], [r["low"] for r in found]
    bound = max(max(n * r["high"] - s, s - n * r["low"]) for r, s in zip(found, sums)) + 1
    return Fit(n, sums, low, bound)


def _covariance(distinct: DataFrame, fit: Fit) -> np.ndarray:
    """The covariance of the fit list by polarisation, each entry rounded once."""
    width = fit.width

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pair = [0] * width, {}
        for batch in batches:
            step = max(1, CELLS // width)
            for start in range(0, batch.num_rows, step):
                y = _centred(_rows(batch.slice(start, step), width), fit)
                own = [a + b for a, b in zip(own, square_sum(y, fit.bound))]
                for i in range(width - 1):
                    # Variances of the sum of dimension i with each later one.
                    sums = square_sum(y[:, i : i + 1] + y[:, i + 1 :], 2 * fit.bound)
                    pair[i] = [a + b for a, b in zip(pair[i], sums)] if i in pair else sums
        if any(own):
            yield rows_of(list(range(width)), list(range(width)), own)
        for i, sums in pair.items():
            yield rows_of([i] * len(sums), list(range(i + 1, width)), sums)

    def rows_of(i: list[int], j: list[int], sums: list[int]) -> pa.RecordBatch:
        # In parts of nine digits, which Spark adds as long values.
        digits = [[] for _ in range(9)]
        for s in sums:
            for part in digits:
                s, rest = divmod(s, 10**9)
                part.append(rest)
            if s:
                raise OverflowError("a sum of squares has more than 81 digits")
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (i, j, *digits)], names=["i", "j", *[f"p{k}" for k in range(9)]])

    parts = distinct.mapInArrow(task, "i long, j long, " + ", ".join(f"p{k} long" for k in range(9)))
    found = parts.groupBy("i", "j").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(9)]).collect()  # one row per pair of dimensions
    exact = {(r["i"], r["j"]): sum(r[f"p{k}"] * 10 ** (9 * k) for k in range(9)) for r in found}
    v = np.zeros((width, width))
    for i in range(width):
        v[i, i] = exact.get((i, i), 0) / fit.n**3
        for j in range(i + 1, width):
            # Whole numbers up to here; the division rounds correctly.
            v[i, j] = v[j, i] = (exact.get((i, j), 0) - exact.get((i, i), 0) - exact.get((j, j), 0)) / (2 * fit.n**3)
    return v


# --- components ------------------------------------------------------------------------------------


def _components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, shares of the trace, unit eigenvectors as columns), largest first. The entry of
    largest size, of equals the first, is positive."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    values = np.where(values > len(v) * np.finfo(float).eps * max(values[0], 0), values, 0.0)
    at = np.argmax(np.round(np.abs(vectors), 12), axis=0)
    vectors = vectors * np.where(vectors[at, range(vectors.shape[1])] < 0, -1.0, 1.0)
    trace = float(np.trace(v))
    return values, values / trace if trace > 0 else np.zeros_like(values), vectors


def _identity_error(distinct: DataFrame, fit: Fit, weights: np.ndarray) -> float | None:
    """Largest entry of the covariance of the whitened fit list minus the identity."""
    live = weights[:, np.any(weights != 0, axis=0)]
    k = live.shape[1]
    if not k:
        return None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _project(_rows(batch, fit.width), fit, live)
            first += w.sum(axis=0)
            second += w.T @ w
        cells = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int64()), pa.array(cells)], names=["cell", "part"])

    sums = distinct.mapInArrow(task, "cell long, part double").groupBy("cell").agg(F.sum("part").alias("part")).collect()  # k + k * k rows
    cells = np.array([r["part"] for r in sorted(sums, key=lambda r: r["cell"])])
    mean = cells[:k] / fit.n
    return float(np.abs(cells[k:].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)).max())


def _project(x: np.ndarray, fit: Fit, weights: np.ndarray) -> np.ndarray:
    # y / n is x - S / n, rounded once.
    return (_centred(x, fit).astype(float) / fit.n) @ weights


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", most: int = 16) -> DataFrame:
    """One row per usable vector: (id, n, deviation, whitened array<double>, explained
    array<double>, identity_error), arrays by component, at most ``most`` of them.

    The fit list and the rounded rows are written once; a lost executor costs its tasks only.
    """
    tables = Tables(vectors.sparkSession)
    kind = vectors.schema[id].dataType
    rows = tables.keep(rounded(vectors, id, vector), "vectors")
    distinct = tables.keep(rows.select("x").distinct(), "fit")
    width = _usual_width(distinct)
    schema = T.StructType([
        T.StructField(id, kind), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("explained", T.ArrayType(T.DoubleType())),
        T.StructField("identity_error", T.DoubleType()),
    ])
    if width is None:
        return vectors.sparkSession.createDataFrame([], schema)
    used = distinct.where(F.size("x") == width)
    fit = _moments(used, width)
    values, shares, basis = _components(_covariance(used, fit), most)
    weights = np.divide(basis, np.sqrt(values), out=np.zeros_like(basis), where=values > 0)
    error = _identity_error(used, fit, weights)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, dead = max(1, CELLS // width), [k for k, e in enumerate(values) if e <= 0]
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = _rows(part, width)
                y = _centred(x, fit)
                if y.dtype != object and fit.bound**2 * width < 1 << 63:
                    deviation = pa.array(np.einsum("ij,ij->i", y, y))
                else:
                    sizes = [sum(v * v for v in line) for line in y.tolist()]
                    deviation = pa.array([s if s < 1 << 63 else None for s in sizes], pa.int64())
                w = (y.astype(float) / fit.n) @ weights
                white = w.tolist() if dead else None
                for line in white or ():
                    for k in dead:
                        line[k] = None
                m = len(x)
                column = pa.array(white, pa.list_(pa.float64())) if dead else pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([fit.n] * m), deviation, column, pa.array([shares.tolist()] * m, pa.list_(pa.float64())), pa.array([error] * m, pa.float64())],
                    names=schema.names,
                )

    return rows.where(F.size("x") == width).mapInArrow(task, schema)
