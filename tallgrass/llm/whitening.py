"""Embedding whitening: covariances recovered from exact squares of dimensions and of sums of two dimensions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

#: Rows of a block whose squares are summed in 64 bits, three limbs of 26 bits a number.
BLOCK, LIMB = 512, 26


@dataclass
class Whitening:
    """Means as exact sums over ``n`` vectors, unit components by falling eigenvalue, and the trace of the covariance."""

    n: int
    total: list[int]
    values: np.ndarray
    components: np.ndarray  # one a column
    trace: float

    def usable(self, k: int) -> np.ndarray:
        """Whether each of the first ``k`` components has any variance beside rounding."""
        return self.values[:k] > 1e-12 * self.trace


def _usual(c: Column, scale: int) -> Column:
    return F.transform(c, lambda v: F.floor(v.cast("double") * scale) + F.lit(0).cast("long"))


def scaled(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id, v (the vector in doubles) and x (its entries times ``scale``, rounded down) of the vectors that are finite and not null."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.filter(F.col(vector).isNotNull() & finite & (F.size(vector) > 0)).select(F.col(vec_id).cast("long").alias("vec_id"), _usual(F.col(vector), scale).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _limbs(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return z >> LIMB, z & ((1 << LIMB) - 1)


def exact_squares(y: np.ndarray) -> list[int]:
    """The exact sums over rows of the squares of every dimension, then of every sum of two dimensions (i < j)."""
    first, second = np.triu_indices(y.shape[1], 1)
    if not len(y):
        return [0] * (y.shape[1] + len(first))
    if y.dtype == object or np.abs(y).max() >= 1 << 50:
        y = y.astype(object)
        return [int(t) for t in [*(y * y).sum(0), *((y[:, first] + y[:, second]) ** 2).sum(0)]]
    total: list[int] = [0] * (y.shape[1] + len(first))
    for a in range(0, len(y), BLOCK):
        part = y[a : a + BLOCK]
        high, low = _limbs(np.concatenate([part, part[:, first] + part[:, second]], axis=1))
        # |high| < 2^25 and low < 2^26, so no sum of 512 products passes 2^61
        sums = [np.einsum("ij,ij->j", p, q).tolist() for p, q in ((high, high), (high, low), (low, low))]
        total = [t + (hh << 2 * LIMB) + (hl << LIMB + 1) + ll for t, hh, hl, ll in zip(total, *sums, strict=True)]
    return total


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - total, exactly: in 64 bits where they hold it, in Python's whole numbers otherwise."""
    if len(x) and n * (int(np.abs(x).max()) + 1) + max(map(abs, total)) < 1 << 62:
        return x * np.int64(n) - np.array(total, np.int64)
    return x.astype(object) * n - np.array(total, object)


def _squares(n: int, total: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[int] = []
        for batch in batches:
            if batch.num_rows:
                got = exact_squares(centred(_matrix(batch["x"]), n, total))
                sums = [a + b for a, b in zip(sums, got, strict=True)] if sums else got
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], ["at", "s"])

    return run


def covariance(squares: list[int], n: int, d: int) -> np.ndarray:
    """Covariances from the sums of squares: half the square of a sum less the squares of its terms, over n^3 as the centred values carry n."""
    out = np.zeros((d, d))
    scale = n**3
    for i in range(d):
        out[i, i] = float(Fraction(squares[i], scale))
    for at, (i, j) in enumerate(zip(*np.triu_indices(d, 1), strict=True)):
        out[i, j] = out[j, i] = float(Fraction(squares[d + at] - squares[i] - squares[j], 2 * scale))
    return out


def fit_whitening(fit: DataFrame, d: int) -> Whitening:
    """From a stored table of different vectors x of ``d`` whole numbers.

    Pass 1 sums every dimension; pass 2 centres and sums the squares of every dimension and of every sum of two, all in
    whole numbers, a row of d (d + 1) / 2 sums a task. The driver gets those sums, whatever the number of vectors, and
    takes the eigenvectors of a d by d matrix. Sums are exact up to 10^38.
    """
    names = [F.sum(F.col("x")[j].cast("decimal(28,0)")).alias(f"s{j}") for j in range(d)]
    told = fit.agg(F.count("*").alias("n"), *names).first()
    n, total = told["n"], [int(told[f"s{j}"] or 0) for j in range(d)]
    rows = fit.select("x").mapInArrow(_squares(n, total), "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s")).collect()  # d (d + 1) / 2 rows
    squares = [0] * (d * (d + 1) // 2)
    for r in rows:
        squares[r["at"]] = int(r["s"])
    v = covariance(squares, n, d)
    values, components = np.linalg.eigh(v)
    values, components = values[::-1], components[:, ::-1]
    strongest = components[np.abs(components).argmax(0), np.arange(d)]
    return Whitening(n, total, values, components * np.where(strongest < 0, -1, 1), float(np.trace(v)))


def _projected(w: Whitening, k: int):
    n, total, values, parts, use = w.n, w.total, w.values[:k], w.components[:, :k], w.usable(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = np.array([float(Fraction(s, n)) for s in total])
        scale = np.where(use, 1 / np.sqrt(np.where(use, values, 1)), 0)
        for batch in batches:
            x = _matrix(batch["x"]) if batch.num_rows else np.zeros((0, len(total)), np.int64)
            white = (x - mean) @ parts * scale
            y = centred(x, n, total)
            if y.dtype != object and len(y) and (y.astype(float) ** 2).sum(1).max() < 9e18:
                far = (y * y).sum(1).tolist()
            else:
                far = [s if s < 1 << 63 else None for s in (sum(v * v for v in r) for r in y.tolist())]
            cells = pa.array(white.ravel(), mask=~np.tile(use, len(white)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * len(use), pa.int32()), cells)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(far, pa.int64()), lists], ["vec_id", "deviation", "w"])

    return run


def whiten(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """Whiten vectors by the leading components of the covariance of their different scaled forms.

    x is ``floor(scale * c)`` of every entry. The fit list holds each different x once, found by grouping, with partial
    groups first, so a hot vector costs one row a task. Returns a row for each vector and component up to
    ``components``: vec_id, component (from 1), n (size of the fit list), deviation (exact squared distance of n * x
    from the sums; null beyond 64 bits), whitened, explained (share of the trace) and identity_error, the largest entry
    of the whitened fit list's measured covariance beside the identity.

    Vectors that are null, empty or hold null or non-finite entries are left out. Where lengths differ, the most
    frequent length among the different vectors (the longest if tied) is taken and other vectors are left out. A
    component without variance (all vectors equal, or fewer directions than components) has whitened null, explained
    0, and no part in identity_error, which is null if no component has any. Null ids and repeated rows are rows like
    others; an empty table gives no rows; other columns are not read.
    """
    good = scaled(vectors, vec_id, vector, scale)
    fit = stored(good.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    sizes = sorted(((r["n"], r["d"]) for r in fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect()), reverse=True)  # one row a length
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], names)
    d = sizes[0][1]
    fit_d = fit.filter(F.size("x") == d)
    w = fit_whitening(fit_d, d)
    k = min(components, d)
    ddl = "vec_id long, deviation long, w array<double>"
    use = np.flatnonzero(w.usable(k)).tolist()
    error = None
    if use:
        mine = fit_d.select(F.lit(0).cast("long").alias("vec_id"), "x").mapInArrow(_projected(w, k), ddl)
        pairs = [(i, j) for i in use for j in use if i <= j]
        told = mine.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(told[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    discard(fit)
    explained = [float(v / w.trace) if u else 0.0 for v, u in zip(w.values[:k].tolist(), w.usable(k).tolist(), strict=True)]
    out = good.filter(F.size("x") == d).mapInArrow(_projected(w, k), ddl).select("vec_id", "deviation", F.posexplode("w").alias("_c", "whitened"))
    return out.select(
        "vec_id", (F.col("_c") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(e) for e in explained])[F.col("_c")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
