"""Whitening of vectors: a covariance from one aggregation over generated columns, its components by LAPACK.

A component c counts as the integer x = floor(scale * c). The fit list holds each distinct integer vector once. One
pass sums every dimension; a second one sums the centred products of every pair of dimensions (the upper triangle) in
one aggregation of generated SQL expressions, d * (d + 1) / 2 sums in a row a task. The driver gets that one row,
fills the matrix and takes its eigenvectors by LAPACK (numpy's eigh). Everything else is column expressions: what
grows with the input never leaves the executors, and no aggregation has keys that one value could make hot.

Centred values are (x - q) - r / n with S = q * n + r (the integer part of the mean goes off in integers), so a large
offset costs no digits; their own sums, zero but for rounding, are taken off the products again. The number of
generated expressions grows with the square of the dimension, so this is meant for some hundreds of dimensions.

Defined results: vectors that are null or hold null or non-finite entries are dropped. Of the others, those of
another length than most have (of the longest such length on a tie), and those with an integer beyond 2^53, are in
no fit list; they stay as rows with null deviation and whitened. Components are as many as asked for or as there are
dimensions. Where a component has no variance (up to rounding) whitened is null; with no variance at all explained is
null too. identity_error is over the components with variance, null if there is none. A deviation beyond a long is
null. Equal rows are answered each, and count once in the fit list. Columns other than the two named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .vectors import finite, floored, usual_length

SCALE = 256
COMPONENTS = 4


@dataclass(frozen=True)
class Whitening:
    """What is learned from a fit list. mean[i] is quotient[i] + remainder[i] / n, exactly."""

    n: int
    quotient: list[int]
    remainder: list[int]
    vectors: np.ndarray  # a unit eigenvector a row, by falling eigenvalue
    values: np.ndarray  # their eigenvalues
    trace: float

    def centred(self) -> Column:
        """The centred values of x, as an array."""
        quotient, share = F.lit(self.quotient), F.lit([r / self.n for r in self.remainder])
        return F.transform("x", lambda v, i: (v - F.get(quotient, i)).cast("double") - F.get(share, i))

    def varies(self) -> list[bool]:
        return [bool(e > self.trace * len(self.quotient) * np.finfo(float).eps) for e in self.values]

    def whitened(self) -> list[Column]:
        """The value on each component of a row with centred values c, null where the component has no variance."""
        out = []
        for v, e, some in zip(self.vectors, self.values, self.varies(), strict=True):
            weights = F.lit((v / np.sqrt(e)).tolist() if some else [None] * len(v)).cast("array<double>")
            out.append(F.aggregate(F.zip_with("c", weights, lambda c, w: c * w), F.lit(0.0), lambda s, t: s + t))
        return out

    def deviation(self) -> Column:
        """Sum over dimensions of (n * x - S)^2 for a row with x and centred values c, exact; null beyond a long."""
        quotient, remainder = F.lit(self.quotient), F.lit(self.remainder)
        steps = F.transform("x", lambda v, i: (v - F.get(quotient, i)) * F.lit(self.n) - F.get(remainder, i))
        rough = F.aggregate("c", F.lit(0.0), lambda s, c: s + F.pow(c * float(self.n), F.lit(2)))
        return F.when(rough < 9.2e18, F.aggregate(steps, F.lit(0).cast("long"), lambda s, d: s + d * d))


def _integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id and x, null where a vector is in no fit list."""
    rows = vectors.where(finite(F.col(vec_col))).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    length = usual_length(rows, "v")
    return rows.select("vec_id", F.when((F.size("v") == length) & F.lit(length > 0), floored(F.col("v"), scale)).alias("x"))


def _products(values: DataFrame, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the d values of the array c, and of the products of every two of them, by one aggregation over the upper triangle."""
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = values.agg(*(F.expr(f"sum(c[{i}])") for i in range(d)), *(F.expr(f"sum(c[{i}] * c[{j}])") for i, j in pairs)).first()
    sums, both = np.array(row[:d], float), np.zeros((d, d))
    for (i, j), s in zip(pairs, row[d:], strict=True):
        both[i, j] = both[j, i] = s
    return sums, both


def covariance(values: DataFrame, d: int, n: int) -> np.ndarray:
    """Covariance (divisor n) of the d values of the array c, which are centred but for rounding."""
    sums, both = _products(values, d)
    return (both - np.outer(sums, sums) / n) / n


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learned from the distinct integer vectors x of fit_list; None where there is none."""
    first = fit_list.select(F.size("x")).first()
    if first is None:
        return None
    d = first[0]
    row = fit_list.agg(F.count(F.lit(1)), *(F.sum(F.get("x", i).cast("decimal(20,0)")) for i in range(d))).first()
    n, total = row[0], [int(s) for s in row[1:]]
    parts = [divmod(s, n) for s in total]
    base = Whitening(n, [q for q, _ in parts], [r for _, r in parts], np.zeros((0, d)), np.zeros(0), 0.0)
    v = covariance(fit_list.select(base.centred().alias("c")), d, n)
    values, vectors = np.linalg.eigh(v)
    top = np.argsort(values, kind="stable")[::-1][: min(components, d)]
    return Whitening(n, base.quotient, base.remainder, vectors[:, top].T, values[top], float(np.trace(v)))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each row and component."""
    ints = _integers(vectors, id_col, vec_col, scale)
    fit_list = saved(ints.where("x is not null").select("x").distinct())
    got = fit(fit_list, components)
    types = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if got is None:
        none = ", ".join(f"cast(null as {t.split()[1]}) {t.split()[0]}" for t in types.split(", ")[2:])
        return ints.selectExpr("vec_id", f"explode(sequence(1, {components})) component", *none.split(", "))
    error = None
    some = [w for w, varies in zip(got.whitened(), got.varies(), strict=True) if varies]
    if some:
        white = fit_list.select(got.centred().alias("c")).select(F.array(*some).alias("c"))
        error = float(np.abs(covariance(white, len(some), got.n) - np.eye(len(some))).max())
    shares = [float(e) / got.trace if got.trace > 0 else None for e in got.values]
    each = [F.struct(F.lit(k + 1).alias("component"), w.alias("whitened"), F.lit(s).cast("double").alias("explained")) for k, (w, s) in enumerate(zip(got.whitened(), shares, strict=True))]
    rows = ints.withColumn("c", got.centred()).select("vec_id", got.deviation().alias("deviation"), F.explode(F.array(*each)).alias("on"))
    return rows.select("vec_id", "on.component", F.lit(got.n).cast("long").alias("n"), "deviation", "on.whitened", "on.explained", F.lit(error).cast("double").alias("identity_error"))
