"""Whitening of embeddings by shifted CholeskyQR.

The fit list holds each distinct vector once. Its centred rows A are orthogonalised
in passes: every task adds up the Gram matrix of its rows after triangular solves
with the factors found so far, the driver takes the sum's Cholesky factor, and the
product of all factors is the R of A = QR. The first pass adds a shift, so that its
factor exists however ill-conditioned A is; so does any later pass without a factor.
The singular values and right vectors of R give the covariance's eigenvalues and
components; the covariance itself is never decomposed.

What is sent to tasks and to the driver is a square of the vectors' length, whatever
the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, in_arrow, row_runs, summed, with_columns
from tidemark.session import written

BLOCK = 32  # columns solved at once
UNIT = 2.0**-53
SHIFT = 24  # bits of the lower part of a sum, so that neither part overflows


@dataclass
class Whitening:
    """n and per-dimension sums of the fit list, and its leading components (columns)."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components over their deviations; NaN where there is none."""
        with np.errstate(divide="ignore"):
            scale = np.where(self.eigenvalues > 0, 1 / np.sqrt(self.eigenvalues), np.nan)
        return (x - self.mean) @ self.components * scale


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q of Q R = A for an upper triangular R, by blocks of columns."""
    q = np.empty_like(a)
    for begin in range(0, len(r), BLOCK):
        end = min(begin + BLOCK, len(r))
        q[:, begin:end] = a[:, begin:end] - q[:, :begin] @ r[:begin, begin:end]
        for j in range(begin, end):
            q[:, j] = (q[:, j] - q[:, begin:j] @ r[begin:j, j]) / r[j, j]
    return q


def whole_steps(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * c) of each entry as long; null for vectors that are null or hold null, NaN or infinite entries.

    Entries beyond the long range take its nearest end.
    """
    sound = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    # In Spark NaN is greater than any number, so the comparison drops it too.
    steps = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    return F.when(sound, steps)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width).astype(np.float64)


def _summed_over(fit: DataFrame, width: int, size: int, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``function`` makes of blocks of rows: ``size`` numbers."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(size)
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            for begin, end in row_runs(np.full(len(rows), width), 1 << 20):
                total += function(rows[begin:end])
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["part"])

    return summed(in_arrow(fit, run, "part array<double>"), "part", size)


def _upper(gram: np.ndarray) -> np.ndarray:
    return gram[np.triu_indices(len(gram))]


def _whole(upper: np.ndarray, width: int) -> np.ndarray:
    gram = np.zeros((width, width))
    gram[np.triu_indices(width)] = upper
    return gram + np.triu(gram, 1).T


def triangle(fit: DataFrame, n: int, mean: np.ndarray, passes: int = 8) -> np.ndarray:
    """R of the fit list's centred rows (column x).

    Ends when the Gram matrix of Q is a projection to rounding: the identity, or of
    lower rank if the rows span fewer dimensions, whose singular values are then noise.
    """
    width = len(mean)
    size = width * (width + 1) // 2
    factors: list[np.ndarray] = []
    tolerance = 16 * width * UNIT * max(1.0, np.log2(n))

    def gram(x: np.ndarray) -> np.ndarray:
        q = x - mean
        for r in factors:
            q = solve_right(q, r)
        return _upper(q.T @ q)

    product = np.eye(width)
    for k in range(passes):
        g = _whole(_summed_over(fit, width, size, gram), width)
        norm = np.linalg.norm(g, 2)
        if norm == 0:
            return np.zeros((width, width))
        if k and np.abs(g @ g - g).max() <= tolerance:
            break
        try:
            if not k:
                raise np.linalg.LinAlgError("the first pass is shifted")
            r = np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            shift = 11 * (n * width + width * (width + 1)) * UNIT * norm
            r = np.linalg.cholesky(g + shift * np.eye(width)).T
        factors.append(r)
        product = r @ product
    return product


def fit_whitening(rows: DataFrame, components: int = 4) -> Whitening | None:
    """Fitted to each distinct vector of ``rows`` (x array<long>) once; None without any.

    Vectors of another length than the commonest among the distinct ones (of equally
    common ones the longest) are left out. A component whose singular value is noise
    has eigenvalue 0.
    """
    fit = written(rows.where(F.size("x") > 0).select("x").distinct(), "vectors")
    widths = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return None
    width, n = widths["width"], widths["count"]
    fit = fit.where(F.size("x") == width)
    # Sums of the higher and lower bits apart, so that long sums hold them exactly.
    parts = fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.sum(F.shiftright("c", SHIFT)).alias("high"), F.sum(F.col("c").bitwiseAND((1 << SHIFT) - 1)).alias("low")
    )
    sums = [(r.high << SHIFT) + r.low for r in sorted(parts.collect(), key=lambda r: r["at"])]
    mean = np.array([s / n for s in sums])
    _, sigma, right = np.linalg.svd(triangle(fit, n, mean))
    sigma = np.where(sigma > max(n, width) * UNIT * sigma[0], sigma, 0.0)
    k = min(components, width)
    leading = right[:k].T
    # Either sign will do; the largest entry is positive, so that runs agree.
    leading = leading * np.sign(leading[np.abs(leading).argmax(0), np.arange(k)])
    found = Whitening(n, sums, leading, sigma[:k] ** 2 / n, float((sigma**2).sum() / n))
    sound = np.flatnonzero(found.eigenvalues > 0)
    m = len(sound)
    if m:

        def moments(x: np.ndarray) -> np.ndarray:
            w = found.whiten(x)[:, sound]
            return np.concatenate((w.sum(0), (w.T @ w).ravel()))

        total = _summed_over(fit, width, m + m * m, moments) / n
        covariance = total[m:].reshape(m, m) - np.outer(total[:m], total[:m])
        found.identity_error = float(np.abs(covariance - np.eye(m)).max())
    return found


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - S)**2 of each row, exact; None beyond the long range."""
    about = ((x.astype(np.float64) * n - np.array(sums, np.float64)) ** 2).sum(1)
    small = about < 2.0**62
    out: list[int | None] = [None] * len(x)
    if small.any():
        if max(abs(s) for s in sums) < 2**62 and n * float(np.abs(x[small].astype(np.float64)).max(initial=0)) < 2.0**62:
            exact = ((x[small] * n - np.array(sums, np.int64)) ** 2).sum(1)
        else:
            exact = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x[small].tolist()]
        for i, v in zip(np.flatnonzero(small).tolist(), exact, strict=True):
            out[i] = int(v)
    for i in np.flatnonzero(~small & (about < 2.0**64)).tolist():
        v = sum((n * c - s) ** 2 for c, s in zip(x[i].tolist(), sums, strict=True))
        out[i] = v if v < 2**63 else None
    return out


def whitened(rows: DataFrame, vector: str = "embedding", components: int = 4) -> DataFrame:
    """Rows with n, deviation, whitened and explained (arrays, one entry a component) and identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped,
    and so are those of another length than the fit's (see ``fit_whitening``). Entries
    become floor(256 * c). Repeated vectors count once in the fit and keep all their
    rows. With fewer dimensions than ``components`` the arrays are shorter. A component
    without variance has null in ``whitened`` and 0 in ``explained``; without any
    variance ``explained`` and ``identity_error`` are null. A deviation beyond the
    long range is null. Other columns pass through, but for those with a new name,
    which are replaced. An empty table gives an empty result.
    """
    sound = rows.withColumn("x", whole_steps(F.col(f"`{vector}`"))).where(F.col("x").isNotNull())
    fitted = fit_whitening(sound, components)
    width = len(fitted.sums) if fitted else -1

    def found(column: pa.Array) -> list[pa.Array]:
        x = np.asarray(column.flatten()).reshape(-1, width)
        w = fitted.whiten(x.astype(np.float64))
        k = w.shape[1]
        explained = fitted.eigenvalues / fitted.trace if fitted.trace else np.full(k, np.nan)
        bounds = pa.array(np.arange(len(x) + 1) * k, pa.int32())
        return [
            pa.array(np.full(len(x), fitted.n)),
            pa.array(deviations(x, fitted.n, fitted.sums), pa.int64()),
            pa.ListArray.from_arrays(bounds, pa.array(w.ravel(), from_pandas=True)),
            pa.ListArray.from_arrays(bounds, pa.array(np.tile(explained, len(x)), from_pandas=True)),
            pa.array([fitted.identity_error] * len(x), pa.float64()),
        ]

    new = {
        "n": "bigint", "deviation": "bigint", "whitened": "array<double>", "explained": "array<double>", "identity_error": "double",
    }
    return with_columns(sound.where(F.size("x") == width).drop(vector), F.col("x"), new, found).drop("x")
