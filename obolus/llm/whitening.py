"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, x = floor(256 c); the fit list is each distinct x vector once. Its centred rows
are the matrix A, and its singular vectors on the right are the components. From a random unit vector
v_1 on, A v_j less its share in u_{j-1} is alpha_j u_j, and A' u_j less its share in v_j is beta_j v_{j+1},
every u and v kept orthogonal to all before it, twice over. The alphas and betas form a bidiagonal
matrix of some dozen rows whose SVD gives singular values and vectors; the process ends when
the wanted ones leave a residual of rounding size, or the dimension is used up.

The two products of a step are one pass over the rows: a task forms its entries of A w and adds up
their multiples of its rows. Left vectors are never stored: u_j = A w_j for a w_j of the dimension's
size, and with z_j = A' u_j the product of u_j and A w is that of z_j and w, so orthogonality of left
vectors is kept with vectors of the dimension's size, too. What reaches the driver in a pass is one
vector of that size, summed on the executors before.

One start finds a single vector of a singular value that comes several times. So the process is begun
again on what is orthogonal to the components found, until that has no larger singular value than the
last one wanted.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, and so are
those of another length than the most frequent one (of equals the greater). Components whose
deviation is of rounding size are not given: equal rows only, or fewer distinct vectors than
components, give fewer; a table without rows left gives none. Repeated rows and ids get the same
result each; ids may be null. Sums are longs: beyond their range the job fails and does not wrap around.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obolus.llm.common import stored

#: Entries are whole multiples of 1 / SCALE.
SCALE = 256
#: Residual, as a share of the largest singular value, at which a singular vector is done.
DONE = 1e-13
#: Of the total variance; components below are rounding.
NOTHING = 1e-12


@dataclass
class Fit:
    """``n`` distinct vectors with sums ``sums``; ``axes``: components by falling ``values`` (of the covariance)."""
    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0


def whole(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(row, x): the rows whose vector can be used, as they are, and their whole numbers."""
    v = F.col("row")[vector]
    fine = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = embeddings.select(F.struct("*").alias("row")).filter(F.coalesce(fine, F.lit(False)))
    rows = rows.select("row", F.transform(v, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))
    often = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("x") == (often["d"] if often else 0))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(fit: DataFrame, fn: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of ``fn`` (rows of x -> one vector) over all rows: each task adds up its batches, Spark the tasks'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = fn(_matrix(batch, "x"))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "value"])
    parts = fit.select("x").mapInArrow(run, f"i int, value {kind}")
    rows = parts.groupBy("i").agg(F.sum("value").alias("value")).collect()  # one vector
    return np.array([r["value"] for r in sorted(rows, key=lambda r: r["i"])])


def _orthogonal(v: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    if to:
        q = np.array(to)
        for _ in range(2):
            v = v - q.T @ (q @ v)
    return v


def bidiagonalise(product: Callable[[np.ndarray], tuple[float, np.ndarray]], d: int, want: int, without: list[np.ndarray], scale: float, seed: int) -> list[tuple[float, np.ndarray]]:
    """Up to ``want`` largest singular values with their right vectors, of A restricted to what is orthogonal
    to ``without``. ``product``: w -> (|A w| ** 2, A' A w); ``scale``: the Frobenius norm of A."""
    rng = np.random.default_rng(seed)
    start = _orthogonal(rng.standard_normal(d), without)
    vs, ws, zs, alphas, betas = [start / np.linalg.norm(start)], [], [], [], []
    beta = 0.0
    while True:
        v = vs[-1]
        w = v - beta * ws[-1] if ws else v.copy()
        for _ in range(2):
            for wi, zi in zip(ws, zs):  # the share of A w in u_i
                w = w - (zi @ w) * wi
        square, z = product(w)
        alpha = float(np.sqrt(square))
        alphas.append(alpha)
        if alpha <= 1e-14 * scale:  # v adds nothing to the image: the last column is what the betas say
            alphas[-1], r = 0.0, np.zeros(d)
        else:
            ws.append(w / alpha)
            zs.append(z / alpha)
            r = _orthogonal(zs[-1] - alpha * v, [*without, *vs])
        k, beta = len(alphas), float(np.linalg.norm(r))
        left, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        last = beta <= 1e-13 * scale or k + len(without) >= d
        if last or (k > want and (beta * np.abs(left[-1, :want]) <= DONE * values[0]).all()):
            found = [(float(s), q @ np.array(vs)) for s, q in zip(values[:want], right[:want])]
            return [(s, q / np.linalg.norm(q)) for s, q in found if s > 1e-13 * scale]
        betas.append(beta)
        vs.append(r / beta)


def fit(x: DataFrame, components: int = 4, seed: int = 13) -> Fit | None:
    """Mean and components of the distinct vectors in the column ``x``; None for no row."""
    distinct = stored(x.groupBy("x").agg(F.lit(1).alias("_1")).select("x"))
    first = distinct.first()
    if first is None:
        return None
    d = len(first["x"])
    told = summed(distinct, lambda m: np.append(_sums(m), len(m)), "long")
    n, sums = int(told[-1]), told[:-1]
    mean = sums / n
    trace = float(summed(distinct, lambda m: np.array([np.square(m - mean).sum()]))[0]) / n

    def product(w: np.ndarray) -> tuple[float, np.ndarray]:
        def part(m: np.ndarray) -> np.ndarray:
            a = m - mean
            t = a @ w
            return np.append(t @ a, t @ t)
        out = summed(distinct, part)
        return float(out[-1]), out[:-1]

    found: list[tuple[float, np.ndarray]] = []
    scale = float(np.sqrt(trace * n))
    while len(found) < d and scale:
        more = bidiagonalise(product, d, max(1, components - len(found)), [q for _, q in found], scale, seed + len(found))
        done = len(found) >= components and (not more or more[0][0] <= found[components - 1][0] * (1 + 1e-12))
        found = sorted(found + more, key=lambda f: -f[0])
        if done or not more:
            break
    found = [f for f in found[:components] if f[0] ** 2 > NOTHING * scale ** 2]
    out = Fit(n, sums, np.array([q for _, q in found]).reshape(len(found), d), np.array([s * s / n for s, _ in found]), trace)
    if found:
        times = out.axes / np.sqrt(out.values)[:, None]

        def moments(m: np.ndarray) -> np.ndarray:
            y = (m - mean) @ times.T
            return np.concatenate([(y.T @ y).ravel(), y.sum(0)])
        both = summed(distinct, moments) / n
        k, y = len(found), both[len(found) ** 2:]
        out.identity_error = float(np.abs(both[:k * k].reshape(k, k) - np.outer(y, y) - np.eye(k)).max())
    return out


def _sums(m: np.ndarray) -> np.ndarray:
    """Sums of columns; raises where a long can't hold one."""
    if np.abs(m.astype(float)).sum(0).max() >= 2.0 ** 62:
        raise OverflowError("a sum beyond the range of a long")
    return m.sum(0)


def deviations(m: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """For each row the sum of (n x - S) ** 2, exact; raises where a long can't hold it."""
    if np.abs(m.astype(float)).max(initial=0) * n + np.abs(sums).max(initial=0) < 2.0 ** 62 and np.square(m * float(n) - sums).sum(1).max(initial=0) < 2.0 ** 62:
        return np.square(m * n - sums).sum(1)
    return np.array([sum((int(v) * n - int(s)) ** 2 for v, s in zip(row, sums)) for row in m], np.int64)


def whiten(rows: DataFrame, fitted: Fit | None, id_type: str, id_name: str = "vec_id") -> DataFrame:
    """One row for each row of ``rows`` (id, x) and component: the id, component, n, deviation, whitened, explained, identity_error."""
    schema = f"{id_name} {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.values):
        return rows.sparkSession.createDataFrame([], schema)
    n, sums, k = fitted.n, fitted.sums, len(fitted.values)
    times, share, error = fitted.axes / np.sqrt(fitted.values)[:, None], fitted.values / fitted.trace, fitted.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch, "x")
            rows = len(m)
            yield pa.RecordBatch.from_arrays([
                batch.column(id_name).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n)),
                pa.array(np.repeat(deviations(m, n, sums), k)), pa.array(((m - sums / n) @ times.T).ravel()), pa.array(np.tile(share, rows)), pa.array(np.full(rows * k, error))],
                names=[id_name, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.select(id_name, "x").mapInArrow(run, schema)


def whitened(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """``embeddings`` (vec_id, embedding) by their first components."""
    rows = whole(embeddings).select(F.col("row.vec_id").alias("vec_id"), "x")
    return whiten(rows, fit(rows, components), embeddings.schema["vec_id"].dataType.simpleString())
