"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

With X the n centred rows, each step multiplies a small vector v by the rows (u = Xv, spread over the
tasks like the rows) and the result by the transposed rows (X'u, summed over the tasks), and makes both
orthogonal to all earlier ones. After j steps X V = U B with a small upper bidiagonal matrix B, whose
singular values and right vectors give the components and the deviations along them.

The long vectors u are never stored. Each is a combination of the rows, u = Xp, so a task computes its
part of all of them from the small p. As U'r, r'r and X'r of a new r = Xv - bU[-1] are all that the
orthogonalisation needs, a step is one pass over the rows and a few numbers per task.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType

from tagloom.llm.centroids import finite, scaled
from tagloom.session import Scratch

# Directions below this share of the total deviation have none, up to rounding.
_RANK = 1e-12
_BLOCK_ROWS = 1 << 12
_DECIMAL = DecimalType(38, 0)
# Components beyond this bound are refused: sums within a task would not fit a long.
MAX_COMPONENT = 1 << 40


class Rows:
    """The distinct vectors, each once, packed in blocks of small integers in the shared folder.

    `n` is their number, `totals` the sums of the components (exact), `size` their length.
    """

    def __init__(self, kept: DataFrame, scratch: Scratch):
        self.size = size = kept.agg(F.max(F.size("x"))).first()[0] or 0

        def pack(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, _BLOCK_ROWS):
                    x = _matrix(batch.column("x").slice(at, _BLOCK_ROWS), size)
                    largest = np.abs(x).max(initial=0)
                    kind = np.dtype(next(t for t in (np.int16, np.int32, np.int64)
                                         if largest <= np.iinfo(t).max))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(x)], pa.int64()), pa.array([kind.str]),
                         pa.array([x.astype(kind).tobytes()], pa.binary())], ["n", "kind", "rows"])

        distinct = kept.select(padded("x", size).alias("x")).distinct()
        self.blocks = scratch.save(distinct.mapInArrow(pack, "n long, kind string, rows binary"), "blocks")
        self.n = self.blocks.agg(F.sum("n")).first()[0] or 0
        self.totals = [0] * size
        if self.n and size:
            for place, total in self._by_place(lambda x: x.sum(axis=0, dtype=np.int64), "long").collect():
                self.totals[place] = int(total)
        self.mean = np.array([total / self.n for total in self.totals]) if self.n else np.zeros(size)

    def _by_place(self, function, kind: str) -> DataFrame:
        """Sums over all blocks of the numbers that `function` gives for a block."""
        size = self.size

        def partial(batches):
            found = None
            for batch in batches:
                for kind, rows in zip(*(batch.column(c).to_pylist() for c in ("kind", "rows"))):
                    values = function(np.frombuffer(rows, kind).reshape(-1, size))
                    found = values if found is None else found + values
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)],
                    ["place", "value"])

        parts = self.blocks.select("kind", "rows").mapInArrow(partial, f"place int, value {kind}")
        value = F.col("value").cast(_DECIMAL) if kind == "long" else F.col("value")
        return parts.groupBy("place").agg(F.sum(value).alias("value"))

    def summed(self, function, length: int) -> np.ndarray:
        """Sum of `function` (of centred rows, giving `length` doubles) over all blocks."""
        mean, found = self.mean, np.zeros(length)
        for place, value in self._by_place(lambda x: function(x - mean), "double").collect():
            found[place] = value
        return found


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def padded(name: str, size: int):
    """Zeros after the end of shorter vectors."""
    return F.concat(F.col(name), F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size(name)))


class Bidiagonal:
    """The state of the iteration: V (size x steps), P with U = XP, X'U, and B's two diagonals.

    Where the space that the start reaches ends, B gets a zero and a new start is taken outside it, as
    there may be larger components (or equal ones) that it doesn't reach.
    """

    def __init__(self, rows: Rows, least: float):
        self.rows, self.least, size = rows, least, rows.size
        self.v, self.p, self.back = (np.zeros((size, 0)) for _ in range(3))
        self.alphas, self.betas = [], [0.0]
        self.next_v = self._start()

    def _start(self) -> np.ndarray:
        """A unit vector that is orthogonal to V."""
        w = np.cos(1.0 + np.arange(self.rows.size) ** 2 + self.v.shape[1])
        return self._outside(w / np.linalg.norm(w), unit=True)

    def _outside(self, w: np.ndarray, unit: bool = False) -> np.ndarray:
        for _ in range(3 if unit else 2):
            w = w - self.v @ (self.v.T @ w)
            w = w / np.linalg.norm(w) if unit else w
        return w

    def step(self) -> None:
        """One product with the rows and one with the transposed rows."""
        size, v, p = self.rows.size, self.next_v, self.p
        direction = v - self.betas[-1] * p[:, -1] if p.shape[1] else v

        def products(x):
            r = x @ direction
            return np.concatenate([x.T @ r, (x @ p).T @ r, [r @ r]])

        found = self.rows.summed(products, size + p.shape[1] + 1)
        back, overlaps, square = found[:size], found[size:-1], found[-1]
        alpha = np.sqrt(max(0.0, square - overlaps @ overlaps))
        if alpha > self.least:
            new_p, back = (direction - p @ overlaps) / alpha, (back - self.back @ overlaps) / alpha
        else:
            alpha, new_p, back = 0.0, np.zeros(size), np.zeros(size)
        self.v, self.p = np.column_stack([self.v, v]), np.column_stack([p, new_p])
        self.back = np.column_stack([self.back, back])
        self.alphas.append(alpha)
        if len(self.alphas) == size:
            return
        w = self._outside(back - alpha * v)
        beta = np.linalg.norm(w)
        self.betas.append(beta if beta > self.least else 0.0)
        self.next_v = w / beta if beta > self.least else self._start()

    def svd(self) -> tuple[np.ndarray, np.ndarray]:
        """Singular values, falling, and the right vectors as columns."""
        b = np.diag(self.alphas) + np.diag(self.betas[1:], 1)
        _, values, right = np.linalg.svd(b)
        return values, self.v @ right.T


def components(rows: Rows, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance, falling, and unit components as columns; those without any
    deviation are left out. As many passes over the rows as a vector has components."""
    if rows.size == 0 or rows.n == 0:
        return np.zeros(0), np.zeros((rows.size, 0))
    total = float(np.sqrt(rows.summed(lambda x: np.array([(x * x).sum()]), 1)[0]))
    if total == 0:
        return np.zeros(0), np.zeros((rows.size, 0))
    state = Bidiagonal(rows, _RANK * total)
    for _ in range(rows.size):
        state.step()
    values, axes = state.svd()
    found = np.flatnonzero(values[:count] > _RANK * total)
    axes = axes[:, found]
    return values[found] ** 2 / rows.n, axes / np.linalg.norm(axes, axis=0)


def _deviations(x: np.ndarray, n: int, totals: list[int]) -> pa.Array:
    """Sum of (n x - S)^2 of each row, exact."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, totals), default=0))
    if 4 * largest * largest * max(1, x.shape[1]) < 1 << 62:
        apart = n * x - np.array(totals, np.int64)
        return pa.array((apart * apart).sum(axis=1)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(sum((n * c - s) ** 2 for c, s in zip(row, totals)))
                     for row in x.tolist()], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, count: int = 4, scale: int = 256, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """`vec_id`, `component` (from 1), `n`, `deviation`, `whitened`, `explained`, `identity_error` for
    every vector and each of the first `count` components.

    Vectors that are NULL or hold NULL or what is no finite number are left out; components are
    multiplied by `scale` and rounded down. Every different vector counts once in the `n` that are
    fitted. Vectors shorter than the longest count as zero in what they lack. Components along which nothing
    deviates are not returned: a table of one different vector, like an empty one, gives no rows.
    `deviation` is the exact sum of squares of n x - S, S being the sums, as a decimal. Rows that
    repeat come as often as they are given, rows without an id keep NULL, other columns are not
    looked at. A component beyond 2^40 after scaling is an error.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    vector = F.col(vector_column)
    kept = scratch.save(vectors.where(finite(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"), scaled(vector, scale, MAX_COMPONENT).alias("x")), "kept")
    rows = Rows(kept, scratch)
    values, axes = components(rows, count)
    size, n, totals, mean = rows.size, rows.n, rows.totals, rows.mean
    k = len(values)
    projection = axes / np.sqrt(values)
    if k:
        # Total variance, and the covariance of what is projected, over the same rows.
        def check(x):
            z = x @ projection
            return np.concatenate([[(x * x).sum()], z.sum(axis=0), (z.T @ z).ravel()])

        found = rows.summed(check, 1 + k + k * k)
        trace, means = found[0] / n, found[1:1 + k] / n
        error = np.abs(found[1 + k:].reshape(k, k) / n - np.outer(means, means) - np.eye(k)).max()
        explained = values / trace

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, _BLOCK_ROWS):
                part = batch.slice(at, _BLOCK_ROWS)
                x = _matrix(part.column("x"), size)
                m = len(x)
                deviations = _deviations(x, n, totals)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)),
                     deviations.take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(((x - mean) @ projection).ravel()),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error"])

    return kept.select("vec_id", padded("x", size).alias("x")).mapInArrow(
        project, "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
                 "explained double, identity_error double")
