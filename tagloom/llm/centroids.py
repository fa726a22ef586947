"""Clusters around integer centroids by a tournament of bisectors.

For each pair of centroids a < b the points that are nearer to b lie on one side of a plane:
2 x.(b - a) > |b|^2 - |a|^2. The normals b - a and these thresholds are computed once for all pairs. A
vector then runs through the centroids from the first to the last: the sign of one linear form decides
between the winner so far and the next one, and zero leaves the winner, which has the smaller number. So
k - 1 tests per vector name the nearest centroid, and the distance is computed to that one only.
All numbers are integers and every comparison is exact.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import DecimalType

from tagloom.session import Scratch

# Components beyond this bound are refused: squared distances would not fit a long.
MAX_COMPONENT = 1 << 27
_EXACT_IN_DOUBLE = 1 << 53
_BLOCK_ROWS = 1 << 13


def scaled(vector: Column, scale: int, bound: int = MAX_COMPONENT) -> Column:
    """The components times `scale`, rounded down to a long. One beyond `bound` is an error."""
    refused = F.raise_error(F.lit(f"a component times {scale} is beyond {bound}")).cast("long")

    def component(c):
        x = c.cast("double") * scale
        return F.when(F.abs(x) > bound, refused).otherwise(F.floor(x))

    return F.transform(vector, component)


def finite(vector: Column) -> Column:
    """Whether there is a vector and all its components are numbers."""
    def number(c):
        x = c.cast("double")
        return c.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return vector.isNotNull() & F.forall(vector, number)


class Tournament:
    """Normals and thresholds of all pairs of the centroids, which are rows of integers."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k, largest = len(centroids), int(np.abs(centroids).max(initial=0))
        self.normals = {(a, b): centroids[b] - centroids[a] for b in range(k) for a in range(b)}
        squares = (centroids * centroids).sum(axis=1)
        self.thresholds = {(a, b): int(squares[b] - squares[a]) for a, b in self.normals}
        self._reach = 4 * max(1, largest) * centroids.shape[1]

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row; of equally near ones the smallest."""
        winner = np.zeros(len(vectors), np.int64)
        # Products of doubles are faster, and exact as long as no sum can pass 2^53.
        small = self._reach * max(1, int(np.abs(vectors).max(initial=0))) < _EXACT_IN_DOUBLE
        points = vectors.astype(np.float64) if small else vectors
        for b in range(1, len(self.centroids)):
            for a in np.unique(winner):
                rows = np.flatnonzero(winner == a)
                sides = 2 * (points[rows] @ self.normals[a, b].astype(points.dtype))
                winner[rows[sides > self.thresholds[a, b]]] = b
        return winner

    def distances(self, vectors: np.ndarray, winner: np.ndarray) -> np.ndarray:
        apart = vectors - self.centroids[winner]
        return (apart * apart).sum(axis=1)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _blocks(batches, size: int):
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK_ROWS):
            part = batch.slice(at, _BLOCK_ROWS)
            yield part, _matrix(part.column("x"), size)


def kept_vectors(vectors: DataFrame, size: int, scale: int, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """`vec_id` and `x`, the scaled components, of the vectors of `size` numbers."""
    vector = F.col(vector_column)
    return vectors.where((F.size(vector) == size) & finite(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"), scaled(vector, scale).alias("x"))


def _first_centroids(kept: DataFrame, k: int) -> list[Row]:
    """The k vectors whose ids have the smallest hashes; equal ids go by their components."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return kept.orderBy(F.sha2(name.cast("binary"), 256), "x").limit(k).collect()


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the mean of its vectors, rounded down. One row per task and cluster is
    shuffled, and one per cluster reaches the driver."""
    k, size = centroids.shape

    def add_up(batches):
        rules = Tournament(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for _, x in _blocks(batches, size):
            winner = rules.nearest(x)
            counts += np.bincount(winner, minlength=k)
            for a in np.unique(winner):
                sums[a] += x[winner == a].sum(axis=0)
        full = np.flatnonzero(counts)
        cells = [(int(a), i, int(counts[a]), int(sums[a, i])) for a in full for i in range(size)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in (zip(*cells) if cells else [()] * 4)],
            ["cluster", "place", "n", "total"])

    parts = kept.select("x").mapInArrow(add_up, "cluster long, place long, n long, total long")
    found = parts.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast(DecimalType(38, 0))).alias("total"))
    moved = centroids.copy()
    for cluster, place, n, total in found.collect():
        moved[cluster, place] = int(total) // n
    return moved


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64,
            id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assignments (`vec_id`, `cluster`, `distance`) in the shared folder, and the centroids.

    Vectors of another length than `size`, and those that are NULL or hold NULL or what is no finite
    number, are left out; components are multiplied by `scale` and rounded down. The first centroids are the
    vectors with the smallest sha256 of "1:" and the id, equal ids (and rows without an id, whose id
    counts as empty) in order of their components. Fewer vectors than `k` give that many centroids.
    Each of `rounds` rounds moves every centroid with vectors to the floor of their mean; equally
    near centroids are decided for the smaller number. Rows that repeat count as often as they are given;
    other columns are not looked at; an empty table gives no rows and no centroids. A component
    beyond 2^27 after scaling is an error, as distances would not fit a long.
    """
    scratch = Scratch(vectors.sparkSession, "centroids")
    kept = scratch.save(kept_vectors(vectors, size, scale, id_column, vector_column), "kept")
    first = [row.x for row in _first_centroids(kept, k)]
    centroids = np.array(first, np.int64).reshape(-1, size)
    for _ in range(rounds if len(first) else 0):
        centroids = _moved(kept, centroids)
    schema = "vec_id long, cluster int, distance long"

    def assign(batches):
        rules = Tournament(centroids)
        for part, x in _blocks(batches, size):
            winner = rules.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(winner.astype(np.int32)),
                 pa.array(rules.distances(x, winner))], ["vec_id", "cluster", "distance"])

    return scratch.save(kept.mapInArrow(assign, schema), "assigned"), centroids


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """The assignments of `cluster` with `cluster_inertia` and `inertia` (distances summed over the
    cluster and over all) and `centroid_sha256` (of the components, joined by commas)."""
    assigned, centroids = cluster(vectors, **options)
    # One row per centroid.
    sums = dict(assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast(DecimalType(38, 0)))).collect())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(i, int(sums.get(i, 0)), int(sum(sums.values())), name) for i, name in enumerate(names)]
    table = vectors.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance",
                                                               *table.columns[1:])
