"""Exact k-means on integer vectors, with bounds loosened by the norm of total displacement."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import stored

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Largest magnitude of an integer component; squared distances then fit in 64 bits.
LARGEST = 1 << 27
#: Up to this magnitude sums of products are exact in double precision.
EXACT_IN_DOUBLE = 1 << 22
#: Centroids that share a lower bound.
GROUP = 8
#: Bounds are square roots in double precision; what they must clear for a safe verdict.
SLACK = 1e-9

_STATE = (
    "vec_id bigint, vector array<int>, cluster int, near double, near_round int, "
    "far array<double>, far_round array<int>"
)


class History:
    """All centroids so far, round by round, and how far each has moved since each round."""

    def __init__(self, rounds: list[np.ndarray]):
        self.rounds = rounds
        self.now = rounds[-1]
        self.last = len(rounds) - 1
        k = len(self.now)
        self.groups = np.arange(k) // GROUP
        self.n_groups = int(self.groups[-1]) + 1
        gaps = [(self.now - then).astype(np.float64) for then in rounds]
        #: [round, centroid]: norm of the total displacement since that round.
        self.moved = np.stack([np.sqrt((gap * gap).sum(axis=1)) for gap in gaps])
        starts = np.arange(0, k, GROUP)
        #: [round, group]: the largest of its centroids.
        self.group_moved = np.maximum.reduceat(self.moved, starts, axis=1)
        self.exact = np.abs(self.now).max() <= EXACT_IN_DOUBLE

    def squared(self, vectors: np.ndarray, members: slice) -> np.ndarray:
        """Exact squared distances of vectors to some of the present centroids."""
        centroids = self.now[members]
        if self.exact and (not vectors.size or np.abs(vectors).max() <= EXACT_IN_DOUBLE):
            x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        else:
            x, c = vectors, centroids
        found = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        return found.astype(np.int64)

    def squared_own(self, vectors: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        gap = vectors - self.now[cluster]
        return (gap * gap).sum(axis=1)


def advance(
    history: History,
    vectors: np.ndarray,
    cluster: np.ndarray,
    near: np.ndarray,
    near_round: np.ndarray,
    far: np.ndarray,
    far_round: np.ndarray,
) -> int:
    """Assign vectors to the nearest present centroid, in place; returns the vectors rescanned.

    ``near`` is the distance to the own centroid as it was in round ``near_round``, ``far`` a
    lower bound of the distances to the other centroids of each group, as they were in
    ``far_round``. By the triangle inequality a bound loosens by the norm of the centroid's
    total displacement since then, which is never more than the sum of its steps. Where a lower
    bound does not clear the upper one, the distance to the own centroid is computed anew, and
    where that does not help, the distances to the whole group, in exact integers. Ties go to
    the smaller number; a bound that clears has no ties.
    """
    now = history.last
    upper = near + history.moved[near_round, cluster]
    lower = far - np.take_along_axis(history.group_moved, far_round, axis=0)
    rows = np.flatnonzero((lower <= _above(upper)[:, None]).any(axis=1))
    if not len(rows):
        return 0
    own = history.squared_own(vectors[rows], cluster[rows])
    near[rows], near_round[rows] = np.sqrt(own.astype(np.float64)), now
    failed = lower[rows] <= _above(near[rows])[:, None]
    again = failed.any(axis=1)
    rows, own, failed, lower = rows[again], own[again], failed[again], lower[rows][again]
    if not len(rows):
        return 0
    before = cluster[rows]
    unknown = np.iinfo(np.int64).max
    squared = np.full((len(rows), len(history.now)), unknown)
    squared[np.arange(len(rows)), before] = own
    for g in range(history.n_groups):
        scanned = np.flatnonzero(failed[:, g])
        members = slice(g * GROUP, min((g + 1) * GROUP, len(history.now)))
        squared[scanned, members] = history.squared(vectors[rows[scanned]], members)
    best = squared.argmin(axis=1)
    nearest = squared[np.arange(len(rows)), best]
    squared[np.arange(len(rows)), best] = unknown
    for g in range(history.n_groups):
        scanned = np.flatnonzero(failed[:, g])
        members = slice(g * GROUP, min((g + 1) * GROUP, len(history.now)))
        far[rows[scanned], g] = _distance(squared[scanned, members].min(axis=1))
        far_round[rows[scanned], g] = now
    # A vector that leaves its centroid has it among the others of a group not looked at.
    group = history.groups[before]
    left = np.flatnonzero((best != before) & ~failed[np.arange(len(rows)), group])
    g = group[left]
    far[rows[left], g] = np.minimum(lower[left, g], np.sqrt(own[left].astype(np.float64)))
    far_round[rows[left], g] = now
    cluster[rows] = best
    near[rows] = np.sqrt(nearest.astype(np.float64))
    return len(rows)


def _above(upper: np.ndarray) -> np.ndarray:
    return upper * (1 + SLACK) + SLACK


def _distance(squared: np.ndarray) -> np.ndarray:
    """Distances; without a centroid to measure it is infinite."""
    none = squared == np.iinfo(np.int64).max
    return np.where(none, np.inf, np.sqrt(np.where(none, 0, squared).astype(np.float64)))


def _assigned(state: DataFrame, rounds: list[np.ndarray]) -> DataFrame:
    """The state with every vector at the nearest of the last centroids."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history = History(rounds)
        dims, groups = history.now.shape[1], history.n_groups
        for batch in batches:
            n = batch.num_rows

            def column(name, width=None, batch=batch, n=n):
                values = batch.column(name)
                values = values.flatten() if width else values
                flat = values.to_numpy(zero_copy_only=False).copy()
                return flat.reshape(n, width) if width else flat

            vectors = column("vector", dims).astype(np.int64)
            own = [column(c) for c in ("cluster", "near", "near_round")]
            bounds = [column(c, groups) for c in ("far", "far_round")]
            advance(history, vectors, *own, *bounds)
            lists = [_lists(a, groups) for a in bounds]
            kept = [batch.column("vec_id"), batch.column("vector")]
            names = ["vec_id", "vector", "cluster", "near", "near_round", "far", "far_round"]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, own), *lists], names)

    return state.mapInArrow(move, _STATE)


def _lists(values: np.ndarray, width: int) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def integer_vectors(embeddings: DataFrame, dims: int = DIMENSIONS) -> DataFrame:
    """``(vec_id, vector)`` of the rows with ``dims`` finite components, scaled and rounded down.

    Components beyond ``LARGEST`` after scaling are taken as that; a squared distance would not
    fit in 64 bits.
    """
    given = F.col("embedding").cast("array<double>")

    def finite(x):
        return x.isNotNull() & (F.abs(x) < float("inf"))  # NaN is above infinity

    def component(x):
        held = F.greatest(F.least(x * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
        return F.floor(held).cast("int")

    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), given.alias("given"))
    rows = rows.filter((F.size("given") == dims) & F.forall("given", finite))
    return rows.select("vec_id", F.transform("given", component).alias("vector"))


def _first_centroids(vectors: DataFrame, clusters: int) -> np.ndarray:
    """Vectors with the smallest hashes of their ids, at most ``clusters``."""
    name = F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    hashed = vectors.withColumn("hash", F.sha2(name, 256))
    chosen = hashed.orderBy("hash", "vector").limit(clusters).collect()
    return np.array([row["vector"] for row in chosen], np.int64)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise mean of each cluster, rounded down; an empty cluster keeps its centroid.

    Summed per task first: one row a cluster leaves each task, and one a cluster reaches the
    driver.
    """
    dims = centroids.shape[1]
    sums = [F.sum(F.get("vector", F.lit(i)).cast("bigint")).alias(f"s{i}") for i in range(dims)]
    means = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        means[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return means


def clustered(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMENSIONS,
) -> DataFrame:
    """Clusters of vectors by ``rounds`` rounds of k-means and one last assignment.

    ``embeddings`` needs vec_id and embedding; other columns are ignored. Vectors that are null,
    of another length, or with a null or non-finite component are left out. Repeated rows are
    vectors of their own; a vector without an id is hashed by an empty one. With fewer vectors
    than ``clusters`` there are as many centroids as vectors; an empty table gives no rows.

    The state of a round (vector, cluster, bounds) is written to the shared folder; centroids of
    all rounds go to the tasks, ``rounds`` x ``clusters`` x ``dims`` numbers.

    Returns vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.
    """
    spark = embeddings.sparkSession
    vectors = stored(integer_vectors(embeddings, dims), "vectors")
    centroids = [_first_centroids(vectors, clusters)]
    if not len(centroids[0]):
        return spark.createDataFrame(
            [],
            "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, "
            "inertia bigint, centroid_sha256 string",
        )
    groups = History(centroids).n_groups
    # Nothing is known yet: upper bounds are infinite, lower ones are below everything.
    state = vectors.select(
        "*",
        F.lit(0).alias("cluster"),
        F.lit(float("inf")).alias("near"),
        F.lit(0).alias("near_round"),
        F.array_repeat(F.lit(float("-inf")), groups).alias("far"),
        F.array_repeat(F.lit(0), groups).alias("far_round"),
    )
    for _ in range(rounds):
        state = stored(_assigned(state, centroids), "assigned")
        centroids.append(_means(state, centroids[-1]))
    state = _assigned(state, centroids)
    return _described(state, centroids[-1])


def _described(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    spark = state.sparkSession
    rows = [(i, row) for i, row in enumerate(centroids.tolist())]
    table = spark.createDataFrame(rows, "cluster int, centroid array<bigint>").select(
        "*", F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256")
    )
    squares = F.zip_with("vector", "centroid", lambda x, c: (x - c) * (x - c))
    distance = F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)
    measured = state.select("vec_id", "vector", "cluster").join(F.broadcast(table), "cluster")
    measured = stored(
        measured.select("vec_id", "cluster", distance.alias("distance"), "centroid_sha256"), "clusters"
    )
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    parts = measured.groupBy("cluster").agg(whole.alias("part")).collect()
    sums = [(row["cluster"], int(row["part"])) for row in parts]
    total = sum(part for _, part in sums)
    inertia = spark.createDataFrame(sums, "cluster int, cluster_inertia bigint")
    return measured.join(F.broadcast(inertia), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        F.lit(total).cast("bigint").alias("inertia"),
        "centroid_sha256",
    )
