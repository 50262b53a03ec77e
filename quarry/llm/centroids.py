"""Centroid clustering (k-means on integers) with a vantage-point tree over the centroids.

Every round builds a tree over the centroids and broadcasts it (``k`` vectors, whatever the size of the table). A vector finds its
nearest centroid by best-first branch and bound: of the tree's nodes it has reached, it opens the one of the least lower
bound, until that bound exceeds the best distance so far. The bound of a child follows from the triangle inequality and the
distances, least and largest, between the vantage point and the child's centroids. A node whose bound equals the best
distance is still opened (with a margin for rounding), so of equally near centroids the one of the smallest number is found; distances
are integers. Vectors are taken in slices, in which those that open the same node are reckoned together.

Nothing is shuffled but a sum per cluster and task. Sums and their floors are exact. The prepared vectors are written once to
the shared folder and read in every round, so a lost executor costs its own tasks only.

Defined cases: vectors of another size than ``dims``, null ones and those with a null or non-finite component take no part; with fewer
than ``k`` vectors each starts a cluster; a null id starts none; repeated rows count each, and of rows of one id the one
of the least vector starts a cluster first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import written
from quarry.llm.vectors import exact, is_whole, matrix, scaled

K, ROUNDS, SCALE, DIMS, SEED = 8, 10, 1024, 64, 3
LEAF = 2
SLICE = 1 << 20  # numbers of a slice's table of bounds
MARGIN = 1e-9


class VantageTree:
    """Nodes: a vantage centroid and up to two children, or the few centroids of a leaf."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.most = int(np.abs(centroids).max(initial=0))
        self.nodes: list[tuple[list[int], list[tuple[int, float, float]]]] = []  # (centroids looked at here, (child, least, largest))
        if len(centroids):
            self.grow(list(range(len(centroids))))

    def grow(self, members: list[int]) -> int:
        at = len(self.nodes)
        if len(members) <= LEAF:
            self.nodes.append((members, []))
            return at
        self.nodes.append(([members[0]], []))
        rest = np.array(members[1:])
        gaps = (self.centroids[rest] - self.centroids[members[0]]).astype(np.float64)
        far = np.sqrt((gaps * gaps).sum(1))
        order = np.argsort(far, kind="stable")
        for part in (order[: len(order) // 2], order[len(order) // 2 :]):  # one part inside the radius, one on it and outside
            if len(part):
                child = self.grow(rest[part].tolist())
                self.nodes[at][1].append((child, float(far[part].min()), float(far[part].max())))
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid and the squared distance, for every row."""
        number, distance = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
        points, centroids = exact(vectors, self.most), exact(self.centroids, int(np.abs(vectors).max(initial=0)))
        step = max(1, SLICE // max(1, len(self.nodes)))
        for start in range(0, len(vectors), step):
            part = slice(start, start + step)
            number[part], distance[part] = self.search(points[part], centroids)
        return number, distance

    def search(self, points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(points)
        best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, len(centroids))
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0
        rows = np.arange(n)
        while True:
            opened = bounds[rows].argmin(1)
            low = bounds[rows, opened]
            on = low <= np.sqrt(best[rows].astype(np.float64)) * (1 + MARGIN) + MARGIN
            on &= np.isfinite(low)
            rows, opened, low = rows[on], opened[on], low[on]
            if not len(rows):
                return who, best
            for node in np.unique(opened):
                mine = opened == node
                ids, floor = rows[mine], low[mine]
                bounds[ids, node] = np.inf
                here, children = self.nodes[node]
                for c in here:
                    gap = points[ids] - centroids[c]
                    d = np.einsum("ij,ij->i", gap, gap).astype(np.int64)
                    better = (d < best[ids]) | ((d == best[ids]) & (c < who[ids]))
                    best[ids[better]], who[ids[better]] = d[better], c
                root = np.sqrt(d.astype(np.float64)) if children else None
                for child, least, largest in children:
                    reach = np.maximum(root - largest, least - root) - MARGIN * (root + largest)
                    bounds[ids, child] = np.maximum(floor, reach)


def prepared(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, dims: int = DIMS) -> DataFrame:
    """vec_id, v: the vectors that take part, as integers."""
    kept = rows.where(is_whole(F.col(vector)) & (F.size(vector) == dims))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col(vector), scale).alias("v"))


def starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.where("vec_id IS NOT NULL").orderBy(digest, "v").limit(k).collect()
    return np.array([r.v for r in first], np.int64).reshape(len(first), len(first[0].v) if first else 0)


def summed(vectors: DataFrame, tree, k: int, dims: int) -> dict[int, list[int]]:
    """The exact floor of the mean of every cluster that has vectors."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            points = matrix(batch.column("v"))
            if len(points):
                number, _ = tree.value.nearest(points)
                n += np.bincount(number, minlength=k)
                for c in np.unique(number):
                    total[c] += points[number == c].sum(0)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(has), pa.array(n[has]), pa.array(list(total[has]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    parts = vectors.select("v").mapInArrow(sums, "cluster long, n long, sums array<long>")
    whole = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    rows = parts.select("cluster", "n", F.posexplode("sums").alias("at", "sum")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), whole)
    means: dict[int, list[int]] = {}
    for r in rows.collect():  # k times dims rows
        means.setdefault(r["cluster"], [0] * dims)[r["at"]] = int(r["sum"]) // r["n"]
    return means


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (array<long>) of vectors (vec_id, v) of one size."""
    spark = vectors.sparkSession
    vectors = written(vectors, "vectors")
    centroids = starts(vectors, k, seed)
    k, dims = centroids.shape
    for _ in range(rounds if k else 0):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        means = summed(vectors, tree, k, dims)
        tree.destroy()
        before, centroids = centroids, centroids.copy()
        for c, mean in means.items():
            centroids[c] = mean
        if (before == centroids).all():
            break  # every later round would give the same
    last = VantageTree(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if k and batch.num_rows:
                number, distance = last.nearest(matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"]
                )

    found = written(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    rows = [(c, n, sum(sums.values()), centroids[c].tolist()) for c, n in sums.items()]
    of_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
