"""Connected components of an edge table, in Spark: large stars and small stars in turn, after a contraction in each task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import written

EDGES = "a long, b long"


class Forest:
    """Union-find over any values; the root of a set is its least value."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.setdefault(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.parent[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b

    def edges(self) -> Iterable[tuple[int, int]]:
        return ((x, r) for x in list(self.parent) if (r := self.root(x)) != x)


#: nodes that a task contracts at a time
NODES = 1_000_000


def contract(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: stars of the components that a task sees among some of its edges."""

    def stars(forest: Forest) -> pa.RecordBatch:
        found = np.array(list(forest.edges()), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                forest.join(a, b)
            if len(forest.parent) > NODES:
                yield stars(forest)
                forest = Forest()
        yield stars(forest)

    return edges.mapInArrow(run, EDGES)


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable), for every node of an edge (a, b; a <> b)."""
    e = written(contract(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")).distinct(), "edges")
    before = None
    while True:
        # large star: each node's higher neighbours are tied to its least neighbour
        both = e.select("a", "b").union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: each node and its lower neighbours are tied to the least of them
        low = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        small = low.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        e = written(small.select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("component"))
            ).distinct()
        before = now
