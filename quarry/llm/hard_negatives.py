"""Hard-negative mining by length buckets and coordinate pruning (as in LEMP), over integer vectors and their inner products.

Rows are ranked by length, longest first, and cut into buckets of ``BUCKET`` rows. A bucket holds, beside its rows, one list per
coordinate of its rows sorted by that coordinate of their direction. Anchors form blocks. A block meets a bucket only if some anchor of
it could reach what it asks for with the bucket's longest row. There, for each anchor:

1. rows too short to reach the score asked for are left out (a prefix of the bucket remains, as it is sorted by length);
2. the score asked for, over the lengths, is the least cosine wanted. For each of the anchor's ``FOCUS`` largest coordinates it
   gives a range of values that a row's coordinate must lie in; the range is cut out of that coordinate's sorted list;
3. rows that lie in all these ranges are candidates; their inner products are reckoned exactly.

What an anchor asks for: for its positives the best rows of its label, and for each positive the best rows of other labels that
score between 80 and 100 percent of the positive's score. Buckets are met in rounds, the longest one first and then ``GROWTH`` times as
many in each round, and once an anchor has as many rows as wanted, only rows that score as much as the last of them are asked for.

Every task has one block and one bucket, so no label, anchor or vector is hot. What is kept between rounds is the best few rows of each
anchor. Ranges are widened by ``MARGIN`` for rounding; no row that counts is lost.

Defined cases: rows with a null label, null vector, or a null or non-finite component take no part; shorter vectors count as filled
up with zeros; a null id comes after all others in ties; rows that are equal in everything are rows of their own; an anchor of
length zero, or one that asks for scores of zero or less, verifies all rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import written
from quarry.llm.vectors import exact, is_whole, matrix, scaled
from quarry.operators.util import dense_index

SCALE, POSITIVES, NEGATIVES, LEAST, MOST = 256, 5, 5, 80, 100
BUCKET, BLOCK, GROWTH, FOCUS = 4096, 8192, 8, 3
MARGIN = 1e-9
BUCKETS = "bucket long, longest long, ranks array<long>, ids array<long>, labels array<long>, v array<array<long>>, lists array<array<int>>"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, anchor_row long, positive_row long"
FOUND = "anchor long, slot int, score long, vec_id long, row long"


def prepared(rows: DataFrame, label: Column, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: the rows that take part."""
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("v"))
    return kept.where(F.col("label").isNotNull() & is_whole(F.col("v"))).withColumn("v", scaled(F.col("v"), scale))


def directions(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.sqrt((v.astype(np.float64) ** 2).sum(1))
    return lengths, v / np.maximum(lengths, 1e-300)[:, None]


def length_buckets(ranked: DataFrame) -> DataFrame:
    """A row per bucket of rows (row, vec_id, label, v), ``row`` being the rank by length."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by("row")
        v = matrix(rows.column("v"))
        _, unit = directions(v)
        lists = np.argsort(unit, axis=0, kind="stable").T.astype(np.int32)
        one = lambda values, kind: pa.array([values], kind)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows.column("bucket")[0].as_py()], pa.int64()),
                pa.array([int((v[0] * v[0]).sum())], pa.int64()),
                one(rows.column("row").to_numpy(), pa.list_(pa.int64())),
                one(rows.column("vec_id").to_pylist(), pa.list_(pa.int64())),
                one(rows.column("label").to_numpy(), pa.list_(pa.int64())),
                one(list(v), pa.list_(pa.list_(pa.int64()))),
                one(list(lists), pa.list_(pa.list_(pa.int32()))),
            ],
            names=["bucket", "longest", "ranks", "ids", "labels", "v", "lists"],
        )

    dealt = ranked.withColumn("bucket", F.floor((F.col("row") - 1) / BUCKET))
    return dealt.groupBy("bucket").applyInArrow(build, BUCKETS)


class Bucket:
    """A length bucket in a task."""

    def __init__(self, row: pa.Table, width: int, partner: int):
        of = lambda name: row.column(name).combine_chunks().flatten()
        self.ranks, self.labels = of("ranks").to_numpy(), of("labels").to_numpy()
        self.ids, self.no_id = of("ids").fill_null(0).to_numpy(), of("ids").is_null().to_numpy(zero_copy_only=False)
        v = matrix(of("v"))
        if v.shape[1] < width:
            v = np.pad(v, ((0, 0), (0, width - v.shape[1])))
        self.lengths, unit = directions(v)
        self.lists = matrix(of("lists"))
        if len(self.lists) < width:  # coordinates that only anchors have: all zero here
            self.lists = np.vstack([self.lists, np.tile(np.arange(len(v)), (width - len(self.lists), 1))])
        self.values = np.take_along_axis(unit, self.lists.T, 0)
        self.v = exact(v, partner)

    def candidates(self, direction: np.ndarray, length: float, asked: float) -> np.ndarray:
        """Rows that may reach the score asked for."""
        if asked <= 0:
            return np.arange(len(self.v))
        if length == 0:
            return np.arange(0)
        enough = asked / length * (1 - MARGIN)
        long_enough = int(np.searchsorted(-self.lengths, -enough, "right"))
        if not long_enough:
            return np.arange(0)
        angle = np.arccos(min(1.0, enough / self.lengths[0]))
        focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        own = np.arccos(np.clip(direction[focus], -1, 1))
        low = np.cos(np.minimum(np.pi, own + angle)) - MARGIN
        high = np.cos(np.maximum(0.0, own - angle)) + MARGIN
        hits = np.zeros(len(self.v), np.int8)
        for f, a, b in zip(focus, low, high, strict=True):
            values = self.values[:, f]
            hits[self.lists[f, np.searchsorted(values, a, "left") : np.searchsorted(values, b, "right")]] += 1
        return np.flatnonzero(hits[:long_enough] == len(focus))

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the k best among ``rows``: higher scores, then smaller ids, then longer rows."""
        if len(rows) > k:
            on = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        else:
            on = np.arange(len(rows))
        of = rows[on]
        return on[np.lexsort((self.ranks[of], self.ids[of], self.no_id[of], -scores[on]))[:k]]


def meet(same: bool, k: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            anchors = left.column("anchors").combine_chunks().flatten()
            ranks, labels = (anchors.field(c).to_numpy() for c in ("row", "label"))
            slots = anchors.field("slots").to_pylist()
            v = matrix(anchors.field("v"))
            bucket = Bucket(right, v.shape[1], int(np.abs(v).max(initial=0)))
            if v.shape[1] < bucket.v.shape[1]:
                v = np.pad(v, ((0, 0), (0, bucket.v.shape[1] - v.shape[1])))
            lengths, unit = directions(v)
            v = v.astype(bucket.v.dtype)
            for i in range(len(v)):
                lows = [s["low"] for s in slots[i]]
                rows = bucket.candidates(unit[i], lengths[i], -1.0 if None in lows else float(min(lows)))
                alike = bucket.labels[rows] == labels[i]
                rows = rows[(alike & (bucket.ranks[rows] != ranks[i])) if same else ~alike]
                scores = (bucket.v[rows] @ v[i]).astype(np.int64)
                for s in slots[i]:
                    on = np.ones(len(rows), bool) if s["low"] is None else scores >= s["low"]
                    if s["high"] is not None:
                        on &= scores <= s["high"]
                    places = bucket.best(rows[on], scores[on], k)
                    for row, score in zip(rows[on][places].tolist(), scores[on][places].tolist(), strict=True):
                        vec_id = None if bucket.no_id[row] else int(bucket.ids[row])
                        found.append((int(ranks[i]), s["slot"], score, vec_id, int(bucket.ranks[row])))
        columns = list(zip(*found, strict=True)) if found else [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor", "slot", "score", "vec_id", "row"])

    return run


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def top_rows(anchors: DataFrame, slots: DataFrame, index: DataFrame, n_buckets: int, same: bool, k: int) -> DataFrame:
    """anchor, slot, score, vec_id, row, place: the k best rows for each of the slots (anchor, slot, low, high) of anchors (block, row, label, v).

    ``same``: rows of the anchor's label other than itself, else rows of other labels; low and high bound the score, null does not.
    """
    best, start, end = None, 0, 1
    while start < n_buckets:
        asked = slots
        if best is not None:  # rows below the last of k rows are not asked for
            last = best.groupBy("anchor", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last")).where(F.col("n") == k)
            asked = slots.join(last.drop("n"), ["anchor", "slot"], "left").select(
                "anchor", "slot", F.greatest("low", "last").alias("low"), "high"
            )
        of_anchor = asked.groupBy(F.col("anchor").alias("row")).agg(
            F.collect_list(F.struct("slot", "low", "high")).alias("slots"), F.min(F.coalesce("low", F.lit(0))).alias("least")
        )
        length = F.sqrt(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x))
        need = F.when(F.col("least") <= 0, -1.0).when(length == 0, float("inf")).otherwise(F.col("least") / length)
        packed = anchors.join(of_anchor, "row").groupBy("block").agg(
            F.min(need).alias("need"), F.collect_list(F.struct("row", "label", "v", "slots")).alias("anchors")
        )
        blocks = written(packed, "anchor-blocks")
        lengths = index.select("bucket", (F.sqrt("longest") * (1 + 1e-6)).alias("reach"))
        first, last = F.lit(start).cast("long"), F.lit(min(end, n_buckets) - 1).cast("long")
        pairs = blocks.select("block", "need", F.explode(F.sequence(first, last)).alias("bucket"))
        pairs = written(pairs.join(lengths, "bucket").where("reach >= need").select("block", "bucket"), "pairs")
        left = pairs.join(blocks.select("block", "anchors"), "block")
        right = pairs.withColumnsRenamed({"block": "of_block", "bucket": "b"}).join(index, F.col("b") == F.col("bucket")).drop("b")
        found = left.groupBy("block", "bucket").cogroup(right.groupBy("of_block", "bucket")).applyInArrow(meet(same, k), FOUND)
        if best is not None:
            found = found.unionByName(best.drop("place"))
        best = written(best_of(found, k), "best-rows")
        start, end = end, end * GROWTH
    return best


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, anchor_row, positive_row of rows (vec_id, label, v).

    ``anchor_row`` and ``positive_row`` tell rows of equal ids apart.
    """
    numbered = written(rows.withColumn("_n", F.monotonically_increasing_id()), "vectors")
    length = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    ranked = written(dense_index(numbered, [length.desc(), F.col("_n")], "row").drop("_n"), "by-length")
    index = written(length_buckets(ranked), "length-buckets")
    n_buckets = index.count()
    chosen = dense_index(ranked.where(is_anchor), [F.col("row")], "n")
    anchors = written(chosen.withColumn("block", F.floor((F.col("n") - 1) / BLOCK)).drop("n"), "anchors")
    none = F.lit(None).cast("long")
    all_rows = anchors.select(F.col("row").alias("anchor"), F.lit(0).alias("slot"), none.alias("low"), none.alias("high"))
    found = top_rows(anchors, all_rows, index, n_buckets, True, positives)
    if found is None:
        return rows.sparkSession.createDataFrame([], MINED)
    chosen = found.select("anchor", F.col("place").alias("slot"), "score", F.col("vec_id").alias("positive_id"), F.col("row").alias("positive_row"))
    # least and largest whole scores within the shares
    bounds = F.expr(f"({LEAST} * score + 99) div 100").alias("low"), F.expr(f"{MOST} * score div 100").alias("high")
    slots = chosen.where("score >= 0").select("anchor", "slot", *bounds)
    best = top_rows(anchors, slots, index, n_buckets, False, negatives)
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return best.join(chosen.withColumnRenamed("score", "positive_score"), ["anchor", "slot"]).join(named, "anchor").select(
        "anchor_id",
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
        F.col("anchor").alias("anchor_row"),
        "positive_row",
    )
