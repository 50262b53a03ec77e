"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

# Largest row count a side may have to be broadcast explicitly. Beyond it the
# join stays a shuffle join and AQE re-plans it from runtime statistics.
BROADCAST_MAX_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` only after proving it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so it stays cheap even when
    the side turns out to be large; in that case ``df`` is returned unhinted.
    """
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def rebalance_small_input(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has cores.

    A large input arrives in many file splits and is left alone (no shuffle
    of raw text). A small one (e.g. one Parquet row group) would run the
    whole analysis (tokenising, stemming) in one task; it is hash-partitioned
    by ``key`` instead (deterministic, so a retried task sees the same rows).
    The later postings aggregation still shuffles: the Python stemming step
    does not declare that it keeps the partitioning.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df


def dense_index(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Add a dense 1-based position ``name`` in the total order ``order``.

    Distributed equivalent of ``zipWithIndex`` after a sort: the sort is a
    range-partitioned shuffle, ``monotonically_increasing_id`` numbers rows
    inside each partition, and a table of per-partition counts (one row per
    partition, so bounded by the partition count) gives the offsets. The
    numbered rows are checkpointed so both uses see the same ids even if an
    executor is lost. ``order`` must be a total order (unique keys).
    """
    numbered = cut_lineage(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), 33)
    counts = numbered.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    local = F.col("_mid") - F.shiftleft(F.shiftright(F.col("_mid"), 33), 33)
    return (
        numbered.withColumn("_pid", part)
        .join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + local + F.lit(start)).cast("long"))
        .drop("_pid", "_mid", "_off")
    )
