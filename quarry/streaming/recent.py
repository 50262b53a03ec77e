"""Recent distinct values per key as a Structured Streaming job.

Events (user_id, ts, value) arriving in a folder are folded into a state
table holding, per key, at most k most recent distinct values. Each
micro-batch is pre-aggregated to one row per (key, value) (partial
aggregation, so a key with a third of the events is reduced map-side),
unioned with the current state (<= k rows per key), and cut back to k per
key with ``row_number() <= k`` (applied per partition before the shuffle).
The state never holds more than k rows per key and no group is collected
whole. Each batch writes a new state version in the shared folder; the
stream's progress is checkpointed there too.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.results import recent_distinct
from quarry.session import progress_dir

EVENTS_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def latest_state(spark: SparkSession, state_root: str, before: int | None = None) -> str | None:
    """Path of the newest finished ``version=N`` state (``N < before`` if
    given), or None before the first batch. A version counts once its marker,
    which is written last, is there; only markers are read."""
    try:
        done = spark.read.schema("version long").json(os.path.join(state_root, "finished", "*"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        done = done.where(F.col("version") < before)
    newest = done.select(F.max("version")).first()[0]
    return None if newest is None else os.path.join(state_root, f"version={newest}")


def fold_batch(
    spark: SparkSession, batch: DataFrame, state_root: str, epoch: int, key: str, value: str, ts: str, k: int
) -> None:
    """Merge one micro-batch into the newest state and write the next version."""
    fresh = batch.groupBy(key, value).agg(F.max(ts).alias("last_ts"))
    # batch e folds onto the newest state below e and writes e: a retried
    # batch (at-least-once) starts from the same base and overwrites its output
    prev = latest_state(spark, state_root, before=epoch)
    if prev is not None:
        fresh = fresh.unionByName(spark.read.parquet(prev).select(key, value, "last_ts"))
    state = recent_distinct(fresh.withColumnRenamed("last_ts", ts), key=key, value=value, ts=ts, k=k)
    state.write.mode("overwrite").parquet(os.path.join(state_root, f"version={epoch}"))
    marker = spark.range(1).select(F.lit(epoch).cast("long").alias("version"))
    marker.write.mode("overwrite").json(os.path.join(state_root, "finished", str(epoch)))


def start_recent_stream(
    spark: SparkSession,
    source_dir: str,
    state_root: str,
    key: str = "user_id",
    value: str = "props",
    ts: str = "ts",
    k: int = 5,
    available_now: bool = True,
) -> StreamingQuery:
    stream = spark.readStream.schema(EVENTS_SCHEMA).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(
        lambda b, e: fold_batch(spark, b, state_root, e, key, value, ts, k)
    ).option("checkpointLocation", progress_dir(spark, "recent-stream", state_root))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
