"""Incremental index refresh with Structured Streaming.

New page snapshots (Parquet files: page_id?, url, html, last_modified?)
arriving in a folder are picked up as a stream; each micro-batch adds a segment
with its new and changed pages to a segmented index (``sources/segments.py``)
through ``foreachBatch``. Unchanged pages are skipped (same last_modified), so a
re-crawl of an unchanged site costs one anti-join and writes nothing. The
stream's progress lives in the shared checkpoint folder, so a restarted job
resumes where it stopped; a batch that is tried again starts from the state
before it and overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.session import progress_dir
from quarry.sources.corpus import pages_as_corpus
from quarry.sources.segments import refresh_segments
from quarry.sources.stopwords import load_stopwords

SNAPSHOT_SCHEMA = "page_id long, url string, html string, last_modified string"


def refresh_batch(spark: SparkSession, batch: DataFrame, index_root: str, epoch: int) -> None:
    """Add one batch of page snapshots to the segmented index."""
    if not batch.isEmpty():
        refresh_segments(spark, index_root, pages_as_corpus(batch), load_stopwords(spark), epoch)


def start_refresh_stream(
    spark: SparkSession, source_dir: str, index_root: str, available_now: bool = True
) -> StreamingQuery:
    """Watch ``source_dir`` for snapshot files; ``index_root`` must hold a segmented index (``write_segments``)."""
    stream = spark.readStream.schema(SNAPSHOT_SCHEMA).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(lambda b, e: refresh_batch(spark, b, index_root, e)).option(
        "checkpointLocation", progress_dir(spark, "refresh-stream", index_root)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
