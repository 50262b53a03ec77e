"""Helpers shared by the training-data operators: reading tables, cutting lineage, batching text."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, so a lost executor repeats no earlier stage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string"))


def slices(spark: SparkSession, per_core: int = 4) -> int:
    """How many slices to split a hot group into: follows the cluster, at least 64."""
    return max(64, per_core * int(spark.conf.get("spark.sql.shuffle.partitions")))


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of about ``max_bytes`` of ``column`` (one longer row stays whole)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > max_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)
