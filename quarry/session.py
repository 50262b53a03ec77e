"""Spark session and shared-storage helpers.

Everything in the library takes a ``SparkSession`` from the caller; these
helpers only build a local session for tests/bench and resolve the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import hashlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """A local session configured the way tests and ``bench.py`` run."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses the directory already set on the context, else the cluster's
    ``spark.checkpoint.dir``. Only a local-mode session (tests, bench) may
    fall back to a fresh scratch folder; on a cluster an unset value is an
    error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/…) for this job")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def progress_dir(spark: SparkSession, stream: str, root: str) -> str:
    """Where a stream over ``root`` keeps its progress: a folder of its own
    for every root, below ``spark.checkpoint.dir`` where that is set (so a
    restarted stream finds it again)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return os.path.join(base, f"{stream}-{hashlib.sha256(root.rstrip('/').encode()).hexdigest()[:24]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder (never local) and read back.

    As Parquet, not as an RDD checkpoint: that holds uncompressed serialised rows, many times the size of the
    same columns in Parquet, and is read with all its columns whatever a consumer asks for. The shuffle files of the job
    that wrote it are let go."""
    path = os.path.join(checkpoint_dir(df.sparkSession), f"kept-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    release_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted now. Spark deletes them once the driver has collected the job's
    plan as garbage; a driver with memory to spare puts that off while they fill the executors' disks."""
    spark.sparkContext._jvm.System.gc()


def release() -> None:
    """Called in a Python worker: give memory that is free again back to the system. Workers live on between tasks, and
    all of an executor's count."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python workers import the functions they run by name, so they need the
    package however the driver came to find it. The archive is only read by
    the driver, which serves it to the executors (``addPyFile``).
    """
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="quarry-package-"), "quarry.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*")):
            if path.suffix in (".py", ".txt"):
                z.write(path, f"{root.name}/{path.relative_to(root)}")
    sc.addPyFile(archive)
    sc._quarry_shipped = True
