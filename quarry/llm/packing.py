"""Best-fit packing by length-histogram planning.

Documents are cut into pieces of at most ``capacity`` tokens. How many pieces there are of each length (at most
``capacity`` numbers) is all the planner needs: it runs best-fit decreasing over these counts, placing whole runs of equal
pieces into whole runs of equally full sequences at a time, and emits slots: "pieces ``rank_from`` to ``rank_to`` of this
length go to sequences from ``sequence``, ``per_sequence`` in each, from ``at``". Pieces then take their slots
by joining on their rank within their length.

Ranks are counted in slices of each length (as many as the cluster has tasks for), and offset by the slices before, so that
a length with a third of all pieces is no single task.

Defined cases: null text is an empty document (its end id only); null and repeated ids are packed like others (rows that
are equal in every column are interchangeable); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import chunks, slices, written
from quarry.llm.store import release
from quarry.llm.tokens import encoder

CAPACITY = 4096
SLOTS = "length long, rank_from long, rank_to long, sequence long, per_sequence long, at long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, on demand, ids (binary, unsigned 32-bit little-endian)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = []
                raws = encode(["" if t is None else t for t in part.column("text").to_pylist()])
                for doc_id, raw in zip(part.column("doc_id").to_pylist(), raws, strict=True):
                    raw += end
                    for i, at in enumerate(range(0, len(raw), 4 * capacity)):
                        own = raw[at : at + 4 * capacity]
                        rows.append((doc_id, i, at // 4, len(own) // 4, zlib.crc32(own), own))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns[: len(names)], names=names)
        release()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over (length: pieces). Rows of ``SLOTS``; each piece goes where least room is left."""
    slots, used = [], 0
    room: dict[int, list[tuple[int, int]]] = {}  # room left: runs of sequences (first, how many)
    rooms: list[int] = []  # its keys in order

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                bisect.insort(rooms, left)
                room[left] = []
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                left = rooms[i]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[i]
            else:
                left, first, n = capacity, used, -(-todo // (capacity // length))
                used += n
            each = min(left // length, todo)
            taken = min(n, todo // each)
            slots.append((length, rank, rank + taken * each, first, each, capacity - left))
            put(left, first + taken, n - taken)
            put(left - each * length, first, taken)
            rank, todo = rank + taken * each, todo - taken * each
    return slots


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...). Read ``parts`` from a table: it is read thrice."""
    spark = parts.sparkSession
    counts = parts.groupBy("length").count().collect()  # at most ``capacity`` rows
    if any(not 0 < r["length"] <= capacity for r in counts):
        raise ValueError(f"a piece has between 1 and {capacity} tokens")
    slots = spark.createDataFrame(plan({r["length"]: r["count"] for r in counts}, capacity), SLOTS)
    n = slices(spark)
    sliced = parts.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n)))
    order = [c for c in ("doc_id", "piece", "ids_crc32") if c in parts.columns]
    local = F.row_number().over(Window.partitionBy("length", "slice").orderBy(*order)) - 1
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # at most capacity x slices rows
    offsets = sliced.groupBy("length", "slice").count().select(
        "length", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    ranked = (
        sliced.withColumn("local", local)
        .join(offsets, ["length", "slice"])
        .withColumn("rank", F.col("before") + F.col("local"))
        .drop("slice", "local", "before")
    )
    # the plan's size follows the number of lengths, not of documents
    placed = ranked.join(F.broadcast(slots), "length").where(
        (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    )
    turn = F.col("rank") - F.col("rank_from")
    return placed.select(
        *parts.columns,
        (F.col("sequence") + F.floor(turn / F.col("per_sequence")).cast("long")).alias("sequence_id"),
        (F.col("at") + F.pmod(turn, F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    return pack(written(pieces(docs, tokenizer, end_id, capacity, ids=False), "pieces"), capacity)
