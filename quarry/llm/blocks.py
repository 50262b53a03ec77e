"""Documents in blocks of consecutive ids, hashed word by word, and a sharded exchange of their keys.

A block is a run of consecutive ``doc_id`` of at most ``BLOCK_BYTES`` of text, or one id: what one task handles as arrays. Blocks ask each other
about keys (64-bit hashes) by way of buckets: every block sends its *distinct* keys of a bucket as one sorted array, and
the bucket's task answers each block. However many rows share a key, a bucket sees it at most once a block, so a hot key
is no hot task. Rows of one and the same id (or of null id, the last block) stay together.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import written

BLOCK_BYTES = 4 << 20
#: Letters that are hashed at a time.
LETTERS = 1 << 19
KEYS = "block int, bucket int, keys binary"
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(row: struct of all columns but the text, doc_id, text, block) and the number of blocks."""
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    cuts = byte_cuts(written(sizes.where("doc_id IS NOT NULL"), "sizes"), block_bytes) if total > block_bytes else []
    block = F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(cuts_below(F.col("doc_id"), cuts)) if cuts else F.lit(0)
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        block.cast("int").alias("block"),
    ), len(cuts) + 1


def byte_cuts(sizes: DataFrame, block_bytes: int) -> list[int]:
    """Ids after which a new block begins, so that a block holds ``block_bytes`` at most, or a single id.

    Ids are cut by rank first, and what holds too many bytes is cut again, 16-fold, until nothing does; then neighbours that
    fit together are one block. A few numbers a block reach the driver."""
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    n = 4 * -(-total // block_bytes)
    found = sizes.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 5 * n)).first()[0] if n > 1 else []
    cuts = sorted(set(found or []))
    while True:
        run = cuts_below(F.col("doc_id"), cuts) if cuts else F.lit(0)
        held = sizes.withColumn("run", run.cast("int")).groupBy("run")
        held = held.agg(F.sum("bytes").alias("bytes"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                        F.percentile_approx("doc_id", [i / 16 for i in range(1, 16)], 200).alias("parts")).orderBy("run").collect()
        heavy = [r for r in held if r["bytes"] > block_bytes and r["first"] < r["last"]]
        # a run's last id is no cut of its own; the id before it always is one, so that every round parts a heavy run
        finer = {c for r in heavy for c in [*r["parts"], r["first"]] if c < r["last"]}.difference(cuts)
        if not finer:
            break
        cuts = sorted(finer.union(cuts))
    kept, size = [], 0
    for before, r in zip([None, *held], held, strict=False):
        if before is not None and size + r["bytes"] > block_bytes:
            kept.append(before["last"])
            size = 0
        size += r["bytes"]
    return kept


def cuts_below(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are less than ``value``: first among every g-th, then among the g after it."""
    g = math.isqrt(len(cuts)) + 1
    runs = [cuts[i : i + g] for i in range(0, len(cuts), g)]
    fine = F.from_json(F.lit(json.dumps([*runs, []])), "array<array<bigint>>")
    ends = F.from_json(F.lit(json.dumps([run[-1] for run in runs])), "array<bigint>")
    run = F.size(F.filter(ends, lambda c: c < value))
    return F.least(run * g + F.size(F.filter(F.get(fine, run), lambda c: c < value)), F.lit(len(cuts)))


def buckets_for(blocks: int) -> int:
    """A power of two, about a quarter of the blocks."""
    return 1 << max(2, (blocks // 4).bit_length())


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts as arrays: hash of each word, and per text where its words start and end."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            raw = raw + (UPPER[raw] * np.uint8(32))
        inside = ~SPACE[raw]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        lengths = self.ends - self.starts
        first = np.cumsum(lengths) - lengths
        letters = raw[inside]
        self.hashes = np.zeros(len(lengths), np.uint64)
        if len(lengths):
            powers = np.cumprod(np.full(int(lengths.max()), BASE, np.uint64))
            # some words at a time: each letter takes many bytes for a moment
            cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, len(letters), LETTERS)), len(lengths)))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                start = first[a]
                part = letters[start : first[b - 1] + lengths[b - 1]].astype(np.uint64) + np.uint64(1)
                part *= powers[np.arange(len(part), dtype=np.int32) - np.repeat((first[a:b] - start).astype(np.int32), lengths[a:b])]
                self.hashes[a:b] = np.add.reduceat(part, first[a:b] - start)
            self.hashes = mix(self.hashes + lengths.astype(np.uint64))
        sizes = np.array([len(t) for t in texts], np.int64) + 1
        ends = np.cumsum(sizes)
        self.to = np.searchsorted(self.starts, ends)
        self.frm = np.concatenate(([0], self.to[:-1])) if len(texts) else self.to
        self.raw = raw

    def left(self) -> np.ndarray:
        """For each word: how many words of its text there are from it on."""
        return np.repeat(self.to, self.to - self.frm) - np.arange(len(self.hashes))

    def rolling(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on (only right where that many are left); by doubling."""
        h, size, power = self.hashes, 1, STEP
        out, done = None, 0
        n = len(h)

        def shifted(x: np.ndarray, by: int) -> np.ndarray:
            return np.concatenate((x[by:], np.zeros(min(by, n), np.uint64)))[:n]

        while True:
            if k & size:
                out = h if out is None else out * power + shifted(h, done)
                done += size
            if done == k:
                return mix(out)
            h, size, power = h * power + shifted(h, size), 2 * size, np.uint64(int(power) ** 2 % 2**64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` values from each place on (fewer at the end)."""
    top = np.iinfo(np.uint64).max
    m, size = x, 1
    while 2 * size <= width:
        m, size = np.minimum(m, np.concatenate((m[size:], np.full(min(size, len(m)), top, np.uint64)))[: len(m)]), 2 * size
    by = width - size
    return np.minimum(m, np.concatenate((m[by:], np.full(min(by, len(m)), top, np.uint64)))[: len(m)]) if by else m


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64) if buckets > 1 else np.zeros(len(keys), np.int64)


def by_bucket(block: int, keys: np.ndarray, buckets: int, pack: Callable[[np.ndarray], bytes]) -> pa.Table:
    """Rows of ``KEYS`` from distinct sorted keys: sorted keys lie bucket by bucket."""
    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(cuts))
    return pa.table(
        {
            "block": pa.array(np.full(len(used), block), pa.int32()),
            "bucket": pa.array(used, pa.int32()),
            "keys": pa.array([pack(keys[cuts[i] : cuts[i + 1]]) for i in used], pa.binary()),
        }
    )


def plain(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").tobytes()


def shared_keys(sent: DataFrame, later_only: bool = False) -> DataFrame:
    """block, keys: of the keys that blocks sent, those that several blocks have. ``later_only``: that a lower block has."""

    def meet(table: pa.Table) -> pa.Table:
        blocks = np.array(table.column("block").to_pylist(), np.int64)
        parts = [np.frombuffer(x, "<u8") for x in table.column("keys").to_pylist()]
        keys = np.concatenate(parts)
        owner = np.repeat(blocks, [len(p) for p in parts])
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        again = np.concatenate(([False], keys[1:] == keys[:-1]))
        found = again if later_only else again | np.concatenate((again[1:], [False]))
        keys, owner = keys[found], owner[found]
        order = np.argsort(owner, kind="stable")
        keys, owner = keys[order], owner[order]
        to, at = np.unique(owner, return_index=True)
        return pa.table({"block": pa.array(to, pa.int32()), "keys": pa.array(map(plain, np.split(keys, at[1:])) if len(to) else [], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(meet, "block int, keys binary")


def received(table: pa.Table) -> np.ndarray:
    """All keys that a block was sent, sorted."""
    return np.sort(np.frombuffer(b"".join(table.column("keys").to_pylist()), "<u8"))


def is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """``among`` sorted."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def texts_of(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table.column("text").cast(pa.large_binary()).to_pylist()]
