"""Benchmark decontamination: approximate occurrences of benchmark items in documents, by the q-gram lemma.

An occurrence of an item of ``m`` characters with at most ``k = EDITS * m`` edits keeps ``m - Q + 1 - k * Q`` of the item's q-grams, all on
diagonals (place in the text less place in the item) no more than ``k`` apart. So:

1. every q-gram of a text that some item has is found (a bit table first, then the sorted grams), with each of its places in items;
2. hits are counted in bands of ``2 (k + 1)`` diagonals that overlap by half, so that any such occurrence lies in one band whole;
3. bands with as many hits as the lemma asks for are verified by a banded alignment (free ends in the text).

Characters are compared with A-Z lower-cased and all white space alike. Items are spread with the tasks in shards of at most
``SHARD_CHARS``; a larger benchmark takes a pass for each shard. Texts are worked on in pieces that overlap by more
than the longest occurrence.

Defined cases: null texts hold nothing; null items and items shorter than ``Q`` characters are left out; repeated items and rows are
reported each; a document that holds an item several times is reported once for it, at its best and then first place; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import chunks
from quarry.llm.store import release

Q, EDITS, SHARD_CHARS, PIECE = 8, 0.1, 1 << 20, 1 << 19
TABLE_BITS = 22
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
BORDER, FILL = 0x110000, 0x110001  # between texts, and after an item: no characters
SPACES = np.array([9, 10, 11, 12, 13], np.uint32)
HITS = "doc_id long, item_id long, edits int, ends_at long"


def characters(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    c = c + ((c >= 65) & (c <= 90)) * np.uint32(32)
    return np.where((c >= 9) & (c <= 13), np.uint32(32), c)


def grams(c: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` characters from each place on."""
    h, size, power = c.astype(np.uint64), 1, BASE
    while size < Q:
        h, size, power = h[:-size] * power + h[size:], 2 * size, np.uint64(int(power) ** 2 % 2**64)
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


class Items:
    """Inverted index of a shard's q-grams, and what alignment needs."""

    def __init__(self, rows: list[tuple[int | None, str]], edits: float):
        kept = [(i, characters(t)) for i, t in rows if t is not None and len(t) >= Q]
        self.ids = [i for i, _ in kept]
        self.m = np.array([len(c) for _, c in kept], np.int64)
        # beyond (m - Q) / Q edits the lemma would ask for no gram at all
        self.k = np.minimum((edits * self.m).astype(np.int64), (self.m - Q) // Q)
        self.least = self.m - Q + 1 - self.k * Q
        self.longest = int((self.m + self.k).max()) if kept else 0
        self.letters = np.full((len(kept), int(self.m.max()) if kept else 0), FILL, np.uint32)
        for row, (_, c) in zip(self.letters, kept, strict=True):
            row[: len(c)] = c
        all_grams = [grams(c) for _, c in kept] or [np.zeros(0, np.uint64)]
        item = np.repeat(np.arange(len(kept)), [len(g) for g in all_grams[: len(kept)]])
        at = np.concatenate([np.arange(len(g)) for g in all_grams])
        values = np.concatenate(all_grams)
        order = np.argsort(values, kind="stable")
        self.item, self.at = item[order], at[order]
        self.values, self.first, self.count = np.unique(values[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.values >> np.uint64(64 - TABLE_BITS)] = True

    def hits(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and diagonal of every shared q-gram."""
        g = grams(c)
        place = np.flatnonzero(self.table[g >> np.uint64(64 - TABLE_BITS)])
        gram = np.minimum(np.searchsorted(self.values, g[place]), len(self.values) - 1)
        same = self.values[gram] == g[place]
        place, gram = place[same], gram[same]
        n = self.count[gram]
        entry = np.repeat(self.first[gram] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.item[entry], np.repeat(place, n) - self.at[entry]

    def bands(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and lowest diagonal of the bands that the lemma lets pass."""
        item, diagonal = self.hits(c)
        low = int(self.m.max())
        band = (diagonal + low) // (self.k[item] + 1)  # half bands; each band is one and the next
        span = len(c) + 2 * low + 2
        key = item * span + band
        values, n = np.unique(key, return_counts=True)
        both = np.concatenate((values, values - 1))
        starts, back = np.unique(both, return_inverse=True)
        total = np.bincount(back, np.concatenate((n, n)))
        found = starts // span
        keep = (found >= 0) & (total >= self.least[np.maximum(found, 0)])
        found = found[keep]
        return found, (starts[keep] - found * span) * (self.k[found] + 1) - low

    def align(self, c: np.ndarray, item: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each item within its band, and where the first such occurrence ends."""
        width = 2 * int(self.k[item].max()) + 2
        steps = int(self.m[item].max())
        pad = steps + width
        text = np.concatenate((np.full(pad, BORDER, np.uint32), c, np.full(pad + steps, BORDER, np.uint32)))
        x = np.arange(width, dtype=np.int32)
        inside = x < 2 * (self.k[item] + 1)[:, None]
        far = np.int32(1 << 20)
        d = np.where(inside, np.int32(0), far)
        edits, ends = np.full(len(item), far), np.zeros(len(item), np.int64)
        base = (low + pad)[:, None] + x
        for i in range(1, steps + 1):
            miss = text[base + (i - 1)] != self.letters[item, i - 1][:, None]
            up = np.concatenate((d[:, 1:] + 1, np.full((len(d), 1), far)), axis=1)
            d = np.minimum(d + miss, up)
            d = np.minimum.accumulate(d - x, axis=1) + x
            d = np.where(inside, d, far)
            done = np.flatnonzero(self.m[item] == i)
            if len(done):
                best = d[done].argmin(axis=1)
                edits[done], ends[done] = d[done, best], low[done] + best + i
        return edits, ends

    def occurrences(self, c: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, edits, end) of verified bands."""
        if not len(self.values) or len(c) < Q:
            return []
        item, low = self.bands(c)
        out = []
        for i in range(0, len(item), 512):
            own, from_ = item[i : i + 512], low[i : i + 512]
            edits, ends = self.align(c, own, from_)
            good = edits <= self.k[own]
            out += zip(own[good].tolist(), edits[good].tolist(), ends[good].tolist(), strict=True)
        return out


def pieces(texts: list[str], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Joined characters of about ``PIECE``, the place where each part starts, and its (row, offset)."""
    parts, starts, names, size = [], [], [], 0
    for row, text in enumerate(texts):
        c = characters(text)
        for offset in range(0, max(1, len(c) - overlap), PIECE):
            part = c[offset : offset + PIECE + overlap]
            if parts and size + len(part) > PIECE:
                yield np.concatenate(parts), np.array(starts), names
                parts, starts, names, size = [], [], [], 0
            starts.append(size)
            names.append((row, offset))
            parts += [part, np.array([BORDER], np.uint32)]
            size += len(part) + 1
    if parts:
        yield np.concatenate(parts), np.array(starts), names


def shards(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark's rows, at most about ``SHARD_CHARS`` at a time."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // SHARD_CHARS))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for s in range(n):
        yield [tuple(r) for r in benchmark.where(shard == s).select(F.col("item_id").cast("long"), "text").collect()]


def found_in(texts: list[str | None], items: Items) -> list[tuple[int, int, int, int]]:
    """(row, item, edits, ends_at), sorted."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for c, starts, names in pieces([t or "" for t in texts], items.longest + Q):
        for item, n, end in items.occurrences(c):
            at = int(np.searchsorted(starts, end - 1, "right")) - 1
            row, offset = names[at]
            place = (n, end - int(starts[at]) + offset)
            best[row, item] = min(place, best.get((row, item), place))
    return sorted((row, item, n, end) for (row, item), (n, end) in best.items())


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """doc_id, item_id, edits, ends_at (character of the text): documents that hold a benchmark item."""
    narrow, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for rows in shards(benchmark):

        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            items = Items(rows, edits)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                found = found_in(batch.column("text").to_pylist(), items)
                columns = [
                    pa.array([ids[r[0]] for r in found], pa.int64()),
                    pa.array([items.ids[r[1]] for r in found], pa.int64()),
                    pa.array([r[2] for r in found], pa.int32()),
                    pa.array([r[3] for r in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "edits", "ends_at"])
            release()

        found = narrow.mapInArrow(run, HITS)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    for rows in shards(benchmark):

        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            items = Items(rows, edits)
            for batch in batches:
                # the text is sent once, in its row, and read some of it at a time
                texts = batch.column("row").field("text").cast(pa.string())
                good, done = np.ones(batch.num_rows, bool), 0
                for part in chunks(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
                    good[[done + r[0] for r in found_in(part.column("text").to_pylist(), items)]] = False
                    done += part.num_rows
                yield batch.filter(pa.array(good))
            release()

        kept = kept.mapInArrow(run, kept.schema)
    return kept.select("row.*")
