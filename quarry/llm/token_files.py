"""Token-ID files: independent zstandard frames with a trailing seek table and per-frame checksums.

A file holds documents in ascending ``doc_id`` order, each as one zstandard frame of its ids (unsigned little-endian
integers of 16 or 32 bits), then one frame with the index (doc ids), then the seek table in the zstandard seekable
format: a skippable frame listing each frame's compressed size, size and checksum (low 32 bits of XXH64). A reader
fetches the table, and then only the frames it is asked for.

Documents are dealt to files by ranges of ``doc_id``, so reading the files in order gives all documents in order. A task
writes under a name of its own and renames the whole file at its end; a repeated task replaces it by the same bytes.

Defined cases: null text is an empty document (its end id only); null ids come first; rows of equal id are ordered by
text; an empty table writes no file; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.shared import chunks, shared_path, written
from quarry.llm.store import store
from quarry.llm.tokens import encoder

#: Fixed values of the zstandard seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Start of the index frame: format name, bytes per id, documents.
INDEX = struct.Struct("<4sBq")
NAME = b"QTOK"
MANIFEST = "shard int, path string, n_docs long, n_tokens long"


class Writer:
    def __init__(self, out, width: int, level: int = 3):
        self.out, self.width, self.tokens = out, width, 0
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.doc_ids: list[int | None] = []
        self.table: list[tuple[int, int, int]] = []

    def _frame(self, raw: bytes) -> None:
        frame = self.compressor.compress(raw)
        self.out.write(frame)
        self.table.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._frame(ids.astype(f"<u{self.width}").tobytes())
        self.doc_ids.append(doc_id)
        self.tokens += len(ids)

    def close(self) -> None:
        known = np.array([i is not None for i in self.doc_ids], "u1")
        ids = np.array([i or 0 for i in self.doc_ids], "<i8")
        self._frame(INDEX.pack(NAME, self.width, len(ids)) + ids.tobytes() + known.tobytes())
        body = np.array(self.table, "<u4").tobytes() + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class Reader:
    """Random access to the documents of one file (an open random-access file)."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        end = file.tell()
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table")
        file.seek(end - 9 - 12 * n)
        self.table = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        self.decompressor = zstandard.ZstdDecompressor()
        raw = self.frame(n - 1)
        name, self.width, docs = INDEX.unpack_from(raw)
        if name != NAME or docs != n - 1:
            raise ValueError("no index")
        ids = np.frombuffer(raw, "<i8", docs, INDEX.size).tolist()
        known = np.frombuffer(raw, "u1", docs, INDEX.size + 8 * docs).tolist()
        self.doc_ids = [i if k else None for i, k in zip(ids, known, strict=True)]

    def frame(self, i: int) -> bytes:
        size, full, checksum = self.table[i].tolist()
        self.file.seek(int(self.at[i]))
        raw = self.decompressor.decompress(self.file.read(size), max_output_size=full)
        if len(raw) != full or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        return raw

    def document(self, i: int) -> np.ndarray:
        return np.frombuffer(self.frame(i), f"<u{self.width}")

    def lengths(self) -> np.ndarray:
        return self.table[:-1, 1] // self.width


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``path``; returns the manifest, one row per file."""
    path = path or shared_path(docs.sparkSession, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = 2 if max(len(encode.bytes_of) - 1, end_id) < 1 << 16 else 4
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        files, root = store(path)
        name, draft = f"{root}/shard-{shard:06d}.tok.zst", f"{root}/.draft-{shard:06d}-{attempt}"
        writer = None
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = ["" if t is None else t for t in part.column("text").to_pylist()]
                if writer is None and texts:
                    files.create_dir(root)
                    out = files.open_output_stream(draft)
                    writer = Writer(out, width)
                for doc_id, raw in zip(part.column("doc_id").to_pylist(), encode.encode(texts), strict=True):
                    ids = np.frombuffer(raw, "<u4")
                    writer.add(doc_id, np.append(ids, np.uint32(end_id)))
        if writer:
            writer.close()
            out.close()
            files.move(draft, name)
            row = (shard, f"{path}/{name.rpartition('/')[2]}", len(writer.doc_ids), writer.tokens)
            types = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array([v], t) for v, t in zip(row, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "path", "n_docs", "n_tokens"])

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    return written(dealt.sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary, unsigned 32-bit little-endian) from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, name = store(row["path"])
                with files.open_input_file(name) as file:
                    reader = Reader(file)
                    starts = row["base"] + np.concatenate(([0], np.cumsum(reader.lengths())))
                    step = 256
                    for a in range(0, len(reader.doc_ids), step):
                        rows = range(a, min(a + step, len(reader.doc_ids)))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[a : a + step], pa.int64()),
                                pa.array(starts[list(rows)], pa.int64()),
                                pa.array([reader.document(i).astype("<u4").tobytes() for i in rows], pa.binary()),
                            ],
                            names=["doc_id", "start", "ids"],
                        )

    # one row per file: the running sum in one task is as small as the list of files
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("shard", "path", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    n = max(1, manifest.count())
    return files.repartitionByRange(n, "shard").mapInArrow(read, "doc_id long, start long, ids binary")
