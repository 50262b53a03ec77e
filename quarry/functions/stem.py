"""Arrow-batched stemming.

Stemming is the one step with no built-in Spark expression. It runs through
``mapInArrow`` on whole token arrays: each Arrow batch is flattened, the
distinct words of the batch are stemmed once (with a bounded per-process
memo shared across batches), and the stems are put back into the same list
offsets. No row-at-a-time Python and no extra shuffle: the step stays in the
stage that scanned the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.functions.porter import stem as stem_word
from quarry.session import ship_package

_MEMO: dict[str, str] = {}
_MEMO_LIMIT = 150_000  # words; all workers of an executor have one


def _stem_cached(word: str) -> str:
    s = _MEMO.get(word)
    if s is None:
        s = stem_word(word)
        if len(_MEMO) >= _MEMO_LIMIT:
            _MEMO.clear()
        _MEMO[word] = s
    return s


def stem_values(values: pa.Array) -> pa.Array:
    """Stem a string array, touching each distinct value once."""
    if len(values) == 0:
        return values
    encoded = pc.dictionary_encode(values)
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    stems = pa.array([None if w is None else _stem_cached(w) for w in encoded.dictionary.to_pylist()], values.type)
    return pc.take(stems, encoded.indices)


def stem_lists(lists: pa.Array) -> pa.Array:
    """Stem every element of a list<string> array, keeping its offsets."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten()
    stemmed = stem_values(flat)
    offsets = lists.offsets
    if len(offsets) and offsets[0].as_py() != 0:
        offsets = pc.subtract(offsets, offsets[0])
    list_type = type(lists)
    return list_type.from_arrays(offsets, stemmed, type=lists.type, mask=lists.is_null() if lists.null_count else None)


def _replace_column(batch: pa.RecordBatch, name: str, fn) -> pa.RecordBatch:
    idx = batch.schema.get_field_index(name)
    arrays = list(batch.columns)
    arrays[idx] = fn(arrays[idx])
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


def stem_array_column(df: DataFrame, column: str) -> DataFrame:
    """Replace the array<string> ``column`` of ``df`` by its stems."""
    ship_package(df.sparkSession)  # the workers import this module

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _replace_column(batch, column, stem_lists)

    return df.mapInArrow(run, df.schema)


def stem_string_column(df: DataFrame, column: str) -> DataFrame:
    """Replace the string ``column`` of ``df`` by its stem."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _replace_column(batch, column, stem_values)

    return df.mapInArrow(run, df.schema)
