"""Text analysis: tokenise -> lower-case -> stem -> stop-word filter, with positions.

Positions are 0-based over **all** tokens of a field; stop words take a
position but are not kept. Each page row is expanded once for both fields
(one scan), stemmed per Arrow batch in the same stage, and filtered with a
broadcast anti-join against the (bounded) stop-stem table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.stem import stem_array_column, stem_values
from quarry.functions.text import lower_tokens, tokenize
from quarry.operators.util import bounded_broadcast
from quarry.session import release, ship_package

FIELDS = ("body", "title")
SLICE_TOKENS = 200_000  # grouped at a time
POSTINGS = (
    "page_id long, term string, body_tf long, title_tf long, body_positions array<int>, title_positions array<int>"
)


def field_terms(corpus: DataFrame, stem: bool = True) -> DataFrame:
    """``(page_id, field, terms array<string>)``: per field, the lower-cased
    (and stemmed) tokens in order."""
    per_field = F.array(
        *[
            F.struct(F.lit(f).alias("field"), lower_tokens(tokenize(F.col(f))).alias("terms"))
            for f in FIELDS
        ]
    )
    df = corpus.select("page_id", F.inline(per_field))
    return stem_array_column(df, "terms") if stem else df


def analyze(corpus: DataFrame, stopwords: DataFrame | None = None, stem: bool = True) -> DataFrame:
    """``(page_id, field, pos, term)`` for every kept token."""
    tokens = field_terms(corpus, stem).select("page_id", "field", F.posexplode("terms").alias("pos", "term"))
    if stopwords is not None:
        stops = bounded_broadcast(stopwords.select("term").distinct(), max_rows=100_000)
        tokens = tokens.join(stops, "term", "left_anti")
    return tokens.select("page_id", "field", "pos", "term")


def page_postings(corpus: DataFrame, stopwords: DataFrame | None = None, stem: bool = True) -> DataFrame:
    """``(page_id, term, body_tf, title_tf, body_positions, title_positions)``
    straight from the pages, one row per page and term.

    All tokens of a page sit in its row, so the Arrow step that stems them
    also groups them: no token is ever a row of its own, and nothing is
    shuffled. Stop stems are left out of the grouped rows. Rows of one page id
    are parts of one page: their postings are merged, as in ``wide_postings``
    (their ids are looked for first, in a scan of that column alone; the
    postings of all other pages are not shuffled)."""
    ship_package(corpus.sparkSession)
    arrays = corpus.select("page_id", *[lower_tokens(tokenize(F.col(f))).alias(f) for f in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (group_terms(part, stem) for part in token_slices(batch))
            release()

    wide = arrays.mapInArrow(run, POSTINGS)
    repeated = corpus.groupBy("page_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("page_id")
    if not repeated.isEmpty():
        joined = lambda c: F.array_sort(F.flatten(F.collect_list(c))).alias(c)
        parts = wide.join(repeated, "page_id", "left_semi").groupBy("page_id", "term")
        merged = parts.agg(F.sum("body_tf").alias("body_tf"), F.sum("title_tf").alias("title_tf"), joined("body_positions"), joined("title_positions"))
        wide = wide.join(repeated, "page_id", "left_anti").select(*wide.columns).unionByName(merged)
    if stopwords is None:
        return wide
    stops = bounded_broadcast(stopwords.select("term").distinct(), max_rows=100_000)
    return wide.join(stops, "term", "left_anti").select(*wide.columns)


def token_slices(batch: pa.RecordBatch, tokens: int = SLICE_TOKENS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole pages of about so many tokens (one longer page stays whole)."""
    lengths = sum(pc.fill_null(pc.list_value_length(batch.column(f)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for f in FIELDS)
    upto = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + tokens, "right")))
        yield batch.slice(start, end - start)
        start = end


def group_terms(batch: pa.RecordBatch, stem: bool) -> pa.RecordBatch:
    """Postings of a batch of (page_id, body, title) token arrays."""
    owners, positions, fields, flats = [], [], [], []
    for f, name in enumerate(FIELDS):
        lists = batch.column(name)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        owners.append(np.repeat(np.arange(len(lengths)), lengths))
        positions.append(np.arange(lengths.sum()) - np.repeat(starts, lengths))
        fields.append(np.full(lengths.sum(), f))
        flats.append(lists.flatten())
    encoded = pc.dictionary_encode(pa.concat_arrays(flats))
    words = stem_values(encoded.dictionary) if stem else encoded.dictionary
    stems = pc.dictionary_encode(words)
    code = stems.indices.to_numpy(zero_copy_only=False)[encoded.indices.to_numpy(zero_copy_only=False)].astype(np.int64)
    owner, position, field = map(np.concatenate, (owners, positions, fields))
    key = owner * max(1, len(stems.dictionary)) + code
    order = np.lexsort((position, field, key))
    key, position, in_title = key[order], position[order].astype(np.int32), field[order] == 1
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    columns = [
        batch.column("page_id").take(pa.array(owner[order][first])),
        stems.dictionary.take(pa.array(code[order][first])),
    ]
    counts, lists = [], []
    for mine in (~in_title, in_title):
        n = np.add.reduceat(mine.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        counts.append(pa.array(n))
        offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
        lists.append(pa.ListArray.from_arrays(offsets, pa.array(position[mine])))
    return pa.RecordBatch.from_arrays(
        [*columns, *counts, *lists], names=["page_id", "term", "body_tf", "title_tf", "body_positions", "title_positions"]
    )


def tokenize_frame(corpus: DataFrame, stem: bool = True, stopwords: DataFrame | None = None) -> DataFrame:
    """Token statistics per page and field (number of tokens / kept terms)."""
    terms = field_terms(corpus, stem)
    out = terms.select("page_id", "field", F.size("terms").alias("n_tokens"))
    if stopwords is None:
        return out.withColumn("n_kept", F.col("n_tokens"))
    kept = analyze(corpus, stopwords, stem).groupBy("page_id", "field").agg(F.count(F.lit(1)).alias("n_kept"))
    return out.join(kept, ["page_id", "field"], "left").select(
        "page_id", "field", "n_tokens", F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept")
    )
