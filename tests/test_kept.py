"""What is used several times is written once, as Parquet, and what workers hold stays small."""

import contextlib
import io

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.functions import stem as st
from quarry.operators import search as srch
from quarry.operators.analyze import analyze, group_terms, page_postings, token_slices
from quarry.operators.index import build_index, postings, refresh_index
from quarry.plans.catalog import documents_index
from quarry.session import cut_lineage


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def write_documents(spark, folder, n=40):
    text = F.concat_ws(" ", F.lit("plover heron"), F.concat(F.lit("bird"), F.col("id") % 7), F.lit("heron"))
    rows = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length(text).alias("n_chars"))
    rows.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_written_rows_are_read_by_column(spark):
    kept = cut_lineage(spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("wide")))
    assert "ReadSchema: struct<id:bigint>" in plan(kept.select("id")) and "ExistingRDD" not in plan(kept)
    assert kept.count() == 100 and kept.schema.simpleString() == "struct<id:bigint,wide:string>"
    assert cut_lineage(spark.range(0)).count() == 0


def test_kept_index_analyses_the_text_once(spark, tmp_path):
    folder = write_documents(spark, tmp_path)
    kept, anew = documents_index(spark, folder, keep=True).index, documents_index(spark, folder).index
    assert "MapInArrow" not in plan(kept.weights) and "MapInArrow" in plan(anew.weights)
    rows = lambda i: sorted((r.page_id, r.term, round(r.weight, 9), round(r.nweight, 9)) for r in i.weights.collect())
    assert rows(kept) == rows(anew)


def test_hits_are_summed_where_the_page_lies(spark, tmp_path):
    """No exchange between a page's weights and the sum of its hits of a query, so that no row per query word is shuffled."""
    index = documents_index(spark, write_documents(spark, tmp_path), keep=True).index
    parsed = cut_lineage(srch.parse_queries(spark.createDataFrame([(1, 'heron plover bird3 "plover heron"')], "query_id long, query string")))
    plain = srch.scored_candidates(parsed, index)._jdf.queryExecution().optimizedPlan().toString()
    assert plain.count("Aggregate [query_id") >= 1
    text = srch.scored_candidates(parsed, index)._jdf.queryExecution().executedPlan().toString().splitlines()
    sums = [i for i, line in enumerate(text) if "HashAggregate(keys=[query_id" in line and "sum(cosine" in line]
    assert sums
    below = text[sums[0] : next(i for i in range(sums[0], len(text)) if "Window" in text[i])]
    assert not any("Exchange hashpartitioning" in line for line in below)


def test_refresh_from_postings_is_that_from_tokens(spark):
    schema = "page_id long, url string, title string, body string, last_modified string, size long"
    old = spark.createDataFrame([(0, "a", "t", "wren wren crow", "", 1), (1, "b", "u", "crow", "", 1)], schema)
    new = spark.createDataFrame([(0, "a", "t", "finch crow finch", "2", 1), (9, "c", "v w", "", "", 1)], schema)
    base = build_index(None, old, page_postings(old))
    rows = lambda i: sorted((r.field, r.term, r.page_id, r.tf, tuple(r.positions)) for r in postings(i.wide).collect())
    assert rows(refresh_index(base, new, page_postings)) == rows(refresh_index(base, new, analyze))


def test_memo_and_slices_are_small(spark):
    words = [[f"w{i}x{j}" for j in range(50_000)] for i in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(words), pa.array([[]] * 8, pa.list_(pa.string()))], names=["page_id", "body", "title"])
    parts = [*token_slices(batch)]
    assert sum(group_terms(p, True).num_rows for p in parts) == 400_000
    assert len(parts) > 1 and len(st._MEMO) <= 150_000
