"""Physical-plan guards for the scale properties the design relies on."""

import contextlib
import io
import os
import tempfile

import pytest

from conftest import SF0001
from __spark_entry__ import queries
from quarry.operators import search as srch
from quarry.operators.analyze import analyze
from quarry.operators.index import build_index
from quarry.plans.catalog import benchmark_queries
from quarry.sources.corpus import documents_as_corpus, read_table
from quarry.sources.stopwords import load_stopwords
from quarry.sources.store import read_index, write_index


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_join_and_no_row_udf(spark, name):
    p = plan(queries()[name](spark, SF0001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


@pytest.fixture(scope="module")
def stored(spark):
    corpus = documents_as_corpus(read_table(spark, SF0001, "documents"))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-plan-"), "index")
    write_index(build_index(analyze(corpus, load_stopwords(spark)), corpus), path, block_rows=300)
    return read_index(spark, path)


def test_search_plan_on_stored_index(spark, stored):
    p = plan(srch.search(benchmark_queries(spark, SF0001), stored))
    # query terms prune the blocks of the stored index at run time
    assert "dynamicpruningexpression(block" in p
    # the query side is broadcast, the index side is streamed
    assert "BroadcastHashJoin" in p
    # per-partition top-k runs before the shuffle of the window
    first_limit = p.index("WindowGroupLimit")
    assert "Exchange" in p[first_limit:]
    # only needed columns are read from the weights
    assert "ReadSchema: struct<page_id:bigint,term:string,nweight:double>" in p


def test_stemming_is_arrow_batched(spark):
    p = plan(queries()["postings_body"](spark, SF0001))
    assert "MapInArrow" in p
    assert "PushedFilters" in p or "ReadSchema" in p
