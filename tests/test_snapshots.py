"""Stop-word files, repeated URLs in a snapshot, stream folders, crawl budgets, and the package on the workers."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from quarry.operators.analyze import analyze
from quarry.operators.index import build_index, latest_per_url, refresh_index
from quarry.operators.links import crawl_tree, derived_edges
from quarry.session import progress_dir
from quarry.sources.stopwords import load_stopwords
from quarry.streaming.recent import latest_state

CORPUS = "page_id long, url string, title string, body string, last_modified string, size long"


def test_every_line_of_a_stop_word_file_counts(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("#tag\nthe\n  Running \n")
    got = {r.term for r in load_stopwords(spark, str(tmp_path / "stops.txt"), stem=False).collect()}
    assert got == {"#tag", "the", "Running"}


def test_missing_stop_word_file_warns_and_leaves_nothing_out(spark, tmp_path):
    with pytest.warns(UserWarning, match="no stop-word file"):
        assert load_stopwords(spark, str(tmp_path / "none.txt")).count() == 0


def test_refresh_with_repeated_urls(spark):
    old = spark.createDataFrame([(0, "u0", "t", "alpha beta", "1", 1), (1, "u1", "t", "gamma", "1", 1)], CORPUS)
    snapshot = spark.createDataFrame(
        [
            (None, "u0", "t", "older words", "2", 1),
            (None, "u0", "t", "newest words", "3", 1),
            (None, "new", "t", "delta", "1", 1),
            (None, "new", "t", "epsilon", "2", 1),
            (None, "u1", "t", "gamma", "1", 1),
        ],
        CORPUS,
    )
    fn = lambda c: analyze(c, None, stem=False)
    new = refresh_index(build_index(fn(old), old), snapshot, fn)
    assert {(r.page_id, r.url) for r in new.pages.collect()} == {(0, "u0"), (1, "u1"), (2, "new")}
    assert new.pages.count() == 3
    words = {(r.page_id, r.term) for r in new.wide.where("body_tf > 0").collect()}
    assert words == {(0, "newest"), (0, "words"), (1, "gamma"), (2, "epsilon")}


def test_latest_per_url_is_one_row_each(spark):
    rows = spark.createDataFrame([("u", None, 1), ("u", "2024", 2), ("u", "2023", 9), ("v", None, None)], "url string, last_modified string, size int")
    assert {tuple(r) for r in latest_per_url(rows).collect()} == {("u", "2024", 2), ("v", None, None)}


def test_streams_over_different_roots_keep_apart(spark):
    a, b = progress_dir(spark, "s", "/data/one/index"), progress_dir(spark, "s", "/data/two/index")
    assert a != b and a == progress_dir(spark, "s", "/data/one/index/")


def test_state_without_a_marker_does_not_count(spark, tmp_path):
    root = str(tmp_path / "state")
    assert latest_state(spark, root) is None
    spark.range(1).write.parquet(os.path.join(root, "version=0"))
    assert latest_state(spark, root) is None


def test_crawl_budget_ends_inside_a_level(spark):
    pages = spark.range(60).select(F.col("id").alias("page_id"))
    edges = derived_edges(pages)
    full = [r.page_id for r in crawl_tree(edges, pages, max_pages=None).orderBy("visit_order").collect()]
    some = [r.page_id for r in crawl_tree(edges, pages, max_pages=17).orderBy("visit_order").collect()]
    assert len(full) == 60 and some == full[:17]


def test_workers_get_the_package_from_any_folder(tmp_path):
    """No PYTHONPATH, another working directory: as on a cluster."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
        import sys
        sys.path.insert(0, {repo!r})
        import __spark_entry__ as e
        from quarry.session import local_session
        spark = local_session(2, shuffle_partitions=2)
        assert e.queries()["stem_vocabulary"](spark, "/root/testdata/sf0.001").count() > 0
        print("SHIPPED")
    """
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "SHIPPED" in run.stdout, run.stderr[-2000:]
