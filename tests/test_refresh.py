"""Index refresh: merge_index semantics and the Structured Streaming runner."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF0001
from quarry.operators.analyze import analyze
from quarry.operators.index import build_index, postings, refresh_index
from quarry.sources.corpus import pages_as_corpus, read_table
from quarry.sources.stopwords import load_stopwords
from quarry.sources.segments import latest_state as latest_segments, read_segments, write_segments
from quarry.streaming.refresh import refresh_batch, start_refresh_stream


def _by_url(index):
    p = postings(index.wide).join(index.pages.select("page_id", "url"), "page_id")
    return sorted((r.url, r.field, r.term, r.tf, tuple(r.positions)) for r in p.collect())


def test_refresh_equals_rebuild_and_is_idempotent(spark):
    stops = load_stopwords(spark)
    raw = read_table(spark, SF0001, "pages")
    full = pages_as_corpus(raw)
    base_corpus = full.where(F.col("page_id") < 20)
    base = build_index(analyze(base_corpus, stops), base_corpus)
    once = refresh_index(base, full, lambda c: analyze(c, stops))
    rebuilt = build_index(analyze(full, stops), full)
    assert _by_url(once) == _by_url(rebuilt)
    # known URLs keep their ids; new ones follow the largest id
    ids = {r.url: r.page_id for r in once.pages.collect()}
    old = {r.url: r.page_id for r in base.pages.collect()}
    assert all(ids[u] == i for u, i in old.items()) and min(i for u, i in ids.items() if u not in old) == 20
    twice = refresh_index(once, full, lambda c: analyze(c, stops))
    assert _by_url(twice) == _by_url(once)
    w1 = sorted((r.page_id, r.term, round(r.weight, 9)) for r in once.weights.collect())
    w2 = sorted((r.page_id, r.term, round(r.weight, 9)) for r in twice.weights.collect())
    assert w1 == w2


def test_streaming_refresh(spark):
    stops = load_stopwords(spark)
    raw = read_table(spark, SF0001, "pages")
    root = tempfile.mkdtemp(prefix="quarry-refresh-")
    src = os.path.join(root, "incoming")
    base_corpus = pages_as_corpus(raw.where(F.col("page_id") < 30))
    write_segments(build_index(analyze(base_corpus, stops), base_corpus), os.path.join(root, "index"), block_rows=500)
    raw.where(F.col("page_id") >= 10).select(
        "page_id", "url", "html", F.lit("").alias("last_modified")
    ).write.parquet(src)
    q = start_refresh_stream(spark, src, os.path.join(root, "index"))
    q.awaitTermination(300)
    assert q.exception() is None
    newest = latest_segments(spark, os.path.join(root, "index"))
    assert newest == 1
    idx = read_segments(spark, os.path.join(root, "index"), newest)
    assert idx.pages.count() == 50
    full = pages_as_corpus(raw)
    assert _by_url(idx) == _by_url(build_index(analyze(full, stops), full))


def test_streaming_recent_distinct_equals_batch(spark):
    from quarry.operators.results import recent_distinct
    from quarry.streaming.recent import latest_state, start_recent_stream

    from conftest import SF001

    events = read_table(spark, SF001, "events")
    root = tempfile.mkdtemp(prefix="quarry-recent-")
    src = os.path.join(root, "incoming")
    # two arrivals: later files hold later and earlier events mixed
    events.where(F.col("event_id") % 2 == 0).write.parquet(src)
    q = start_recent_stream(spark, src, os.path.join(root, "state"))
    q.awaitTermination(300)
    assert q.exception() is None
    events.where(F.col("event_id") % 2 == 1).write.mode("append").parquet(src)
    q = start_recent_stream(spark, src, os.path.join(root, "state"))
    q.awaitTermination(300)
    assert q.exception() is None
    state = spark.read.parquet(latest_state(spark, os.path.join(root, "state")))
    want = recent_distinct(events)
    cols = ("user_id", "rank", "props", "last_ts")
    assert sorted(tuple(r[c] for c in cols) for r in state.collect()) == sorted(
        tuple(r[c] for c in cols) for r in want.collect()
    )


def test_retried_batch_starts_from_the_same_base(spark):
    from quarry.streaming.recent import fold_batch, latest_state

    from conftest import SF0001

    events = read_table(spark, SF0001, "events")
    root = os.path.join(tempfile.mkdtemp(prefix="quarry-retry-"), "state")
    first, second = events.where(F.col("event_id") < 500), events.where(F.col("event_id") >= 500)
    fold_batch(spark, first, root, 0, "user_id", "props", "ts", 5)
    fold_batch(spark, second, root, 1, "user_id", "props", "ts", 5)
    once = sorted(tuple(r) for r in spark.read.parquet(latest_state(spark, root)).collect())
    fold_batch(spark, second, root, 1, "user_id", "props", "ts", 5)  # the same epoch again
    again = sorted(tuple(r) for r in spark.read.parquet(latest_state(spark, root)).collect())
    assert once == again


def test_unchanged_snapshot_writes_no_version(spark):
    stops = load_stopwords(spark)
    raw = read_table(spark, SF0001, "pages")
    root = os.path.join(tempfile.mkdtemp(prefix="quarry-nochange-"), "index")
    corpus = pages_as_corpus(raw)
    write_segments(build_index(analyze(corpus, stops), corpus), root, block_rows=500)
    same = raw.select("page_id", "url", "html", F.lit("").alias("last_modified"))
    refresh_batch(spark, same, root, 0)
    assert latest_segments(spark, root) == 0
    # a batch tried again starts from the same base and overwrites its own state
    dated = raw.where("page_id < 5").select("page_id", "url", "html", F.lit("2024-05-05").alias("last_modified"))
    for _ in range(2):
        refresh_batch(spark, dated, root, 1)
        assert latest_segments(spark, root) == 1
    refresh_batch(spark, dated.withColumn("last_modified", F.lit("2024-06-06")), root, 2)
    assert latest_segments(spark, root) == 2
    assert _by_url(read_segments(spark, root, 2)) == _by_url(build_index(analyze(corpus, stops), corpus))
