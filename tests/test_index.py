"""Index invariants, keyword padding, change detection, recent distinct."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF0001
from quarry.operators import lookup
from quarry.operators.analyze import analyze
from quarry.operators.index import assign_word_ids, build_index, max_tf, postings, wide_postings
from quarry.operators.links import changed_pages
from quarry.operators.results import recent_distinct
from quarry.sources.corpus import documents_as_corpus, read_table
from quarry.sources.stopwords import load_stopwords

CORPUS_SCHEMA = "page_id long, url string, title string, body string, last_modified string, size long"


def _index(spark, rows):
    corpus = spark.createDataFrame(rows, CORPUS_SCHEMA)
    return build_index(analyze(corpus, load_stopwords(spark)), corpus)


def test_positions_count_stop_words(spark):
    idx = _index(spark, [(1, "u1", "", "the cat and the dogs cat", "", 0)])
    rows = {r.term: r for r in postings(idx.wide, "body").collect()}
    assert rows["cat"].positions == [1, 5] and rows["cat"].tf == 2
    assert rows["dog"].positions == [4]
    assert "the" not in rows and "and" not in rows


def test_keyword_padding_and_empty_page(spark):
    idx = _index(
        spark,
        [
            (1, "u1", "", "alpha beta alpha", "", 0),
            (2, "u2", "gamma", "gamma", "", 0),
            (3, "u3", "", "", "", 0),
        ],
    )
    kw = {r.page_id for r in lookup.top_keywords(idx).collect()}
    text = {
        r.page_id: r.k
        for r in lookup.top_keywords(idx).select("page_id", lookup.format_keywords(F.col("keywords")).alias("k")).collect()
    }
    assert set(kw) == {1, 2, 3}
    assert text[1] == "alpha(2); beta(1); gamma(0)"
    assert text[2] == "gamma(2); alpha(0); beta(0)"  # title counts too; padded in first-seen order
    assert text[3] == "alpha(0); beta(0); gamma(0)"
    mt = {(r.field, r.page_id): r.maxtf for r in max_tf(idx.wide, idx.pages).collect()}
    assert mt[("body", 3)] == 0 and mt[("title", 3)] == 0 and mt[("body", 1)] == 2
    ids = [r.term for r in assign_word_ids(idx.wide, idx.pages).orderBy("word_id").collect()]
    assert ids == ["alpha", "beta", "gamma"]


def test_index_properties_sf0001(spark):
    corpus = documents_as_corpus(read_table(spark, SF0001, "documents"))
    tokens = analyze(corpus, load_stopwords(spark))
    idx = build_index(tokens, corpus)
    p = postings(idx.wide)
    assert p.agg(F.sum("tf")).first()[0] == tokens.count()
    assert p.where(F.size("positions") != F.col("tf")).count() == 0
    # strictly increasing positions
    assert p.where(F.array_sort(F.array_distinct("positions")) != F.col("positions")).count() == 0
    n = corpus.count()
    assert idx.term_df.where((F.col("body_df") > n) | (F.col("title_df") > n)).count() == 0
    w = idx.weights.groupBy("page_id").agg(F.sum(F.col("nweight") ** 2).alias("s"))
    assert w.where(F.abs(F.col("s") - 1.0) > 1e-9).where(F.col("s") > 0).count() == 0


def test_change_detection(spark):
    stored = spark.createDataFrame([("u1", "Mon"), ("u2", ""), ("u3", "Tue")], "url string, last_modified string")
    snap = spark.createDataFrame(
        [("u1", "Mon"), ("u2", None), ("u3", "Wed"), ("u4", "x")], "url string, last_modified string"
    )
    assert sorted(r.url for r in changed_pages(snap, stored).collect()) == ["u3", "u4"]


def test_recent_distinct(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    ev = spark.createDataFrame(
        [(1, t(1), "a"), (1, t(2), "b"), (1, t(3), "a"), (1, t(4), "c"), (1, t(5), "d"), (1, t(6), "e"), (1, t(7), "f"), (2, t(1), "z")],
        "user_id long, ts timestamp, props string",
    )
    got = [(r.user_id, r.rank, r.props) for r in recent_distinct(ev).orderBy("user_id", "rank").collect()]
    assert got == [(1, 1, "f"), (1, 2, "e"), (1, 3, "d"), (1, 4, "c"), (1, 5, "a"), (2, 1, "z")]


def test_lookups_unknown(spark):
    idx = _index(spark, [(1, "u1", "cat", "cat dog", "", 0)])
    req = spark.createDataFrame([("u1", "cat"), ("u1", "zzz"), ("nope", "cat")], "url string, term string")
    tf = {(r.url, r.term): (r.body_tf, r.title_tf) for r in lookup.term_frequency(req, idx).collect()}
    assert tf == {("u1", "cat"): (1, 1), ("u1", "zzz"): (0, 0), ("nope", "cat"): (0, 0)}
    pos = {(r.url, r.term): r.body_positions for r in lookup.term_positions(req, idx).collect()}
    assert pos[("u1", "cat")] == [0] and pos[("nope", "cat")] == []


def test_dedupe_first_writer_wins(spark):
    from quarry.operators.index import dedupe_pages

    rows = [(5, "a", 1), (2, "a", 9), (7, "b", 3), (3, "a", 4)] + [(100 + i, "a", 0) for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, size long").repartition(4)
    got = sorted(tuple(r) for r in dedupe_pages(df).collect())
    assert got == [(2, "a", 9), (7, "b", 3)]


def test_first_seen_packed_equals_struct_path(spark):
    from quarry.operators.index import first_seen

    corpus = documents_as_corpus(read_table(spark, SF0001, "documents"))
    idx = build_index(analyze(corpus, load_stopwords(spark)), corpus)
    cols = ("term", "page_order", "field_order", "pos")
    packed = sorted(tuple(r[c] for c in cols) for r in first_seen(idx.wide, idx.pages).collect())
    plain = sorted(tuple(r[c] for c in cols) for r in first_seen(idx.wide).collect())  # no page table: struct path
    assert packed == plain


def test_page_postings_equal_the_token_aggregate(spark):
    from quarry.operators.analyze import analyze, page_postings
    from quarry.operators.index import wide_postings

    rows = [
        (0, "Running the runs", "The title of runs"),
        (1, None, None),
        (2, "", "only a title"),
        (3, "alpha beta alpha alpha's", ""),
        (4, "the of and", None),
    ]
    corpus = spark.createDataFrame(rows, "page_id long, body string, title string").repartition(3)
    stops = spark.createDataFrame([("the",), ("of",), ("and",)], "term string")
    plain = lambda df: {r.term + str(r.page_id): (r.body_tf, r.title_tf, r.body_positions, r.title_positions) for r in df.collect()}
    for stem in (True, False):
        got = page_postings(corpus, stops, stem)
        assert got.count() == len(plain(got))
        assert plain(got) == plain(wide_postings(analyze(corpus, stops, stem)))
    assert page_postings(corpus.limit(0), None).count() == 0


def test_rows_of_one_page_id_are_parts_of_one_page(spark):
    """Postings of repeated page ids are merged on both paths, however the rows are sliced."""
    from quarry.operators import analyze as a

    rows = [(1, "apple pear apple", "pear"), (2, "plum", "plum"), (1, "pear fig", "apple"), (3, None, ""), (3, "fig " * 50, None)]
    corpus = spark.createDataFrame(rows, "page_id long, body string, title string").repartition(2)
    key = lambda r: (r.page_id, r.term)
    got = sorted(a.page_postings(corpus, None).collect(), key=key)
    want = sorted(wide_postings(analyze(corpus, None)).collect(), key=key)
    cols = ("page_id", "term", "body_tf", "title_tf")
    assert [[r[c] for c in cols] for r in got] == [[r[c] for c in cols] for r in want]
    assert all(sorted(g[c]) == sorted(w[c]) for g, w in zip(got, want, strict=True) for c in ("body_positions", "title_positions"))
    assert len({key(r) for r in got}) == len(got)


def test_token_slices():
    import pyarrow as pa

    from quarry.operators.analyze import group_terms, token_slices

    lists = lambda sizes: pa.array([None if n is None else [f"w{i % 7}" for i in range(n)] for n in sizes], pa.list_(pa.string()))
    batch = pa.record_batch([pa.array(range(6)), lists([3, None, 40, 0, 5, 9]), lists([1, 2, None, 0, 0, 3])], names=["page_id", "body", "title"])
    parts = list(token_slices(batch, 10))
    assert [p.num_rows for p in parts] == [2, 1, 2, 1] and sum(p.num_rows for p in parts) == 6
    whole = sorted(map(str, group_terms(batch, False).to_pylist()))
    assert sorted(str(r) for p in parts for r in group_terms(p, False).to_pylist()) == whole
    assert list(token_slices(batch.slice(0, 0), 10)) == []


def test_documents_without_source_have_urls(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "x", "s"), (3, "y", None)], "doc_id long, text string, source string")
    got = {r.page_id: (r.url, r.body, r["size"]) for r in documents_as_corpus(docs).collect()}
    assert got == {1: ("doc:///1", "", 0), 2: ("doc://s/2", "x", 1), 3: ("doc:///3", "y", 1)}
