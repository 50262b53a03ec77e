"""Named queries over the driver tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or data Spark derives from them) in
full. Output columns are plain scalars (arrays are rendered as text) so the
results can be compared value by value with the DuckDB oracle
(``quarry.plans.oracle``), which uses the same names.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.html import extract_body, extract_hrefs, extract_title
from quarry.functions.stem import stem_array_column
from quarry.functions.text import lower_tokens, positions_csv, tokenize
from quarry.operators import lookup, search as srch
from quarry.operators.analyze import analyze, field_terms, page_postings, tokenize_frame
from quarry.operators.index import (
    Index,
    assign_word_ids,
    build_index,
    dedupe_pages,
    doc_count,
    document_frequency,
    max_tf,
    postings,
    refresh_index,
    term_totals,
)
from quarry.operators.links import (
    changed_pages,
    child_links,
    crawl_tree,
    derived_edges,
    extract_links,
    parent_links,
)
from quarry.operators.report import format_results, page_blocks
from quarry.operators.results import enrich_results, paginate, recent_distinct
from quarry.operators.similar import similar_pages
from quarry.operators.util import bounded_broadcast, rebalance_small_input
from quarry.sources.corpus import documents_as_corpus, pages_as_corpus, read_pages, read_table
from quarry.session import checkpoint_dir, cut_lineage
from quarry.sources.segments import SegmentedIndex, read_segments, refresh_segments, write_segments
from quarry.sources.stopwords import load_stopwords
from quarry.sources.store import read_index, write_index

SCORE_DECIMALS = 6
CRAWL_BUDGET = 75


@dataclass
class DocumentsIndex:
    corpus: DataFrame
    stops: DataFrame
    tokens: DataFrame
    index: Index


def documents_index(spark: SparkSession, sf_dir: str, keep: bool = False) -> DocumentsIndex:
    """``keep`` for a query that reads the postings several times: they are
    written once, so that the text is not analysed anew for each."""
    corpus = rebalance_small_input(documents_as_corpus(read_table(spark, sf_dir, "documents")), "page_id")
    stops = load_stopwords(spark)
    tokens = analyze(corpus, stops)
    wide = page_postings(corpus, stops)
    return DocumentsIndex(corpus, stops, tokens, build_index(None, corpus, cut_lineage(wide) if keep else wide))


@dataclass
class CrawlIndex:
    snapshot: DataFrame  # page_id, url, html, last_modified, size
    tree: DataFrame  # page_id, depth, parent_id, visit_order
    corpus: DataFrame  # crawled pages only, with page_order = visit order
    index: Index


def crawl_index(spark: SparkSession, sf_dir: str) -> CrawlIndex:
    """Crawl the whole page table over the derived link graph from page 0, then
    index exactly the crawled pages in visit order (the postings are written
    once: every table of the index is made from them)."""
    raw = read_table(spark, sf_dir, "pages")
    snapshot = read_pages(raw)
    tree = crawl_tree(derived_edges(snapshot), snapshot, max_pages=None)
    corpus = rebalance_small_input(pages_as_corpus(raw), "page_id").join(
        tree.select("page_id", F.col("visit_order").alias("page_order")), "page_id"
    )
    return CrawlIndex(snapshot, tree, corpus, build_index(None, corpus, cut_lineage(page_postings(corpus, load_stopwords(spark)))))


def _phrases(toks: F.Column, n: int) -> F.Column:
    """Every run of ``n`` tokens, quoted."""
    starts = F.when(F.size(toks) >= n, F.sequence(F.lit(1), F.size(toks) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat(F.lit('"'), F.array_join(F.slice(toks, i, n), " "), F.lit('"')))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, query)`` from the benchmark passages, three per passage:
    the passage as free text (id*10), a phrase of each two adjacent tokens
    plus its last token (id*10+1), and a phrase of each three (id*10+2)."""
    b = read_table(spark, sf_dir, "benchmark")
    toks = tokenize(F.col("text"))
    free = b.select((F.col("item_id") * 10).alias("query_id"), F.coalesce("text", F.lit("")).alias("query"))
    pt = b.select(
        (F.col("item_id") * 10 + 1).alias("query_id"),
        F.concat_ws(" ", _phrases(toks, 2), F.slice(toks, -1, 1)).alias("query"),
    )
    po = b.select(
        (F.col("item_id") * 10 + 2).alias("query_id"),
        F.array_join(_phrases(toks, 3), " ").alias("query"),
    )
    return free.unionByName(pt).unionByName(po).select(F.col("query_id").cast("long"), "query")


def _round(c: str) -> F.Column:
    """Half-up to SCORE_DECIMALS with plain double arithmetic, so any engine
    doing the same operations prints the same value (decimal rounding of a
    double differs between engines on near-ties)."""
    scale = float(10**SCORE_DECIMALS)
    return (F.floor(F.col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).alias(c)


def _title_requests(corpus: DataFrame) -> DataFrame:
    """(url, term) look-up requests: each page's URL with the stems of its
    title words (stop words included, so zero answers occur)."""
    t = corpus.select("url", lower_tokens(tokenize(F.col("title"))).alias("terms"))
    return stem_array_column(t, "terms").select("url", F.explode("terms").alias("term")).distinct()


def _benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read_table(spark, sf_dir, "benchmark").select(lower_tokens(tokenize(F.col("text"))).alias("terms"))
    return stem_array_column(b, "terms").select(F.explode("terms").alias("term")).distinct()


def _links_text(df: DataFrame, col: str, sep: str) -> F.Column:
    return F.when(F.size(col) > 0, F.array_join(col, sep)).otherwise(F.lit("None"))


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------


def q_tokenize_documents(spark, sf_dir):
    d = documents_index(spark, sf_dir)
    return tokenize_frame(d.corpus, stem=True, stopwords=d.stops).select(
        "page_id", "field", F.col("n_tokens").cast("long"), F.col("n_kept").cast("long")
    )


def q_stem_vocabulary(spark, sf_dir):
    corpus = documents_as_corpus(read_table(spark, sf_dir, "documents"))
    words = field_terms(corpus, stem=False).select(F.explode("terms").alias("word")).distinct()
    stems = stem_array_column(words.select("word", F.array("word").alias("s")), "s")
    return stems.select("word", F.col("s")[0].alias("stem"))


def q_stopword_filter(spark, sf_dir):
    d = documents_index(spark, sf_dir)
    all_terms = field_terms(d.corpus, stem=True).select(F.explode("terms").alias("term"))
    dropped = all_terms.join(d.stops, "term", "left_semi")
    return dropped.groupBy("term").agg(F.count(F.lit(1)).alias("n_dropped"))


def _postings(field):
    def q(spark, sf_dir):
        d = documents_index(spark, sf_dir)
        p = postings(d.index.wide, field)
        return p.select("field", "term", "page_id", "tf", positions_csv(F.col("positions")).alias("positions"))

    return q


def _df(field):
    def q(spark, sf_dir):
        return document_frequency(documents_index(spark, sf_dir).index.wide, field)

    return q


def _maxtf(field):
    def q(spark, sf_dir):
        d = documents_index(spark, sf_dir)
        return max_tf(d.index.wide, d.index.pages, field)

    return q


def q_doc_count(spark, sf_dir):
    return doc_count(documents_index(spark, sf_dir).index.pages)


def q_vocabulary(spark, sf_dir):
    return lookup.vocabulary(documents_index(spark, sf_dir).index)


def q_word_ids(spark, sf_dir):
    d = documents_index(spark, sf_dir, keep=True)
    return assign_word_ids(d.index.wide, d.index.pages)


def q_term_totals(spark, sf_dir):
    return term_totals(documents_index(spark, sf_dir).index.wide)


def q_term_frequency(spark, sf_dir):
    d = documents_index(spark, sf_dir)
    return lookup.term_frequency(_title_requests(d.corpus), d.index)


def q_term_positions(spark, sf_dir):
    d = documents_index(spark, sf_dir)
    r = lookup.term_positions(_title_requests(d.corpus), d.index)
    return r.select(
        "url",
        "term",
        positions_csv(F.col("body_positions")).alias("body_positions"),
        positions_csv(F.col("title_positions")).alias("title_positions"),
    )


def q_page_terms(spark, sf_dir):
    return lookup.page_terms(documents_index(spark, sf_dir).index)


def q_pages_with_term(spark, sf_dir):
    d = documents_index(spark, sf_dir)
    return lookup.pages_with_term(_benchmark_terms(spark, sf_dir), d.index)


def q_top_keywords(spark, sf_dir):
    d = documents_index(spark, sf_dir, keep=True)
    kw = lookup.top_keywords(d.index)
    return kw.select("page_id", lookup.format_keywords(F.col("keywords")).alias("keywords"))


def q_parse_queries(spark, sf_dir):
    parsed = srch.parse_queries(benchmark_queries(spark, sf_dir))
    return parsed.select("query_id", F.col("phrase_idx").cast("long"), F.array_join("terms", " ").alias("terms"))


def _parsed_and_index(spark, sf_dir):
    return srch.parse_queries(benchmark_queries(spark, sf_dir)), documents_index(spark, sf_dir, keep=True).index


def q_match_terms(spark, sf_dir):
    return srch.match_terms(*_parsed_and_index(spark, sf_dir))


def q_match_phrases(spark, sf_dir):
    return srch.match_phrases(*_parsed_and_index(spark, sf_dir))


def q_candidates(spark, sf_dir):
    return srch.candidates(*_parsed_and_index(spark, sf_dir))


def q_query_weights(spark, sf_dir):
    qw = srch.query_weights(*_parsed_and_index(spark, sf_dir))
    return qw.select("query_id", "key", "df", _round("weight"))


def q_document_weights(spark, sf_dir):
    w = documents_index(spark, sf_dir, keep=True).index.weights
    return w.select("page_id", "term", _round("weight"), _round("nweight"))


def _search(index: Index, queries: DataFrame) -> DataFrame:
    hits = srch.search(queries, index)
    return hits.join(index.pages.select("page_id", "url"), "page_id").select(
        "query_id", "rank", "page_id", "url", _round("score")
    )


def q_search_topk(spark, sf_dir):
    return _search(documents_index(spark, sf_dir, keep=True).index, benchmark_queries(spark, sf_dir))


def q_explain_scores(spark, sf_dir):
    hits = srch.explain_scores(benchmark_queries(spark, sf_dir), documents_index(spark, sf_dir, keep=True).index)
    return hits.select("query_id", "rank", "page_id", _round("dot"), _round("doc_norm"), _round("query_norm"), _round("score"))


def q_similar_pages(spark, sf_dir):
    hits = similar_pages(documents_index(spark, sf_dir, keep=True).index)
    return hits.select("query_id", "rank", "page_id", _round("score"))


def q_similar_to_pages(spark, sf_dir):
    """Similar pages for requested pages: the best hit of every benchmark query."""
    index = documents_index(spark, sf_dir, keep=True).index
    best = srch.search(benchmark_queries(spark, sf_dir), index).where("rank = 1")
    urls = best.join(index.pages.select("page_id", "url"), "page_id").select("url")
    hits = similar_pages(index, urls=cut_lineage(urls.distinct()))
    return hits.select("query_id", "rank", "page_id", _round("score"))


def _stored(spark, sf_dir) -> tuple[DocumentsIndex, Index]:
    """The documents index, written to the shared folder and read back."""
    d = documents_index(spark, sf_dir)
    path = os.path.join(checkpoint_dir(spark), f"index-{uuid.uuid4().hex}")
    write_index(d.index, path)
    return d, read_index(spark, path)


def q_search_stored(spark, sf_dir):
    return _search(_stored(spark, sf_dir)[1], benchmark_queries(spark, sf_dir))


def q_lookup_stored(spark, sf_dir):
    """tf, positions and max tf of (url, term) requests from the stored index. The answers of each look-up are written, as
    in ``q_lookup_segments``."""
    d, index = _stored(spark, sf_dir)
    asked = cut_lineage(_title_requests(d.corpus))
    tf = cut_lineage(lookup.term_frequency(asked, index))
    pos = lookup.term_positions(asked, index)
    pos = cut_lineage(pos.select("url", "term", positions_csv(F.col("body_positions")).alias("body_positions")))
    mx = lookup.page_max_tf(asked.select("url").distinct(), index)
    out = tf.join(pos, ["url", "term"]).join(mx, "url")
    return out.select("url", "term", "body_tf", "title_tf", "body_positions", "body_maxtf")


def q_search_guards(spark, sf_dir):
    """Queries that match nothing: no words, a quoted run of none, an unknown
    word, an unclosed quote of nothing. How many results each has."""
    b = read_table(spark, sf_dir, "benchmark")
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\p{L}\p{N}_']+", "")
    unknown = F.concat(F.lit("qzx"), F.col("item_id").cast("string"), F.lit("qzx"))
    forms = [bare, F.concat(F.lit('"'), bare, F.lit('"')), unknown, F.concat(F.lit('"'), unknown, F.lit(' the"')), F.lit('"')]
    rows = F.posexplode(F.array(*forms)).alias("form", "query")
    asked = b.select("item_id", rows).select((F.col("item_id") * 10 + F.col("form")).cast("long").alias("query_id"), "query")
    hits = srch.search(asked, documents_index(spark, sf_dir, keep=True).index).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return asked.join(hits, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_results"))


def q_enriched_results(spark, sf_dir):
    c = crawl_index(spark, sf_dir)
    hits = srch.search(benchmark_queries(spark, sf_dir), c.index)
    kw = lookup.top_keywords(c.index).select("page_id", lookup.format_keywords(F.col("keywords")).alias("keywords"))
    par = parent_links(c.tree, c.snapshot)
    kids = child_links(c.tree, c.snapshot)
    e = enrich_results(hits, c.index.pages, kw, par, kids)
    return e.select(
        "query_id",
        "rank",
        "page_id",
        "url",
        "title",
        _round("score"),
        "last_modified",
        "size",
        "keywords",
        _links_text(e, "parent_links", ", ").alias("parent_links"),
        _links_text(e, "child_links", ",\n").alias("child_links"),
    )


def q_paginate(spark, sf_dir):
    hits = srch.search(benchmark_queries(spark, sf_dir), documents_index(spark, sf_dir, keep=True).index)
    return paginate(hits).select("query_id", "rank", "page_id", "page", "total_pages")


def q_extract_title(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), extract_title(F.col("html")).alias("title"))


def q_extract_body(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), extract_body(F.col("html")).alias("body"))


def q_extract_links(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select(F.col("page_id").cast("long"), F.posexplode(extract_hrefs(F.col("html"))).alias("link_pos", "href")).select(
        "page_id", F.col("link_pos").cast("long"), "href"
    )


def q_resolve_url(spark, sf_dir):
    links = extract_links(read_pages(read_table(spark, sf_dir, "pages")))
    return links.select("page_id", F.col("link_pos").cast("long"), "url")


def _crawl(spark, sf_dir, max_pages):
    snap = read_pages(read_table(spark, sf_dir, "pages"))
    tree = crawl_tree(derived_edges(snap), snap, max_pages=max_pages)
    return tree.join(snap.select("page_id", "url"), "page_id").select(
        "page_id", "url", F.col("depth").cast("long"), "visit_order", F.coalesce("parent_id", F.lit(-1)).alias("parent_id")
    )


def q_crawl_tree(spark, sf_dir):
    return _crawl(spark, sf_dir, None)


def q_crawl_budget(spark, sf_dir):
    """The crawl's page budget, which ends it inside a level."""
    return _crawl(spark, sf_dir, CRAWL_BUDGET)


def q_parent_links(spark, sf_dir):
    snap = read_pages(read_table(spark, sf_dir, "pages"))
    tree = crawl_tree(derived_edges(snap), snap, max_pages=None)
    par = parent_links(tree, snap).join(snap.select("page_id", "url"), "page_id")
    return par.select("page_id", "url", _links_text(par, "parents", ", ").alias("parent_links"))


def q_child_links(spark, sf_dir):
    snap = read_pages(read_table(spark, sf_dir, "pages"))
    tree = crawl_tree(derived_edges(snap), snap, max_pages=None)
    kids = child_links(tree, snap).join(snap.select("page_id", "url"), "page_id")
    return kids.select("page_id", "url", _links_text(kids, "children", ",\n").alias("child_links"))


def q_changed_pages(spark, sf_dir):
    """Stored = the page table, dated by page id; new snapshot = the same pages,
    every third of another date, plus the documents as pages: pages whose date
    differs and all document URLs are changed."""
    pages = dedupe_pages(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    day = lambda n: F.concat(F.lit("2024-01-"), F.lpad((F.pmod(n, F.lit(28)) + 1).cast("string"), 2, "0"))
    stored = pages.select("url", day(F.col("page_id")).alias("last_modified"))
    moved = F.when(F.pmod("page_id", F.lit(3)) == 0, F.col("page_id") + 1).otherwise(F.col("page_id"))
    fresh = pages.select("url", day(moved).alias("last_modified"))
    docs = documents_as_corpus(read_table(spark, sf_dir, "documents")).select("url", "last_modified")
    return changed_pages(fresh.unionByName(docs), stored).select("url")


def q_merge_index(spark, sf_dir):
    """The documents index refreshed with a snapshot of two crawls: the page
    table (new URLs, which get the next free ids in URL order) and all documents
    again, every second of them re-dated and then with its title for a text, in
    an older and a newer version. Replaced pages lose their old postings."""
    d = documents_index(spark, sf_dir)
    merged = refresh_index(d.index, _second_crawl(spark, sf_dir, d), lambda c: page_postings(c, d.stops))
    return _all_postings(merged.wide)


def _all_postings(wide: DataFrame) -> DataFrame:
    p = postings(wide)
    return p.select("field", "term", "page_id", "tf", positions_csv(F.col("positions")).alias("positions"))


def _second_crawl(spark, sf_dir, d: DocumentsIndex) -> DataFrame:
    again = d.corpus.withColumn("last_modified", F.when(F.pmod("page_id", F.lit(2)) == 0, "2024-02-02").otherwise(F.col("last_modified")))
    newer = again.withColumn("body", F.when(F.col("last_modified") != "", F.col("title")).otherwise(F.col("body")))
    older = again.withColumn("last_modified", F.when(F.col("last_modified") != "", "2024-01-01").otherwise(F.lit("")))
    return pages_as_corpus(read_table(spark, sf_dir, "pages")).unionByName(newer).unionByName(older)


def _refreshed(spark, sf_dir) -> SegmentedIndex:
    """The refresh of ``merge_index`` as a second segment beside the documents' one, read back."""
    d = documents_index(spark, sf_dir)
    path = os.path.join(checkpoint_dir(spark), f"segments-{uuid.uuid4().hex}")
    write_segments(d.index, path)
    return read_segments(spark, path, refresh_segments(spark, path, _second_crawl(spark, sf_dir, d), d.stops))


def q_merge_segments(spark, sf_dir):
    return _all_postings(_refreshed(spark, sf_dir).wide)


def q_search_segments(spark, sf_dir):
    """Search over a refreshed index of two segments."""
    return _search(_refreshed(spark, sf_dir), benchmark_queries(spark, sf_dir))


def q_lookup_segments(spark, sf_dir):
    """tf, positions, max tf and df of every (url, term) of a refreshed index, by look-up. The answers of each look-up are
    written, so that the shuffles of one are gone before the next begins."""
    index = _refreshed(spark, sf_dir)
    urls = bounded_broadcast(index.pages.select("page_id", "url"))
    asked = cut_lineage(index.wide.select("page_id", "term").join(urls, "page_id").select("url", "term"))
    tf = cut_lineage(lookup.term_frequency(asked, index))
    pos = lookup.term_positions(asked, index)
    pos = cut_lineage(pos.select("url", "term", positions_csv(F.col("body_positions")).alias("body_positions")))
    mx = bounded_broadcast(cut_lineage(lookup.page_max_tf(asked.select("url").distinct(), index).select("url", "body_maxtf")))
    df = cut_lineage(lookup.term_df_lookup(asked, index).select("term", (F.col("body_df") + F.col("title_df")).alias("df")))
    out = tf.join(pos, ["url", "term"]).join(mx, "url").join(df, "term")
    return out.select("term", "url", "body_tf", "title_tf", "body_positions", "body_maxtf", "df")


def q_word_ids_refreshed(spark, sf_dir):
    """Word ids after the refresh: those of the first index, and new ones for new words."""
    return _refreshed(spark, sf_dir).stored_vocab.select("word_id", "term")


def q_dedupe_pages(spark, sf_dir):
    """Page table plus documents-as-pages, all of them twice (the second time
    under later ids and with another size), one row per URL (first writer =
    lowest page id wins)."""
    pages = read_pages(read_table(spark, sf_dir, "pages")).select("page_id", "url", "size")
    docs = documents_as_corpus(read_table(spark, sf_dir, "documents")).select("page_id", "url", "size")
    once = pages.unionByName(docs)
    later = once.select((F.col("page_id") + 1_000_000_000).alias("page_id"), "url", (F.col("size") + 1).alias("size"))
    return dedupe_pages(later.unionByName(once)).select("page_id", "url", "size")


def q_term_df_lookup(spark, sf_dir):
    return lookup.term_df_lookup(_benchmark_terms(spark, sf_dir), documents_index(spark, sf_dir).index)


def q_page_max_tf(spark, sf_dir):
    d = documents_index(spark, sf_dir)
    urls = d.corpus.select("url").unionByName(read_table(spark, sf_dir, "pages").select("url"))
    return lookup.page_max_tf(urls, d.index)


def q_page_report(spark, sf_dir):
    c = crawl_index(spark, sf_dir)
    kw = lookup.top_keywords(c.index)
    blocks = page_blocks(c.tree, c.index.pages, kw, parent_links(c.tree, c.snapshot), child_links(c.tree, c.snapshot))
    return blocks.select("visit_order", "block")


def q_format_results(spark, sf_dir):
    index = documents_index(spark, sf_dir, keep=True).index
    queries = benchmark_queries(spark, sf_dir)
    hits = srch.search(queries, index)
    meta = hits.join(index.pages.select("page_id", "url", "title"), "page_id")
    return format_results(meta, queries)


def q_recent_distinct(spark, sf_dir):
    r = recent_distinct(read_table(spark, sf_dir, "events"))
    return r.select(
        "user_id", F.col("rank").cast("long"), "props", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_ts")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tokenize_documents": q_tokenize_documents,
    "stem_vocabulary": q_stem_vocabulary,
    "stopword_filter": q_stopword_filter,
    "postings_body": _postings("body"),
    "postings_title": _postings("title"),
    "df_body": _df("body"),
    "df_title": _df("title"),
    "max_tf_body": _maxtf("body"),
    "max_tf_title": _maxtf("title"),
    "doc_count": q_doc_count,
    "vocabulary": q_vocabulary,
    "word_ids": q_word_ids,
    "term_totals": q_term_totals,
    "term_frequency": q_term_frequency,
    "term_positions": q_term_positions,
    "page_terms": q_page_terms,
    "pages_with_term": q_pages_with_term,
    "top_keywords": q_top_keywords,
    "parse_queries": q_parse_queries,
    "match_terms": q_match_terms,
    "match_phrases": q_match_phrases,
    "candidates": q_candidates,
    "query_weights": q_query_weights,
    "document_weights": q_document_weights,
    "search_topk": q_search_topk,
    "explain_scores": q_explain_scores,
    "similar_pages": q_similar_pages,
    "similar_to_pages": q_similar_to_pages,
    "search_stored": q_search_stored,
    "lookup_stored": q_lookup_stored,
    "search_guards": q_search_guards,
    "enriched_results": q_enriched_results,
    "paginate": q_paginate,
    "extract_title": q_extract_title,
    "extract_body": q_extract_body,
    "extract_links": q_extract_links,
    "resolve_url": q_resolve_url,
    "crawl_tree": q_crawl_tree,
    "crawl_budget": q_crawl_budget,
    "parent_links": q_parent_links,
    "child_links": q_child_links,
    "changed_pages": q_changed_pages,
    "merge_index": q_merge_index,
    "merge_segments": q_merge_segments,
    "search_segments": q_search_segments,
    "lookup_segments": q_lookup_segments,
    "word_ids_refreshed": q_word_ids_refreshed,
    "dedupe_pages": q_dedupe_pages,
    "term_df_lookup": q_term_df_lookup,
    "page_max_tf": q_page_max_tf,
    "page_report": q_page_report,
    "format_results": q_format_results,
    "recent_distinct": q_recent_distinct,
}
