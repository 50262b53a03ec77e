"""Phrases are found by the runs of words that a page has, not by trying every phrase on every page with its words."""

import contextlib
import io

from quarry.operators import search as srch
from quarry.operators.analyze import page_postings
from quarry.operators.index import build_index
from quarry.session import cut_lineage

CORPUS = "page_id long, url string, title string, body string, last_modified string, size long"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_phrases_are_found_by_their_runs(spark):
    bodies = {0: "a b c d e f g", 1: "a b x b c d", 2: "b a b a b", 3: "c", 4: "g f e d c b a", 5: "a b c d e f g a b c d e f g h", 6: ""}
    phrases = ["a b", "b", "a b c", "b c d e", "a b c d e f g", "a b a b", "f g a b", "c d e f g h", "h a", "zz", "a zz b", "b a b a b a"]
    spaced = lambda s: f" {s} "
    rows = [(i, f"u{i}", "", b, "", 1) for i, b in bodies.items()]
    index = build_index(None, (corpus := spark.createDataFrame(rows, CORPUS)), cut_lineage(page_postings(corpus)))
    parsed = srch.parse_queries(spark.createDataFrame([(q, f'"{p}"') for q, p in enumerate(phrases)], "query_id long, query string"), stem=False)
    found = srch.match_phrases(parsed, index)
    want = sorted((q, i) for q, p in enumerate(phrases) for i, b in bodies.items() if spaced(p) in spaced(b))
    assert sorted(map(tuple, found.collect())) == want
    # the phrases that a page has, not all whose words it has
    assert "Window" in plan(found) and "map_contains_key" not in plan(found) and "map_from_entries" not in plan(found)


def test_parts_of_one_page_are_one_page_to_phrases(spark):
    """Rows of one page id share positions: a phrase may go from one to the other, as its positions do."""
    rows = [(1, "u", "", "crow wren finch", "", 1), (1, "v", "", "heron plover swift", "", 1), (None, "w", "", "crow wren", "", 1)]
    corpus = spark.createDataFrame(rows, CORPUS)
    index = build_index(None, corpus, cut_lineage(page_postings(corpus)))
    asked = [(1, '"crow plover"'), (2, '"heron wren swift"'), (3, '"crow wren"'), (4, '"crow heron"')]
    parsed = srch.parse_queries(spark.createDataFrame(asked, "query_id long, query string"))
    assert sorted(map(tuple, srch.match_phrases(parsed, index).collect())) == [(1, 1), (2, 1), (3, 1)]
