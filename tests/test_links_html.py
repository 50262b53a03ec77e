"""Crawl over links extracted from HTML, and CSV position decoding."""

from pyspark.sql import functions as F

from quarry.functions.text import positions_csv, positions_from_csv
from quarry.operators.links import crawl_tree, link_edges
from quarry.sources.corpus import read_pages

SITE = "https://s.org"


def page(i, links):
    body = "".join(f'<a href="{h}">l</a>' for h in links)
    return (i, f"{SITE}/p{i}.htm", f"<html><head><title>P{i}</title></head><body>{body}</body></html>")


def test_crawl_over_html_links(spark):
    rows = [
        page(0, ["p1.htm", "/p2.htm", "missing.htm", "javascript:go()", "p1.htm"]),
        page(1, ["./p3.htm", "p0.htm"]),
        page(2, ["p3.htm", "p4.htm#top"]),
        page(3, [f"{SITE}/p4.htm"]),
        page(4, []),
    ]
    pages = read_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    edges = link_edges(pages)
    got = {(r.parent_id, r.link_pos, r.child_id) for r in edges.collect()}
    # fragments make different URLs, so p4.htm#top is not page 4
    assert got == {(0, 0, 1), (0, 1, 2), (0, 3, 1), (1, 0, 3), (1, 1, 0), (2, 0, 3), (3, 0, 4)}
    tree = {r.page_id: (r.visit_order, r.parent_id) for r in crawl_tree(edges, pages).collect()}
    assert tree == {0: (1, None), 1: (2, 0), 2: (3, 0), 3: (4, 1), 4: (5, 3)}
    small = {r.page_id for r in crawl_tree(edges, pages, max_pages=3).collect()}
    assert small == {0, 1, 2}


def test_positions_csv_round_trip(spark):
    df = spark.createDataFrame([([3, 17, 40],), ([],)], "p array<int>")
    out = df.select(positions_csv(F.col("p")).alias("c")).select("c", positions_from_csv(F.col("c")).alias("back")).collect()
    assert [r.c for r in out] == ["3,17,40", ""]
    assert [r.back for r in out] == [[3, 17, 40], []]
