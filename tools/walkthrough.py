"""The reference's workflow, end to end, with quarry.

    python tools/walkthrough.py [sf_dir] [scratch_dir]

crawl -> index -> page report; search one query with enrichment and paging;
similar pages; tf/df/positions look-ups; batch search written to Parquet.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import lookup, search, similar  # noqa: E402
from quarry.operators.analyze import analyze  # noqa: E402
from quarry.operators.index import build_index  # noqa: E402
from quarry.operators.links import child_links, crawl_tree, derived_edges, parent_links  # noqa: E402
from quarry.operators.report import format_results, page_blocks, write_page_report  # noqa: E402
from quarry.operators.results import enrich_results, paginate  # noqa: E402
from quarry.session import local_session  # noqa: E402
from quarry.sources.corpus import pages_as_corpus, read_pages, read_table  # noqa: E402
from quarry.sources.stopwords import load_stopwords  # noqa: E402
from quarry.sources.store import read_index, write_index  # noqa: E402


def run(spark, sf_dir: str, out: str) -> None:
    # 1. crawl (breadth-first, 300-page budget) and index the crawled pages
    raw = read_table(spark, sf_dir, "pages")
    snapshot = read_pages(raw)
    tree = crawl_tree(derived_edges(snapshot), snapshot, root=0, max_pages=300)
    corpus = pages_as_corpus(raw).join(tree.select("page_id", F.col("visit_order").alias("page_order")), "page_id")
    index = build_index(analyze(corpus, load_stopwords(spark)), corpus)
    write_index(index, os.path.join(out, "index"))
    index = read_index(spark, os.path.join(out, "index"))

    # 2. the crawl report (title, URL, date, size, keywords, parents, children)
    parents, children = parent_links(tree, snapshot), child_links(tree, snapshot)
    blocks = page_blocks(tree, index.pages, lookup.top_keywords(index), parents, children)
    write_page_report(blocks, os.path.join(out, "spider_report"))

    # 3. one query, enriched and paged (7 per page), as the result listing
    hits = search.search_text(spark, index, '"anea eriner" tion').withColumn("query_id", F.lit(0).cast("long"))
    keywords = lookup.top_keywords(index).select("page_id", lookup.format_keywords(F.col("keywords")).alias("keywords"))
    enriched = enrich_results(hits, index.pages, keywords, parents, children)
    page1 = paginate(enriched, page=1)
    for row in format_results(page1).orderBy("rank").collect():
        print(row.text)

    # 4. similar pages of every page
    print("similar-page hits:", similar.similar_pages(index).count())

    # 5. look-ups: tf and positions of a stemmed word on a page, df of words
    first_url = index.pages.orderBy("page_order").first()["url"]
    req = spark.createDataFrame([(first_url, "anea"), (first_url, "zzz")], "url string, term string")
    lookup.term_frequency(req, index).show(truncate=60)
    lookup.term_positions(req, index).show(truncate=60)
    lookup.term_df_lookup(req.select("term"), index).show()

    # 6. a batch of queries ranked in one job, written as Parquet
    queries = spark.createDataFrame([(1, "eriner anea"), (2, '"de de"'), (3, "the of and")], "query_id long, query string")
    search.search(queries, index).write.mode("overwrite").parquet(os.path.join(out, "results"))
    print("written to", out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    out = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="quarry-walk-")
    spark = local_session(8)
    run(spark, sf_dir, out)
    spark.stop()


if __name__ == "__main__":
    main()
