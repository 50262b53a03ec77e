"""Headline benchmark: prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Times, on ``local[$BENCH_CPUS]``:

* ``index_build``     documents -> tokens -> stems -> postings/df/weights, written
                      as a term-bucketed Parquet index (scratch folder)
* ``search_topk``     benchmark passages as a batch of free/phrase queries
                      against the stored index, top 50 per query
* ``explain_scores``  same with dot/norm components
* ``similar_pages``   every page's top-5 keywords re-run as a query
* ``top_keywords``    5 keywords per page with zero padding
* ``crawl_report``    BFS crawl of the page table + index of crawled pages +
                      one report block per page
* ``html_links``      title/body/link extraction and URL resolution
* ``recent_distinct`` 5 most recent distinct values per user over events

Each query runs to completion through the ``noop`` sink (nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quarry.functions.html import extract_body, extract_title  # noqa: E402
from quarry.operators import lookup, search as srch  # noqa: E402
from quarry.operators.analyze import page_postings  # noqa: E402
from quarry.operators.index import build_index  # noqa: E402
from quarry.operators.links import child_links, extract_links, parent_links  # noqa: E402
from quarry.operators.report import page_blocks  # noqa: E402
from quarry.operators.results import recent_distinct  # noqa: E402
from quarry.operators.similar import similar_pages  # noqa: E402
from quarry.operators.util import rebalance_small_input  # noqa: E402
from quarry.plans.catalog import benchmark_queries, crawl_index  # noqa: E402
from quarry.session import local_session  # noqa: E402
from quarry.sources.corpus import documents_as_corpus, read_pages, read_table  # noqa: E402
from quarry.sources.stopwords import load_stopwords  # noqa: E402
from quarry.sources.store import read_index, write_index  # noqa: E402


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # 4 x cores: the 100M-row scoring shuffle at sf0.1 stays in memory per task;
    # AQE coalesces the small shuffles back down
    default_parts = 4 * int(cpus) if cpus.isdigit() else 32
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", default_parts))
    spark = local_session(cpus, shuffle_partitions=parts, app="quarry-bench")
    scratch = tempfile.mkdtemp(prefix="quarry-bench-")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    # warm-up: JVM, Python workers, stop-word table
    run(load_stopwords(spark))

    index_path = os.path.join(scratch, "index")

    def build():
        corpus = rebalance_small_input(documents_as_corpus(read_table(spark, sf_dir, "documents")), "page_id")
        write_index(build_index(None, corpus, page_postings(corpus, load_stopwords(spark))), index_path)

    timed("index_build", build)
    index = read_index(spark, index_path)
    queries = benchmark_queries(spark, sf_dir)

    timed("search_topk", lambda: run(srch.search(queries, index)))
    timed("explain_scores", lambda: run(srch.explain_scores(queries, index)))
    timed("similar_pages", lambda: run(similar_pages(index)))
    timed("top_keywords", lambda: run(lookup.top_keywords(index)))

    def crawl_report():
        c = crawl_index(spark, sf_dir)
        kw = lookup.top_keywords(c.index)
        blocks = page_blocks(c.tree, c.index.pages, kw, parent_links(c.tree, c.snapshot), child_links(c.tree, c.snapshot))
        run(blocks)

    timed("crawl_report", crawl_report)

    def html_links():
        raw = read_table(spark, sf_dir, "pages")
        run(raw.select("page_id", extract_title(F.col("html")).alias("t"), extract_body(F.col("html")).alias("b")))
        run(extract_links(read_pages(raw)))

    timed("html_links", html_links)
    timed("recent_distinct", lambda: run(recent_distinct(read_table(spark, sf_dir, "events"))))

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": parts,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
