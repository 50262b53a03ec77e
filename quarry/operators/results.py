"""Result enrichment, paging, recent distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: results per result page.
RESULTS_PER_PAGE = 7


def enrich_results(
    results: DataFrame,
    pages: DataFrame,
    keywords: DataFrame,
    parents: DataFrame | None = None,
    children: DataFrame | None = None,
) -> DataFrame:
    """Attach page metadata, top keywords and parent/child URLs to ranked
    results ``(query_id, rank, page_id, score)``. Missing metadata falls back
    to 'No Title' / 'Last Modified Not Found' / 'Size Not Found'."""
    meta = pages.select("page_id", "url", "title", "last_modified", F.col("size").cast("string").alias("size"))
    out = (
        results.join(meta, "page_id", "left")
        .join(keywords, "page_id", "left")
    )
    empty = F.array().cast("array<string>")
    if parents is not None:
        out = out.join(parents, "page_id", "left")
    else:
        out = out.withColumn("parents", empty)
    if children is not None:
        out = out.join(children, "page_id", "left")
    else:
        out = out.withColumn("children", empty)
    return out.select(
        "query_id",
        "rank",
        "page_id",
        "url",
        F.coalesce("title", F.lit("No Title")).alias("title"),
        "score",
        F.coalesce("last_modified", F.lit("Last Modified Not Found")).alias("last_modified"),
        F.coalesce("size", F.lit("Size Not Found")).alias("size"),
        "keywords",
        F.coalesce("parents", empty).alias("parent_links"),
        F.coalesce("children", empty).alias("child_links"),
    )


def paginate(results: DataFrame, per_page: int = RESULTS_PER_PAGE, page: int | None = None) -> DataFrame:
    """Number result pages: rows ((p-1)*per_page, p*per_page] by rank, and
    ``total_pages = ceil(n / per_page)`` per query. With ``page`` only that
    page is kept (page <= 0 gives no rows)."""
    n = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    out = results.withColumn("page", ((F.col("rank") - 1) / per_page).cast("long") + 1).withColumn(
        "total_pages", F.ceil(n / F.lit(per_page)).cast("long")
    )
    if page is not None:
        out = out.where(F.col("page") == F.lit(page))
    return out


def recent_distinct(
    events: DataFrame, key: str = "user_id", value: str = "props", ts: str = "ts", k: int = 5
) -> DataFrame:
    """``(key, rank, value, last_ts)``: per key, the k most recent distinct
    values, newest first (an earlier duplicate is dropped).

    Pre-aggregates to one row per (key, value) before the window, and the
    ``rank <= k`` limit is applied per partition before the shuffle, so a key
    holding a third of all events still moves at most k rows per partition."""
    last = events.groupBy(key, value).agg(F.max(ts).alias("last_ts"))
    w = Window.partitionBy(key).orderBy(F.col("last_ts").desc(), F.col(value))
    return last.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(key, "rank", value, "last_ts")
