"""Text reports: the per-page crawl report and the result listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.lookup import format_keywords

# Report layout.
BLOCK_SEPARATOR = "\n----------------\n"


def page_blocks(tree: DataFrame, pages: DataFrame, keywords: DataFrame, parents: DataFrame, children: DataFrame) -> DataFrame:
    """``(visit_order, block)``: one report block per crawled page:
    title, URL, date ('N/A' when empty), size, keywords, parents joined by
    ', ' (or 'None'), children joined by ',\\n' (or 'None')."""
    j = (
        tree.select("page_id", "visit_order")
        .join(pages.select("page_id", "url", "title", "last_modified", "size"), "page_id")
        .join(keywords, "page_id", "left")
        .join(parents, "page_id", "left")
        .join(children, "page_id", "left")
    )
    lm = F.when(F.coalesce(F.col("last_modified"), F.lit("")) == "", F.lit("N/A")).otherwise(F.col("last_modified"))
    par = F.when(F.size("parents") > 0, F.array_join("parents", ", ")).otherwise(F.lit("None"))
    kid = F.when(F.size("children") > 0, F.array_join("children", ",\n")).otherwise(F.lit("None"))
    block = F.concat(
        F.lit("Page title: "), F.coalesce(F.col("title"), F.lit("None")), F.lit("\n"),
        F.lit("URL: "), F.col("url"), F.lit("\n"),
        F.lit("Last Modification Date: "), lm, F.lit("\n"),
        F.lit("Size: "), F.col("size").cast("string"), F.lit(" bytes\n"),
        F.lit("Keywords: "), format_keywords(F.col("keywords")), F.lit("\n"),
        F.lit("Parent Links: "), par, F.lit("\n"),
        F.lit("Child Links: "), kid,
    )
    return j.select("visit_order", block.alias("block"))


def write_page_report(blocks: DataFrame, path: str) -> None:
    """Write the report as ordered text part files (no single task holds it):
    every block but the last carries the separator, so concatenating the
    parts in order gives the whole report."""
    last = blocks.agg(F.max("visit_order")).scalar()
    text = F.when(F.col("visit_order") == last, F.col("block")).otherwise(
        F.concat(F.col("block"), F.lit("\n"), F.lit(BLOCK_SEPARATOR))
    )
    blocks.orderBy("visit_order").select(text.alias("value")).write.mode("overwrite").text(path)


def format_results(results: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """``(query_id, rank, text)``: '<rank>. [<title>]' / '   URL: <url>' /
    '   Score: <score %.4f>'; a missing or blank title prints 'No Title'.
    With ``queries``, a query without hits gets one row (rank 0) reading
    'No results found.'."""
    title = F.trim(F.coalesce(F.col("title"), F.lit("")))
    title = F.when(title == "", F.lit("No Title")).otherwise(title)
    # pre-rounded half-up with double arithmetic, so the printed 4 decimals do
    # not depend on the formatter's tie rule
    score4 = F.floor(F.col("score") * F.lit(1e4) + F.lit(0.5)) / F.lit(1e4)
    text = F.format_string("%d. [%s]\n   URL: %s\n   Score: %.4f\n", F.col("rank"), title, F.col("url"), score4)
    out = results.select("query_id", F.col("rank").cast("long").alias("rank"), text.alias("text"))
    if queries is None:
        return out
    empty = queries.select("query_id").join(results.select("query_id"), "query_id", "left_anti").select(
        "query_id", F.lit(0).cast("long").alias("rank"), F.lit("No results found.").alias("text")
    )
    return out.unionByName(empty)
