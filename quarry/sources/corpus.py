"""Corpus sources.

Both loaders produce the canonical corpus
``page_id long, url string, title string, body string, last_modified string, size long``:

* ``documents_as_corpus``: plain-text documents; title = the tokens of the
  first line (so the title is also inside the body, as for HTML pages).
* ``pages_as_corpus``: raw HTML pages; title and body extracted with column
  expressions (``quarry.functions.html``).

Only the columns a caller selects are read: Catalyst prunes the Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.html import extract_body, extract_title
from quarry.functions.text import first_line, tokenize

CORPUS_COLUMNS = ("page_id", "url", "title", "body", "last_modified", "size")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def documents_as_corpus(documents: DataFrame) -> DataFrame:
    """Documents as pages. A null source is an empty one, so that every page has a URL of its own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.col("doc_id").cast("long").alias("page_id"),
        F.concat(F.lit("doc://"), F.coalesce("source", F.lit("")), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.array_join(tokenize(first_line(text)), " ").alias("title"),
        text.alias("body"),
        F.lit("").alias("last_modified"),
        F.octet_length(text).cast("long").alias("size"),
    )


def read_pages(pages: DataFrame) -> DataFrame:
    """Page snapshot: (page_id, url, html, last_modified, size in bytes)."""
    cols = pages.columns
    lm = F.coalesce(F.col("last_modified"), F.lit("")) if "last_modified" in cols else F.lit("")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
        lm.alias("last_modified"),
        F.octet_length(F.coalesce(F.col("html"), F.lit(""))).cast("long").alias("size"),
    )


def pages_as_corpus(pages: DataFrame) -> DataFrame:
    snap = read_pages(pages)
    return snap.select(
        "page_id",
        "url",
        extract_title(F.col("html")).alias("title"),
        extract_body(F.col("html")).alias("body"),
        "last_modified",
        "size",
    )

