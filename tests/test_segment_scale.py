"""Dead pages are dropped by bits, and frequencies come from the directory of blocks."""

import contextlib
import io

from pyspark.sql import functions as F

from quarry.operators import util
from quarry.operators.analyze import page_postings
from quarry.operators.index import build_index, term_df
from quarry.sources import segments as seg
from quarry.sources.store import directory_df, write_wide

CORPUS = "page_id long, url string, title string, body string, last_modified string, size long"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dead_pages_are_sent_as_bits(spark, monkeypatch, tmp_path):
    """More dead pages than may be broadcast: their bits still are, and no posting is sorted to drop them."""
    stops = spark.createDataFrame([("the",)], "term string")
    ids = spark.range(300).select((F.col("id") - 50).alias("page_id"))
    corpus = ids.select(
        "page_id", F.concat(F.lit("u"), "page_id").alias("url"), F.lit("t").alias("title"),
        F.concat(F.lit("old wren"), "page_id").alias("body"), F.lit("").alias("last_modified"), F.lit(1).cast("long").alias("size"),
    )
    path = str(tmp_path / "index")
    seg.write_segments(build_index(None, corpus, page_postings(corpus, stops)), path, block_rows=100)
    again = corpus.where("page_id % 2 = 0").withColumn("body", F.lit("new finch")).withColumn("last_modified", F.lit("2"))
    monkeypatch.setattr(util, "BROADCAST_MAX_ROWS", 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = seg.read_segments(spark, path, seg.refresh_segments(spark, path, again, stops, block_rows=100))
        text = plan(index.wide)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    live = {r.page_id: r.terms for r in index.wide.where("body_tf > 0").groupBy("page_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()}
    assert len(live) == 300 and all((t == ["finch", "new"]) == (p % 2 == 0) for p, t in live.items())
    assert index.dead.count() == 150 and index.pages.count() == 300


def test_rows_among_masks(spark):
    pages = [(-70, 0), (-1, 0), (0, 0), (63, 0), (64, 1), (1 << 40, 0)]
    rows = spark.createDataFrame([*pages, (None, 0), (1, 0), (0, 1), (64, 0)], "page_id long, segment int")
    masks = seg._masks(spark.createDataFrame([*pages, (None, 0)], "page_id long, segment int"))
    got = lambda among: sorted(map(tuple, seg._among(rows, masks, among).collect()), key=str)
    assert got(True) == sorted(pages, key=str)
    assert got(False) == sorted([(None, 0), (1, 0), (0, 1), (64, 0)], key=str)


def test_frequencies_from_the_directory(spark, tmp_path):
    rows = [(i, f"u{i}", "crow" if i % 3 else "wren crow", f"crow finch{i % 5}", "", 1) for i in range(60)]
    wide = page_postings(spark.createDataFrame(rows, CORPUS))
    stored = write_wide(wide, str(tmp_path / "wide"), str(tmp_path / "directory"), 10)
    have = directory_df(spark.read.parquet(str(tmp_path / "directory")))
    assert sorted(map(tuple, have.collect())) == sorted(map(tuple, term_df(stored).collect()))
    assert have.schema.simpleString() == term_df(stored).schema.simpleString()
