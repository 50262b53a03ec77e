"""A corpus pipeline over ``documents``: language ID, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as Parquet to
the shared folder and read again as the next one's ``docs``. All but the last return the columns of ``docs``.

Null texts have no language and go in the first stage; rows of null id are never duplicates of others; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm import decontaminate, jaccard, language, packing, substrings
from quarry.llm.shared import table, written
from quarry.llm.tokens import tokenizer_path
from quarry.operators.util import dense_index

#: Compression and tokenizers are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin."""
    labelled = docs.where(~language.held_out(F.col("doc_id"))).select("text", "lang")
    return language.accepted(docs, language.fit(labelled))


def one_id_a_text(docs: DataFrame) -> DataFrame:
    """``docs`` and ``_node``: the id; where an id has several texts, its text of least hash keeps it and the others get unused ids."""
    text = F.xxhash64("text").alias("_h")
    ids = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("_id"), text)
    several = ids.groupBy("_id").agg(F.min("_h").alias("_first"), F.max("_h").alias("_last")).where("_first <> _last")
    others = written(ids.join(several, "_id").where("_h <> _first").select("_id", "_h").distinct(), "other-texts")
    n = others.count()
    named = docs.withColumn("_id", F.col("doc_id").cast("long"))
    if not n:
        return named.withColumnRenamed("_id", "_node")
    least, most = ids.agg(F.min("_id"), F.max("_id")).first()
    start = most + 1 if most + n < 2**63 else least - n
    others = dense_index(others, [F.col("_id"), F.col("_h")], "_other", start)
    joined = named.select("*", text).join(others, ["_id", "_h"], "left")
    return joined.withColumn("_node", F.coalesce("_other", "_id")).drop("_id", "_h", "_other")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents that links connect: the one of smallest id. Unlike texts of one id are documents of
    their own (see ``one_id_a_text``); of rows of one id and text the one of least hash stays."""
    nodes, columns = one_id_a_text(docs), [F.col(f"`{c}`") for c in docs.columns]
    joined = jaccard.jaccard_join(nodes.select(F.col("_node").alias("doc_id"), "text"))
    kept = joined.where("doc_id = component_id").select(F.col("doc_id").alias("_node")).distinct()
    rank = F.row_number().over(Window.partitionBy("_node").orderBy(F.xxhash64(*columns)))
    named = nodes.join(kept, "_node", "left_semi").withColumn("_r", rank).where("_r = 1").select(*columns)
    return named.unionByName(docs.where("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier are cut out; a document of which nothing is left goes."""
    columns = docs.columns
    cut = substrings.substring_dedup(docs).where("n_removed < n_words OR n_words = 0")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in columns:
        size = F.length("kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("n_removed") > 0, size).otherwise(F.col("row.n_chars"))
    return cut.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, and their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
