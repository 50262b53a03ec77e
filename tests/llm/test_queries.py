"""The registered queries against their SQL, or against plain versions; the pipeline stage by stage."""

import hashlib
import os

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import language
from quarry.llm.queries import ORACLE_SQL, QUERIES
from quarry.llm.shared import written
from quarry.llm.tokens import tokenizer_path

from . import brute
from .conftest import frame
from .test_data_operators import packed_well
from .test_text_operators import fingerprint

SMALL = "/root/testdata/sf0.001"


def rows_of(name):
    return duckdb.sql(f"select * from '{SMALL}/{name}.parquet'").df()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, SMALL).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    plain = lambda df: sorted(map(tuple, df[cols].astype(str).values.tolist()))
    assert plain(got) == plain(want)


def test_fingerprint_query(spark):
    docs = rows_of("documents").sort_values("doc_id", ascending=False)[["doc_id", "text"]].values.tolist()
    got = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SMALL).collect()}
    prints = {i: fingerprint(t) for i, t in docs}
    assert len(got) == len(docs)
    for n, (i, text) in enumerate(docs):
        following = docs[(n + 1) % len(docs)]
        k = len(text) // 3
        changed = text[: len(text) - k] + following[1][:k]
        r, other = got[i], fingerprint(changed)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (f"{prints[i]:016x}", f"{other:016x}")
        assert r.near_edited == 1 - bin(prints[i] ^ other).count("1") / 64
        assert r.near_next == 1 - bin(prints[i] ^ prints[following[0]]).count("1") / 64
        near = sum(bin(prints[i] ^ p).count("1") <= 3 for p in prints.values()) - 1
        assert r.n_within == (near if i % 100 == 0 else None)


def test_decontamination_query(spark):
    docs, items = rows_of("documents"), rows_of("benchmark")
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_benchmark_decontamination"](spark, SMALL).collect()}
    plain = lambda t: " ".join(t.lower().split("\n"))
    exact = {(i, j) for i, t in docs[["doc_id", "text"]].values for j, u in items[["item_id", "text"]].values if plain(u) in plain(t)}
    assert exact and exact <= got and len(got) <= len(exact) + 2


def test_quality_and_language_queries_cover_all(spark):
    ids = set(rows_of("documents").doc_id)
    assert {r.doc_id for r in QUERIES["op3_quality_classifier"](spark, SMALL).collect()} == ids
    rows = QUERIES["op4_language_id"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == ids and {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"}


def test_packing_and_token_queries(spark):
    docs = rows_of("documents").sort_values("doc_id")[["doc_id", "text"]].values.tolist()
    rows = QUERIES["op7_best_fit_packing"](spark, SMALL).collect()
    want = brute.pieces(Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), docs, 1, 4096)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    packed_well(rows, 4096)
    rows = QUERIES["op8_token_files"](spark, SMALL).collect()
    want = brute.pieces(Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")), docs, 2, 1 << 60)
    starts = np.cumsum([0, *[w[3] for w in want]])[:-1].tolist()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == [(w[0], s, w[3], w[4]) for w, s in zip(want, starts, strict=True)]


def plain_pipeline(rows, items, dictionaries, spark):
    """The pipeline over lists of (doc_id, text); stage 1 judges with the same dictionaries."""
    judged = language.classify(frame(spark, rows).select("doc_id", "text"), dictionaries).collect()
    rows = sorted((r.doc_id, r.text) for r in judged if not r.rejected)
    yield rows
    component = brute.jaccard(rows)
    rows = [r for r in rows if component[r[0]] == r[0]]
    yield rows
    cut = {i: (kept if removed else None, removed < n or not n) for i, n, removed, kept in brute.dedup(rows)}
    rows = [(i, t if cut[i][0] is None else cut[i][0]) for i, t in rows if cut[i][1]]
    yield rows
    plain = lambda t: "".join(" " if c in "\t\n\x0b\x0c\r" else c.lower() for c in t)
    # here the passages are whole; tests of the operator compare near ones with all alignments
    yield [(i, t) for i, t in rows if not any(plain(u) in plain(t) for _, u in items)]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labelled = docs.where(~language.held_out(F.col("doc_id"))).select("text", "lang")
    dictionaries = language.fit(labelled)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [tuple(x) for x in rows_of("benchmark")[["item_id", "text"]].values.tolist()]
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], plain_pipeline(rows, items, dictionaries, spark), strict=True):
        docs = written(stage(spark, docs, SMALL), name)
        assert docs.columns == columns, name
        got = docs.collect()
        assert sorted((r.doc_id, r.text) for r in got) == want, name
        assert all(r.n_chars == len(r.text) for r in got)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    want = brute.pieces(Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), [(r.doc_id, r.text) for r in docs.collect()], 1, 4096)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(want)


def test_near_duplicates_of_repeated_ids(spark):
    """Unlike texts of one id do not go with each other's copies, and the same row of equal ones stays however they are dealt."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a), (1, b), (2, a), (3, b), (3, c), (5, d), (5, d), (None, a), (2**63 - 1, c)]
    got = [
        sorted(map(str, corpus_pipeline.near_duplicates(spark, frame(spark, rows, n), SMALL).collect())) for n in (1, 4)
    ]
    texts = sorted(r.split("text='")[1].split("'")[0] for r in got[0])
    assert got[0] == got[1] and texts == sorted([a, a, b, c, d])


def test_pipeline_stages_take_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        docs = written(docs, "odd")
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = written(stage(spark, docs, SMALL), name)
            assert name == "best_fit_packing" or docs.columns == before
        docs.count()


def test_entry_registers_all():
    from __spark_entry__ import queries

    names = queries()
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in names if name.startswith("op")}
    assert "pipeline" in names and os.path.exists(corpus_pipeline.__file__)
