"""Substring dedup, Jaccard join, decontamination, SimHash."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import blocks, decontaminate, jaccard, simhash, substrings
from quarry.llm.components import components

from . import brute
from .conftest import frame, words


@pytest.mark.parametrize("block_bytes", [6_000, 1 << 20])
def test_substring_dedup(odd, odd_rows, block_bytes):
    got = substrings.substring_dedup(odd, block_bytes=block_bytes).select("row.*", "text", "n_words", "n_removed", F.col("kept").alias("left"))
    assert got.columns[: len(odd.columns)] == [*(c for c in odd.columns if c != "text"), "text"]
    rows = [(r.doc_id, r.n_words, r.n_removed, r.left) for r in got.collect()]
    assert brute.by_none(rows) == brute.by_none(brute.dedup(odd_rows))


def test_substring_dedup_of_nothing(empty):
    assert substrings.substring_dedup(empty).count() == 0


@pytest.mark.parametrize(("block_bytes", "chunk"), [(6_000, 1_000_000), (6_000, 900), (1 << 20, 1_000_000)])
def test_jaccard_join(odd, odd_rows, block_bytes, chunk, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    got = jaccard.jaccard_join(odd, block_bytes=block_bytes).collect()
    want = brute.jaccard(odd_rows)
    assert len(got) == len(odd_rows)
    assert {r.doc_id: r.component_id for r in got} == {**want, None: None}
    sizes = {(i, len(brute.shingles(t))) for i, t in odd_rows}
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes


def test_jaccard_join_of_chains_in_chunks(spark, monkeypatch):
    """Groups that only hang together link by link, far beyond a chunk; and two texts under one id."""
    rnd = random.Random(3)
    rows = []
    for g in range(3):
        text = words(rnd, 60, 10**6)
        for i in range(40):
            at = (i * 7) % 55
            text = [*text[:at], f"g{g}i{i}", *text[at + 1 :]]
            rows.append((1000 * g + (i * 13) % 40, " ".join(text)))
    rows += [(5000, rows[0][1]), (5000, "quite another text of six words"), (6000, "quite another text of six words")]
    monkeypatch.setattr(jaccard, "CHUNK", 500)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_join(frame(spark, rows), block_bytes=4_000).collect()}
    want = brute.jaccard([r for r in rows if r[0] < 5000])
    assert {i: c for i, c in got.items() if i < 5000} == want
    assert got[5000] == got[6000] == want[rows[0][0]]


def test_jaccard_join_of_nothing(empty):
    assert jaccard.jaccard_join(empty).count() == 0


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60) if i % 10 != 9] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(50)]
    edges += [(1000, i) for i in range(1001, 1100)]
    parent = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: c for x, c in parent.items() if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 50])
def test_cuts_below(spark, n):
    rnd = random.Random(n)
    cuts = sorted(rnd.sample(range(-60, 60), n))
    ids = spark.range(-70, 70).select("id", blocks.cuts_below(F.col("id"), cuts).alias("b")).collect()
    assert [r.b for r in ids] == [sum(c < r.id for c in cuts) for r in ids]


def test_word_hashes_tell_words():
    texts = [b"a bb  a\n", b"", b" ", b"bb a \x0bccc"]
    w = blocks.Words(texts)
    assert (w.to - w.frm).tolist() == [3, 0, 0, 3]
    a, bb, a2, bb2, a3, ccc = w.hashes.tolist()
    assert a == a2 == a3 and bb == bb2 and len({a, bb, ccc}) == 3
    upper = blocks.Words([b"A Bb"], lower=True).hashes.tolist()
    assert upper == [a, bb]


def test_packed_keys_round_trip():
    import numpy as np

    rnd = np.random.default_rng(0)
    for n in (1, 2, 1000):
        keys = np.unique(rnd.integers(0, 2**32, n, np.uint64).astype("<u4"))
        assert (jaccard.unpack(jaccard.pack(keys)) == keys).all()


def test_decontamination(spark, odd):
    rnd = random.Random(2)
    items = [(i, " ".join(words(rnd, rnd.randrange(6, 40), 10**5))) for i in range(12)] + [(50, None), (51, "short"), (52, "x" * 60)]
    rows = []
    for n in range(60):
        _, text = items[n % 12]
        chars = list(text)
        for _ in range(rnd.randrange(0, int(0.16 * len(text)) + 2)):
            at = rnd.randrange(len(chars))
            chars[at : at + rnd.choice([0, 1])] = rnd.choice(["", "q", "#"])
        body = "".join(chars)
        rows.append((n, " ".join(words(rnd, n % 7)) + " " + (body.upper() if n % 5 == 0 else body.replace(" ", "\n")) + " " + " ".join(words(rnd, n % 5))))
    docs = frame(spark, rows).unionByName(odd.where("doc_id IS NULL OR doc_id < 100").withColumn("doc_id", F.col("doc_id") + 1000))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.edits for r in decontaminate.contaminated(docs, benchmark).collect()}
    want = {}
    plain = lambda t: re.sub(r"[\x09-\x0d]", " ", t).lower()
    for doc_id, text in rows:
        for item_id, item in items:
            if item and len(item) >= decontaminate.Q and item_id < 50:
                edits = brute.least_edits(plain(item), plain(text))
                if edits <= min(int(decontaminate.EDITS * len(item)), (len(item) - decontaminate.Q) // decontaminate.Q):
                    want[doc_id, item_id] = edits
    assert want and {k: v for k, v in found.items() if k[0] < 1000 and k[1] < 50} == want
    assert {k for k in found if k[0] >= 1000} == {(1010, 52), (1011, 52)}
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in left.collect()} == {k[0] for k in found}


def test_decontamination_in_pieces_and_shards(spark, monkeypatch):
    rnd = random.Random(4)
    items = [(i, " ".join(words(rnd, 20, 10**5))) for i in range(9)]
    text = " ".join(" ".join(words(rnd, 50, 10**5)) + " " + t for _, t in items)
    monkeypatch.setattr(decontaminate, "PIECE", 700)
    assert {(r, i) for r, i, _, _ in decontaminate.found_in([None, text, ""], decontaminate.Items(items, 0.1))} == {(1, i) for i in range(9)}
    monkeypatch.setattr(decontaminate, "SHARD_CHARS", 300)
    docs, benchmark = frame(spark, [(1, text), (2, "clean")]), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contaminated(docs, benchmark).count() == 9
    assert [r.doc_id for r in decontaminate.clean(docs, benchmark).collect()] == [2]


def test_decontamination_of_nothing(empty, odd, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(empty, none).count() == decontaminate.contaminated(odd, none).count() == 0
    assert decontaminate.clean(odd, none).count() == odd.count()


def fingerprint(text):
    ws = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    votes = [0] * 64
    for i, w in enumerate(ws):
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        if i + 1 < len(ws):
            h = xxhash.xxh64_intdigest(ws[i + 1].encode(), seed=h)
        n = 1 + sum(len(w) > limit for limit in (1, 3, 7, 15))
        for b in range(64):
            votes[b] += n if h >> b & 1 else -n
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_fingerprints(odd, odd_rows):
    keyed = odd.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    got = simhash.fingerprints(keyed, ["doc_id", "h"]).collect()
    assert sum(r.copies for r in got) == len(odd_rows)
    assert {(r.doc_id, r.fingerprint) for r in got} == {(i, simhash.signed(fingerprint(t or ""))) for i, t in odd_rows}


def test_neighbours_and_edited(odd, odd_rows, spark):
    docs = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = sorted({i for i, _ in odd_rows if i is not None}, reverse=True) + [None]
    near = simhash.neighbours(docs)
    assert {(r.doc_id, r.next_id) for r in near.collect()} == set(zip(ids, [*ids[1:], ids[0]], strict=True))
    texts = {i: t or "" for i, t in odd_rows if i is not None}
    got = simhash.edited(docs, near)
    assert got.count() == len(odd_rows)
    for r in got.where("doc_id IS NOT NULL").collect():
        k = len(r.text) // 3
        following = ids[ids.index(r.doc_id) + 1]
        if following is not None:
            assert r.edited == r.text[: len(r.text) - k] + texts[following][:k]
    one = spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")
    assert simhash.edited(one, simhash.neighbours(one)).first().edited == "abcdab"


def test_within_radius(spark):
    rnd = random.Random(0)
    base = [rnd.getrandbits(64) for _ in range(30)]
    data = base + [x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))) for x in base for _ in range(10)]
    df = spark.createDataFrame([(simhash.signed(x),) for x in data], "fingerprint long")
    asked = [simhash.signed(x) for x in base[:9]]
    for radius, n_blocks in ((3, 6), (2, 4), (0, 2)):
        got = simhash.within_radius(spark.createDataFrame([(x,) for x in asked], "fingerprint long"), df, radius, n_blocks).collect()
        want = {(q, simhash.signed(x)) for q in asked for x in data if bin((q ^ x) & (2**64 - 1)).count("1") <= radius}
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_fingerprints_of_nothing(empty):
    docs = empty.select("doc_id", "text")
    assert simhash.neighbours(docs).count() == 0
    assert simhash.fingerprints(docs, ["doc_id"]).count() == 0


def test_blocks_hold_so_many_bytes(spark):
    """Long texts beside short ones, all at one end or spread, repeated ids: no block of several ids holds more than asked."""
    rnd = random.Random(4)
    rows = [(i, "x" * 60_000) for i in range(40)] + [(1000 + i, "y" * rnd.randrange(300)) for i in range(3000)]
    rows += [(5000, "z" * 50_000)] * 5 + [(9000 + 3 * i, "w" * (20_000 if i % 7 == 0 else 10)) for i in range(700)] + [(None, "n")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    placed, n = blocks.in_blocks(docs, 100_000)
    held = {}
    for r in placed.select("block", "doc_id", "text").collect():
        size, ids = held.setdefault(r.block, [0, set()])
        held[r.block] = [size + len(r.text), ids | {r.doc_id}]
    assert max(held) + 1 <= n and all(size <= 100_000 or len(ids) == 1 for size, ids in held.values())
    assert len(held) < 4 * sum(len(t) for _, t in rows) / 100_000
    order = sorted((min(ids), max(ids)) for b, (_, ids) in held.items() if None not in ids)
    assert all(a[1] < b[0] for a, b in zip(order, order[1:], strict=False))
