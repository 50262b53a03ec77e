"""Language ID, quality, packing, token files, chat, URL filters."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import chat, cotraining, language, packing, token_files, url_filter
from quarry.llm.store import store
from quarry.llm.tokens import Encoder, tokenizer_path

from . import brute
from .conftest import frame

SF = "/root/testdata/sf0.01"
LANGS = {"en": "the of and that with from is was", "de": "der die und nicht mit von ist ein", "fr": "le la les et dans que est pour"}


def speech(rnd, lang, n):
    return " ".join(rnd.choice(LANGS[lang].split()) + rnd.choice(["", "s", "e"]) for _ in range(n))


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = language.fit(docs.where(~language.held_out(F.col("doc_id"))).select("text", "lang"))
    got = language.classify(docs, dictionaries).where(language.held_out(F.col("doc_id"))).select("lang", "lang_pred", "score").collect()
    assert len(got) > 150 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_of_odd_rows(spark, odd, empty):
    rnd = random.Random(0)
    train = spark.createDataFrame([(speech(rnd, lang, 200), lang) for lang in LANGS for _ in range(9)] + [("x y", None), (None, "en"), ("12", "zz")], "text string, lang string")
    dictionaries = language.fit(train)
    assert set(dictionaries) == set(LANGS)
    asked = [(i, speech(rnd, lang, 40).upper(), lang) for i, lang in enumerate([*LANGS] * 4)]
    got = {r.doc_id: r.lang_pred for r in language.classify(frame(spark, [a[:2] for a in asked]), dictionaries).collect()}
    assert got == {i: lang for i, _, lang in asked}
    judged = language.classify(odd, dictionaries)
    assert judged.count() == odd.count()
    for r in judged.select("text", "lang_pred", "rejected", F.col("doc_id")).collect():
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert r.lang_pred == "und" and r.rejected
        else:
            assert r.lang_pred in LANGS
    kept = language.accepted(odd, dictionaries)
    assert kept.columns == odd.columns and kept.count() == judged.where("not rejected").count()
    assert {r.lang_pred for r in language.classify(odd, language.fit(train.limit(0))).select("lang_pred").collect()} == {"und"}
    assert language.classify(empty, dictionaries).count() == 0


def test_language_id_of_long_texts(spark):
    """Clean texts of several MB are accepted, and the later part of a text counts as much as its beginning."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IN ('en', 'de', 'fr', 'es')")
    dictionaries = language.fit(docs.where(~language.held_out(F.col("doc_id"))).select("text", "lang"))
    spoken = {r.lang: " ".join(language.words(r.text)) for r in docs.groupBy("lang").agg(F.array_join(F.sort_array(F.collect_list("text")), " ").alias("text")).collect()}
    long_text = lambda lang, n: (spoken[lang] + " ") * (n // len(spoken[lang])) + spoken[lang][: n % len(spoken[lang])]
    asked = [(i, long_text(lang, 3_000_000), lang) for i, lang in enumerate(sorted(spoken))]
    asked += [(10, long_text("en", 600_000) + " " + long_text("de", 1_500_000), "de"), (11, long_text("fr", 1_500_000) + " " + long_text("es", 600_000), "fr")]
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in language.classify(frame(spark, [a[:2] for a in asked]), dictionaries).collect()}
    assert got == {i: (lang, False) for i, _, lang in asked}


def test_language_sample_of_copies(spark, monkeypatch):
    """Copies of one text take no other text's place in the sample: it is the distinct texts of lowest hash, whatever the bound."""
    own = F.translate(F.format_string("wort w%d", "id"), "0123456789", "abcdefghij").alias("text")
    rows = spark.range(500).select(own, F.lit("de").alias("lang")).unionByName(spark.range(3).select(own, F.lit("en").alias("lang"))).cache()
    copies = rows.unionByName(spark.range(100_000).select(F.lit("copy copy").alias("text"), F.lit("de").alias("lang")).repartition(4))
    seen = []
    monkeypatch.setattr(language, "dictionary", lambda counts: seen.append(counts) or b"")
    assert set(language.fit(copies)) == {"de", "en"}
    distinct = [r.text for r in copies.where("lang = 'de'").distinct().orderBy(F.xxhash64("text")).limit(language.SAMPLE_DOCS).collect()]
    assert language.Counter(w for t in distinct for w in language.words(t)) in seen and len(distinct) == 400
    hashed = rows.select("lang", F.xxhash64("text").alias("h"), "text")
    assert len(language.lowest(hashed, {"de": 0.01}).get("de", [])) < 50 and len(language.lowest(hashed, {"de": 1.0})["de"]) == 400
    monkeypatch.setattr(F, "approx_count_distinct", lambda c: F.lit(10**9) + F.max(F.lit(0)))  # an estimate far too high
    before = seen.copy()
    language.fit(copies)
    assert all(counts in before for counts in seen) and len(seen) == 4


def test_language_learns_from_whole_texts(spark):
    text = "a" * 5_000 + "b" * 5_000 + "c" * 10_000
    got = spark.createDataFrame([(text,), ("short",)], "text string").select(language.spread(F.col("text")).alias("t")).collect()
    assert [r.t for r in got] == [" ".join(x * 500 for x in "abcc"), "short"]


def test_segments_hold_all_words():
    rnd = random.Random(2)
    for sizes in ([5] * 9_000, [40_000, 3, 16_384, 16_383, 1, 16_385], [rnd.randrange(1, 60) for _ in range(4_000)], [], [16_384]):
        raw = b" ".join(b"x" * n for n in sizes)
        parts = list(language.segments(raw))
        assert all(len(p) <= language.SEGMENT for p in parts) and b"".join(parts).replace(b" ", b"") == raw.replace(b" ", b"")
        if max(sizes, default=0) <= language.SEGMENT:
            assert b" ".join(parts) == raw


def test_quality_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    known = labels.where("doc_id % 3 <> 0")
    got = cotraining.quality(docs, known).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert len(got) > 80
    assert np.mean([r.keep == bool(r.quality) for r in got]) > 0.93
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_co_training_helps_with_few_labels(spark):
    """Views taught by each other's sure labels rank at least as well as without a pool."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = cotraining.fit(docs, labels)
    assert model.text is not None and model.text_line[0] > 0 and model.meta_line[0] > 0


def test_quality_of_odd_rows(spark, odd, empty):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, text string")
    none, one = cotraining.quality(odd, labels([])), cotraining.quality(odd, labels([(1, 1, ""), (2, 1, ""), (None, 0, ""), (3, None, "")]))
    assert {r.score for r in none.collect()} == {0.5} and {r.score for r in one.collect()} == {1.0}
    mixed = labels([(100 + i, i % 2, "") for i in range(25)] + [(300 + i, (i + 1) % 2, "") for i in range(30)])
    rows = cotraining.quality(odd, mixed).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert cotraining.quality(empty, mixed).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_encode_as_whole_texts(name):
    encoder = Encoder(tokenizer_path(name))
    rnd = random.Random(1)
    letters = "ab1!' \n\t\u0301\u00e9\x1c\x85\u3000s'l<|>\u180e.,;Aßİ"
    texts = ["", " ", "  \n", "\n\nA  ", "<|endoftext|> x<|startoftext|>", "na\u00efve caf\u00e9, the end.", "it's I'll THE Ünder-way...", "x" * 5000]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    texts += ["".join(rnd.choice(["<|endoftext|>", "<|", "|>", "<|startoftext|>", "the ", " end", "\n", "é"]) for _ in range(8)) for _ in range(300)]
    texts += [" ".join(rnd.choice(["the", "Of,", "naïve.", "\nLine", "(x)", "12", "don't"]) for _ in range(50)) for _ in range(50)]
    own = Tokenizer.from_file(tokenizer_path(name))  # as the file has it
    want = [np.array(e.ids, "<u4").tobytes() for e in own.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want
    known = len(encoder.memo)
    for _ in range(3):
        encoder.chars = 10**12  # a full generation of the memo becomes the older one, and its pieces move up when used
        assert encoder.encode(texts[:900]) == want[:900] and len(encoder.older) <= known
    assert encoder.encode(texts) == want


def packed_well(rows, capacity):
    """Sequences are gapless from 0 and hold at most ``capacity``; how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing(odd, odd_rows, capacity):
    name = tokenizer_path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, name, 1, capacity).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)
    assert got == sorted(brute.pieces(Tokenizer.from_file(name), odd_rows, 1, capacity), key=repr)
    total = sum(r.length for r in rows)
    assert packed_well(rows, capacity) <= -(-total // capacity) * 1.2 + 1


def test_packing_keeps_ids(odd):
    rows = packing.pieces(odd, tokenizer_path("word_bpe_49k.json"), 1, 50).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 200 for r in rows)


def test_plan_is_best_fit():
    """Against best-fit decreasing over single pieces."""
    rnd = random.Random(6)
    for _ in range(30):
        capacity = rnd.choice([10, 37, 100])
        sizes = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 300))]
        counts = {n: sizes.count(n) for n in set(sizes)}
        room = []
        for n in sorted(sizes, reverse=True):
            best = min((r for r in room if r >= n), default=None)
            if best is not None:
                room.remove(best)
            room.append((capacity if best is None else best) - n)
        slots = packing.plan(counts, capacity)
        places = [(s + i // each, at + i % each * n, n) for n, a, b, s, each, at in slots for i in range(b - a)]
        assert len({p[:2] for p in places}) == len(sizes) and len({p[0] for p in places}) == len(room)
        assert sorted(n for *_, n in places) == sorted(sizes)
        assert all(sum(b - a for n, a, b, *_ in slots if n == size) == c for size, c in counts.items())


def test_packing_of_nothing(empty, spark):
    assert packing.pack_documents(empty, tokenizer_path("word_bpe_49k.json"), 1).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 9)], "doc_id long, piece int, length long"), 8)


def test_token_files(spark, odd, odd_rows):
    name = tokenizer_path("byte_bpe_50k.json")
    manifest = token_files.write_token_files(odd, name, 2)
    rows = token_files.read_token_files(spark, manifest).orderBy("start").collect()
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    tokenizer, at = Tokenizer.from_file(name), 0
    for row, (doc_id, text) in zip(rows, ordered, strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row.doc_id, row.start, bytes(row.ids)) == (doc_id, at, ids.tobytes())
        at += len(ids)
    assert manifest.agg(F.sum("n_tokens"), F.sum("n_docs")).first() == (at, len(ordered))


def test_token_file_reads_only_what_is_asked(spark, odd):
    first = token_files.write_token_files(odd, tokenizer_path("byte_bpe_50k.json"), 2).orderBy("shard").first()
    files, name = store(first.path)
    with files.open_input_file(name) as f:
        raw = bytearray(f.read())
    import io

    reader = token_files.Reader(io.BytesIO(raw))
    want = reader.document(0).tolist()
    at = int(reader.at[1])  # damage the second document: the first still reads, the second is found out
    if len(reader.doc_ids) > 1:
        raw[at + 6] ^= 255
        broken = token_files.Reader(io.BytesIO(raw))
        assert broken.document(0).tolist() == want
        with pytest.raises(Exception):  # noqa: B017 - zstandard's own error or ours
            broken.document(1)
    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(bytes(64)))


def test_token_files_of_nothing(spark, empty):
    manifest = token_files.write_token_files(empty, tokenizer_path("byte_bpe_50k.json"), 2)
    assert manifest.count() == 0 and token_files.read_token_files(spark, manifest).count() == 0


def test_chat(spark):
    odd_text = ["</s>[INST] ok [/INST]", "\\0\\1\\2", "<s>user\nhi</s>\n", "", None, "line\nline", "[<\\", "plain é"]
    rnd = random.Random(8)
    rows = []
    for conv in [*range(30), None]:
        for turn in range(rnd.randrange(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, None]), rnd.choice(["user", "assistant", "system", "assistant", None, "a\nb[<"]), rnd.choice(odd_text), 1, "x"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int, last string").repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.examples(df)).collect()}
    want = {}
    for conv, turn, role, text, *_ in rows:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns = [t[2:] for t in sorted(turns)]
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].loss == "".join(text for role, text in turns if role == "assistant")
    per = chat.examples(df).where("conv_id is not null").collect()
    for r in per:
        shown = chat.OPEN + "assistant\n"
        if r.loss_end > r.loss_start:
            assert r.text[: r.loss_start].endswith(shown) and r.text[r.loss_end :] == chat.CLOSE
    replies = sum(1 for c in want if c is not None for t in want[c] if t[2] == "assistant")
    tails = sum(1 for c in want if c is not None and sorted(want[c])[-1][2] != "assistant")
    assert len(per) == replies + tails
    assert chat.read_back(chat.examples(df.limit(0))).count() == 0


URLS = [
    ("http://A.example.ORG/es/x", "a.example.org", "/es/x", "example.org/es/"),
    ("http://example.org/en/1?x", "example.org", "/en/1", "example.org/en/1"),
    ("http://example.org/en/2#/en/1", "example.org", "/en/2", "org/"),
    ("http://notorg/", "notorg", "/", None),
    ("https://x.com/fr/", "x.com", "/fr/", "com/fr/"),
    ("x.com/fr/", "", "", None),
    ("ftp://y.com?://z.org/", "y.com", "", None),
    ("a://b.org", "b.org", "", None),
    ("a://b.org://c/d", "b.org:", "//c/d", None),
    (None, "", "", None),
    ("://", "", "", None),
]


def test_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow")]
    pages = spark.createDataFrame([(i, u[0], None, "h") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    rows = url_filter.judge(pages, rules).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in rows] == [u[1:] for u in URLS]
    assert all(r.verdict == ("block" if r.rule and r.rule.startswith("example.org") else "allow") for r in rows)
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_distrust_flows_against_links(spark):
    link = lambda *hosts: "".join(f"<a href='//{h}/p'>x</a>" for h in hosts)
    rows = [
        (1, "http://bad.b/x", ""),
        (2, "http://farm.f/x", link("BAD.b", "bad.b")),
        (3, "http://far.g/x", link("farm.f")),
        (4, "http://good.a/x", link("friend.c", "farm.f")),
        (5, "http://friend.c/x", link("friend.c")),
        (6, "http://alone.d/x", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = [("bad.b", "/", "block"), ("good.a", "/", "allow")]
    got = {r.host: r.verdict for r in url_filter.judge(pages, rules).collect()}
    assert got == {"bad.b": "block", "farm.f": "block", "far.g": "block", "good.a": "allow", "friend.c": "allow", "alone.d": "allow"}


def test_propagation_matches_plain_rounds(spark):
    rnd = random.Random(9)
    hosts = [f"h{i}" for i in range(12)]
    edges = {(a, b): float(rnd.randint(1, 4)) for a, b in ((rnd.choice(hosts), rnd.choice(hosts)) for _ in range(40)) if a != b}
    seeds = {h: (rnd.randrange(3), rnd.randrange(3)) for h in hosts[:5]}
    got = url_filter.propagate(
        spark.createDataFrame([(h, *n) for h, n in seeds.items()], "host string, trusted long, blocked long"),
        spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "src string, dst string, weight double"),
    ).collect()
    want = {}
    for kind, way in ((0, edges), (1, {(b, a): w for (a, b), w in edges.items()})):
        total = sum(n[kind] for n in seeds.values())
        start = {h: n[kind] / total for h, n in seeds.items() if n[kind]}
        rank = dict(start)
        for _ in range(url_filter.ROUNDS):
            after = {h: (1 - url_filter.DAMPING) * r for h, r in start.items()}
            for (a, b), w in way.items():
                out = sum(x for (s, _), x in way.items() if s == a)
                after[b] = after.get(b, 0) + url_filter.DAMPING * rank.get(a, 0) * w / out
            rank = after
        for h, r in rank.items():
            want.setdefault(h, [0.0, 0.0])[kind] = r
    for r in got:
        assert (r.trust, r.distrust) == pytest.approx(tuple(want.get(r.host, (0.0, 0.0))))


def test_far_hosts_are_reached(spark):
    """A chain of links longer than the rounds between two looks, and than any fixed number of rounds here."""
    rows = [(0, "http://h0.b/x", "")] + [(i, f"http://h{i}.b/x", f"<a href='//h{i - 1}.b/p'>x</a>") for i in range(1, 14)]
    pages = spark.createDataFrame([*rows, (99, "http://good.a/x", "")], "page_id long, url string, html string")
    got = {r.host: r.verdict for r in url_filter.judge(pages, [("h0.b", "/", "block"), ("good.a", "/", "allow")]).collect()}
    assert got == {f"h{i}.b": "block" for i in range(14)} | {"good.a": "allow"}


def test_ranks_settle_at_the_fixed_point(spark):
    rnd = random.Random(4)
    n = 12
    share = np.zeros((n, n))
    edges = [(f"h{a}", f"h{b}", float(rnd.randint(1, 4))) for a in range(n) for b in rnd.sample(range(n), 2) if a != b]
    for a, b, w in edges:
        share[int(b[1:]), int(a[1:])] += w
    start = np.zeros(n)
    start[:2] = 0.25, 0.75
    got = url_filter.propagate(
        spark.createDataFrame([("h0", 1, 0), ("h1", 3, 0)], "host string, trusted long, blocked long"),
        spark.createDataFrame(edges, "src string, dst string, weight double"),
        rounds=None,
    ).collect()
    share = share / np.maximum(share.sum(axis=0), 1e-9)
    want = np.linalg.solve(np.eye(n) - url_filter.DAMPING * share, (1 - url_filter.DAMPING) * start)
    assert {r.host: r.trust for r in got} == pytest.approx({f"h{i}": x for i, x in enumerate(want) if x > 0}, rel=1e-5)


def test_verdicts_do_not_depend_on_the_number_of_seeds(spark):
    ranks = [("a", 0.0, 1e-12), ("b", 1e-12, 2e-12), ("c", 2e-12, 1e-12), ("d", 1e-12, 1e-12), ("e", 0.2, 0.1 + 0.2), ("f", 0.1 + 0.2, 0.3), ("g", 0.0, 0.0)]
    got = url_filter.by_host(spark.createDataFrame(ranks, "host string, trust double, distrust double")).collect()
    assert {r.host for r in got if r.by_host == "block"} == {"a", "b", "e"} and len(got) == 7


def test_sha_of_loss_is_of_plain_text(spark):
    from quarry.llm.queries import op9_chat_formatting

    row = op9_chat_formatting(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
