"""Differential tests on random inputs, each run as one batched job."""

import random
import re
from urllib.parse import urljoin

import duckdb
from pyspark.sql import functions as F

from quarry.functions.html import resolve_url
from quarry.functions.porter import stem
from quarry.functions.text import tokenize
from quarry.plans.porter_sql import porter_sql

ALPHABET = list("abcxyz ABC 019 _ ' ’ . , ! ? - \t\n éüßñçø ΣσςЖж 中文 ٣ ½") + ["́", " "]


def test_tokenizer_matches_python_word_pattern(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = {r.i: r.x for r in df.select("i", tokenize(F.col("t")).alias("x")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == re.findall(r"\b[\w']+\b", t), repr(t)


SUFFIXES = [
    "", "s", "es", "ies", "sses", "ed", "ied", "eed", "ing", "y", "ly", "ational", "tional", "enci", "anci", "izer",
    "bli", "alli", "entli", "eli", "ousli", "ization", "ation", "ator", "alism", "iveness", "fulness", "ousness",
    "aliti", "iviti", "biliti", "fulli", "logi", "icate", "ative", "alize", "iciti", "ical", "ful", "ness", "al",
    "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "sion", "tion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize", "e", "ll", "at", "bl", "iz",
]


def test_python_and_sql_stemmers_agree():
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = set()
    while len(words) < 6000:
        stem_len = rng.randint(0, 6)
        base = "".join(rng.choice("aeiouy" if rng.random() < 0.4 else letters) for _ in range(stem_len))
        words.add(base + rng.choice(SUFFIXES))
    con = duckdb.connect()
    con.execute("CREATE TABLE w(w VARCHAR)")
    con.execute("INSERT INTO w SELECT unnest(?)", [sorted(words)])
    got = dict(con.sql(f"SELECT w, {porter_sql('w')} FROM w").fetchall())
    bad = [(w, got[w], stem(w)) for w in sorted(words) if got[w] != stem(w)]
    assert not bad, bad[:10]


def test_resolve_url_matches_urljoin(spark):
    rng = random.Random(3)
    segs = ["a", "b", "..", ".", "", "x.htm", "é"]
    bases = ["https://e.org/d/p.htm?z#k", "http://h.net", "http://h.net/", "https://e.org/a/b/c/", "http://s.io/x?q=1"]
    refs = []
    for _ in range(2000):
        path = "/".join(rng.choice(segs) for _ in range(rng.randint(1, 4)))
        lead = rng.choice(["", "/", "./", "../", "//h2/"])
        tail = rng.choice(["", "?q", "?a=1&b=2", "#f", "?q#f"])
        ref = (lead + path + tail) or "x"
        refs.append((rng.choice(bases), ref))
    df = spark.createDataFrame(refs, "b string, h string")
    got = [r.u for r in df.select(resolve_url(F.col("b"), F.col("h")).alias("u")).collect()]
    bad = [(b, h, g, urljoin(b, h)) for (b, h), g in zip(refs, got) if g != urljoin(b, h)]
    assert not bad, bad[:10]


class _TextNodes:
    """Text nodes, first title and <a href> values via the standard-library parser."""

    def __init__(self, html):
        from html.parser import HTMLParser

        nodes, hrefs, title, stack = [], [], [], []

        class P(HTMLParser):
            def handle_starttag(self, tag, attrs):
                stack.append(tag)
                if tag == "a":
                    for k, v in attrs:
                        if k == "href" and v is not None:
                            hrefs.append(v.strip())
                            break

            def handle_endtag(self, tag):
                if tag in stack:
                    while stack and stack.pop() != tag:
                        pass

            def handle_data(self, data):
                if stack and stack[-1] in ("script", "style", "template"):
                    return
                if stack and stack[-1] == "title" and not title:
                    title.append(data)
                if data.strip():
                    nodes.append(data.strip())

        P(convert_charrefs=True).feed(html)
        self.body = " ".join(nodes)
        self.title = title[0] if title else ""
        self.hrefs = [h for h in hrefs if h and not h.startswith("javascript:")]


def test_html_extraction_matches_stdlib_parser(spark):
    from conftest import SF001
    from quarry.functions.html import extract_body, extract_hrefs, extract_title
    from quarry.sources.corpus import read_table

    rows = read_table(spark, SF001, "pages").select(
        "html", extract_title(F.col("html")).alias("t"), extract_body(F.col("html")).alias("b"),
        extract_hrefs(F.col("html")).alias("h"),
    ).collect()
    assert len(rows) == 250
    for r in rows:
        ref = _TextNodes(r.html)
        assert r.t == ref.title
        assert r.h == ref.hrefs
        assert re.findall(r"\b[\w']+\b", r.b) == re.findall(r"\b[\w']+\b", ref.body)


def test_long_junk_token_does_not_overflow(spark):
    from quarry.functions.text import tokenize

    text = "x " + "a'" * 100000 + "b end"
    got = spark.createDataFrame([(text,)], "t string").select(F.size(tokenize(F.col("t"))).alias("n")).first().n
    assert got == len(re.findall(r"\b[\w']+\b", text)) == 3
