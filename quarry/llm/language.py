"""Language identification by compression: the language whose dictionary compresses a text smallest.

Every language gets a zstandard raw-content dictionary of the words of its labelled texts, the most frequent ones last, where
they are found first. Words, not excerpts: else passages that many documents share would decide. A whole text, as its
lower-cased words of letters, is compressed with each dictionary, in segments of ``SEGMENT`` bytes that each start from the
dictionary, as it would soon be forgotten in a long text; the smallest sum of the segments' sizes names the language
(ties: the first in alphabetical order), and the margin ``1 - smallest / second smallest`` is its score. A text is rejected
where the margin is narrower than ``MIN_MARGIN``.

The dictionaries come from a bounded sample: of each language the ``SAMPLE_DOCS`` distinct labelled texts of lowest hash (all where it
has fewer), ``EXCERPT`` characters of each from its beginning to its end, at most ``DICT_BYTES`` of words. Every text is then
classified whole.

Defined cases: a null text, or one without a letter, is ``und``, rejected, score 0; rows without a label teach nothing; with no
labelled row at all every document is ``und``; with one language its score is 0 and nothing with a letter is rejected; null or
repeated ids and other columns change nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import chunks
from quarry.llm.store import release

SAMPLE_DOCS, EXCERPT, PARTS, DICT_BYTES = 400, 2_000, 4, 64_000
#: Words seen less often in the sample are left out of a dictionary; narrowest margin that is accepted.
MIN_COUNT, MIN_MARGIN = 2, 0.002
UNKNOWN = "und"
#: Goes before every text: without it the library would store a short text as it is, whatever the dictionary.
LEAD = b"\n" * 64
#: Segments end between words (a word that is longer than a segment is cut).
SEGMENT = 16 << 10
LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def segments(raw: bytes) -> Iterator[bytes]:
    """Words that are joined by spaces, in runs of at most ``SEGMENT`` bytes."""
    start = 0
    while len(raw) - start > SEGMENT:
        space = raw.rfind(b" ", start, start + SEGMENT + 1)
        end = space if space > start else start + SEGMENT
        yield raw[start:end]
        start = end + (space > start)
    yield raw[start:]


def parameters() -> zstandard.ZstdCompressionParameters:
    """Short matches, as syllables tell languages apart."""
    return zstandard.ZstdCompressionParameters(
        window_log=19,
        chain_log=16,
        hash_log=16,
        search_log=3,
        min_match=4,
        target_length=16,
        strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False,
    )


def fit(labelled: DataFrame) -> dict[str, bytes]:
    """Dictionaries from (text, lang) rows. Only the bounded sample reaches the driver."""
    taught = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = taught.select("lang", F.xxhash64("text").alias("h"), spread(F.col("text")).alias("text"))
    # a bound on the hash first, so that few excerpts are shuffled: about 4 x SAMPLE_DOCS of the languages that have more
    # distinct texts. It only narrows the search: where fewer are found below it, it is raised. One number per language
    # reaches the driver.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    shares = {lang: 4 * SAMPLE_DOCS / max(n, 1) for lang, n in sizes.items()}
    sample: dict[str, list[str]] = {}
    while shares:
        found = lowest(rows, shares)
        sample |= {lang: found.get(lang, []) for lang, share in shares.items() if share >= 1 or len(found.get(lang, [])) == SAMPLE_DOCS}
        shares = {lang: 16 * share for lang, share in shares.items() if lang not in sample}
    counts: dict[str, Counter] = {}
    for lang, texts in sample.items():
        counts[lang] = Counter(word for text in texts for word in words(text))
    return {lang: dictionary(c) for lang, c in counts.items()}


def spread(text: Column) -> Column:
    """A text of at most ``EXCERPT`` characters, or ``PARTS`` excerpts from its beginning to its end, ``EXCERPT`` together."""
    size, n = EXCERPT // PARTS, F.length(text)
    starts = [F.floor((n - size) * i / (PARTS - 1)).cast("int") + 1 for i in range(PARTS)]
    return F.when(n <= EXCERPT, text).otherwise(F.concat_ws(" ", *[F.substring(text, at, F.lit(size)) for at in starts]))


def lowest(rows: DataFrame, shares: dict[str, float]) -> dict[str, list[str]]:
    """Of each language in ``shares`` the ``SAMPLE_DOCS`` texts of lowest hash, among that share of all hashes. ``rows``: lang, h, text;
    copies are one row per task before they are shuffled."""
    bounds = {lang: -(2**63) + min(2**64 - 1, int(share * 2**64)) for lang, share in shares.items()}
    bound = F.create_map(*[x for lang, most in bounds.items() for x in (F.lit(lang), F.lit(most).cast("long"))])
    near = rows.where(F.col("h") <= F.element_at(bound, F.col("lang"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    found: dict[str, list[str]] = {}
    for row in near.withColumn("r", rank).where(F.col("r") <= SAMPLE_DOCS).collect():
        found.setdefault(row["lang"], []).append(row["text"])
    return found


def dictionary(counts: Counter) -> bytes:
    kept, size, least = [], 0, min(MIN_COUNT, max(counts.values(), default=0))
    for word, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        size += len(word.encode()) + 1
        if n < least or size > DICT_BYTES:
            break
        kept.append(word)
    return " ".join(reversed(kept)).encode()


def classify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """Add lang_pred, score and rejected to ``docs``."""
    return _named(docs, _judged(docs, dictionaries), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    return _named(docs, _judged(docs, dictionaries).where(~F.col("rejected")))


def _named(docs: DataFrame, judged: DataFrame, *more: str) -> DataFrame:
    return judged.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(docs.columns)], *more)


def _judged(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``docs`` with its columns renamed k_0, k_1, ..., and the verdict."""
    names = sorted(dictionaries)
    kept = [F.col(f"`{c}`").alias(f"k_{i}") for i, c in enumerate(docs.columns)]
    lettered = docs.select(*kept, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    place = docs.columns.index("text")
    fields = ", ".join(f"k_{i} {t.dataType.simpleString()}" for i, t in enumerate(docs.schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = []
        for name in names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=parameters())
            packers.append(zstandard.ZstdCompressor(dict_data=d, compression_params=parameters()))

        def judge(text: str | None) -> tuple[str, float, bool]:
            if text is None or not names:
                return UNKNOWN, 0.0, True
            parts = [LEAD + part for part in segments(" ".join(words(text)).encode())]
            sizes = sorted((sum(len(p.compress(part)) for part in parts), i) for i, p in enumerate(packers))
            if len(sizes) == 1:
                return names[0], 0.0, False
            score = 1 - sizes[0][0] / sizes[1][0]
            return names[sizes[0][1]], score, score < MIN_MARGIN

        for batch in (part for whole in batches for part in chunks(whole, f"k_{place}")):
            texts = zip(batch.column(place).to_pylist(), batch.column("lettered").to_pylist(), strict=True)
            lang, score, rejected = zip(*(judge(t if has else None) for t, has in texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected"],
            )
        release()

    return lettered.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Rows kept for measuring: crc32 of the id as text is divisible by 5 (null ids teach nothing either)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))
