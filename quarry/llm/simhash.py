"""Document fingerprints [DataFrame functions only]: SimHash, and permuted block tables that find near ones.

A text's terms are its pairs of adjacent words (and its last word alone); words are what white space parts. The
64-bit hash of each term votes on the 64 bits of the fingerprint, with a weight that grows with the first word's length (1
to 5), once for each time that it occurs. A bit is set where the votes for it exceed those against. Votes are summed
in the task that reads the text, so one row per text is shuffled.

``within_radius`` finds all fingerprints up to ``radius`` bits away from queried ones. The 64 bits are cut into ``BLOCKS`` blocks;
two fingerprints within the radius agree on at least ``BLOCKS - radius`` of them, so there is a table for each choice of that
many blocks, keyed by those bits (20 tables of 32 bits or more). A pair is kept in the first table that it meets in.

Defined cases: null text counts as empty; a text without words has fingerprint 0; equal texts have equal fingerprints whatever their ids;
repeated rows are kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.util import dense_index

BITS, BLOCKS, RADIUS = 64, 6, 3
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def weight(word: Column) -> Column:
    """Number of binary digits of the word's length, 5 at most."""
    n = F.length(word)
    out = F.lit(1)
    for limit in (1, 3, 7, 15):
        out = out + (n > limit).cast("int")
    return out


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, copies, fingerprint (long): one row per distinct ``keys``, which must determine the text."""
    w = texts.select(*keys, words(F.coalesce(F.col(text), F.lit(""))).alias("w"))
    term = F.transform(
        "w", lambda x, i: F.struct(F.xxhash64(x, F.get(F.col("w"), i + 1)).alias("hash"), weight(x).alias("weight"))
    )
    terms = w.select(*keys, F.posexplode_outer(term).alias("term_at", "term")).select(
        *keys,
        F.coalesce("term_at", F.lit(0)).alias("term_at"),
        F.col("term.hash").alias("term_hash"),
        F.coalesce(F.col("term.weight"), F.lit(0)).cast("long").alias("term_weight"),
    )
    n = F.col("term_weight")
    voted = terms.groupBy(*keys).agg(
        F.sum((F.col("term_at") == 0).cast("long")).alias("copies"),
        *[F.sum(F.when(F.col("term_hash").bitwiseAND(F.lit(bit(b))) != 0, n).otherwise(-n)).alias(f"v{b}") for b in range(BITS)],
    )
    parts = [F.when(F.col(f"v{b}") > 0, F.lit(bit(b))).otherwise(F.lit(0).cast("long")) for b in range(BITS)]
    while len(parts) > 1:
        parts = [a.bitwiseOR(b) for a, b in zip(parts[::2], parts[1::2], strict=True)]
    return voted.select(*keys, "copies", parts[0].alias("fingerprint"))


def bit(b: int) -> int:
    """1 << b as a signed 64-bit integer."""
    return (1 << b) - (1 << 64 if b == 63 else 0)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def tables(blocks: int = BLOCKS, radius: int = RADIUS) -> list[tuple[int, list[int]]]:
    """For each choice of ``blocks - radius`` blocks: the mask of its bits, and the masks of the blocks passed over."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    mask = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    return [
        (sum(mask[i] for i in chosen), [signed(mask[i]) for i in range(chosen[-1]) if i not in chosen])
        for chosen in combinations(range(blocks), blocks - radius)
    ]


def within_radius(queries: DataFrame, data: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (query, fingerprint) of distinct longs at most ``radius`` bits apart, from column ``fingerprint`` of each side."""
    masks = F.array(
        *[
            F.struct(
                F.lit(i).alias("table"),
                F.lit(signed(m)).alias("mask"),
                F.array(*map(F.lit, skipped)).cast("array<long>").alias("skipped"),
            )
            for i, (m, skipped) in enumerate(tables(blocks, radius))
        ]
    )

    def keyed(df: DataFrame, name: str) -> DataFrame:
        exploded = df.select(F.col("fingerprint").alias(name)).distinct().select(name, F.explode(masks).alias("m"))
        key = F.col(name).bitwiseAND(F.col("m.mask")).alias("key")
        return exploded.select(name, F.col("m.table").alias("table"), key, F.col("m.skipped").alias(f"{name}_skipped"))

    q, d = keyed(queries, "query"), keyed(data, "fingerprint").drop("fingerprint_skipped")
    differing = F.col("query").bitwiseXOR(F.col("fingerprint"))
    first = F.forall("query_skipped", lambda m: differing.bitwiseAND(m) != 0)
    near = F.bit_count(differing) <= radius
    met = q.join(d, (q["table"] == d["table"]) & (q["key"] == d["key"]) & first & near)
    return met.select("query", "fingerprint")


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, k, next_id: the next lower id (after the lowest: the highest), and how many characters a third of the text is.

    One row per distinct id; rows that share an id have the same next document."""
    ids = docs.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 3)).cast("int").alias("k"))
    ranked = dense_index(ids, [F.col("doc_id").desc_nulls_last()], "r")
    last = ranked.agg(F.max("r")).first()[0] or 0
    before = F.when(F.col("r") == 1, F.lit(last)).otherwise(F.col("r") - 1)
    return ranked.join(ranked.select(before.alias("r"), F.col("doc_id").alias("next_id")), "r").drop("r")


def edited(docs: DataFrame, near: DataFrame) -> DataFrame:
    """docs (doc_id, text) with edited: the last third replaced by as many first characters of the next document.

    Of rows that share an id, the one whose text has the least hash stands for the next document. Only as much of a text as is
    wanted goes to its neighbour; the documents themselves are shuffled once, by id."""
    hashed = docs.withColumn("h", F.xxhash64("text"))
    giver = near.select(F.col("next_id").alias("giver"), F.col("doc_id").alias("taker"), "k")
    given = hashed.join(giver, F.col("doc_id").eqNullSafe(F.col("giver"))).select("taker", "h", F.expr("substring(text, 1, k)").alias("gift"))
    gift = given.groupBy("taker").agg(F.min_by("gift", "h").alias("gift"))
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    whole = F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("gift"), F.lit(1), k))
    return hashed.join(gift, F.col("doc_id").eqNullSafe(F.col("taker"))).select("doc_id", "text", "h", whole.alias("edited"))
