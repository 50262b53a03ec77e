"""N-gram Jaccard join: which documents share enough word shingles, by T-occurrence search with DivideSkip.

A document's set has its distinct shingles of ``K`` lower-cased (A-Z) words; with fewer words, the whole sequence as one; without words
none. Two documents link when ``100 * |both| >= PERCENT * |either|``.

1. *List lengths.* Blocks of documents learn for each of their shingles how many blocks have it (an upper bound on exactness: a list of
   one entry can join nobody, and a rare collision of the 32 bits sent only makes a list seem longer). A document with more than
   ``1 - PERCENT`` of its shingles in lists of one has no links and is done. Equal sets go on as one.
2. *Clusters.* Two linked documents share one of the first ``n - ceil(PERCENT n) + 1`` shingles of each, the sets being ordered by length of
   list, shortest first. Documents that share such a shingle, and what is connected by them, form a cluster.
3. *Search.* In each cluster inverted lists are built. For each document the longest lists are put aside (one fewer at most than the
   overlap it needs); its short lists are merged and counted, and the candidates that reach the overlap less the number
   of lists put aside are looked up in those by binary search. Documents that are connected already are not compared again.
4. Clusters of more than ``CHUNK`` shingles are searched in chunks, each along with ``PIVOTS`` documents of the cluster; then
   whatever is not in its largest component is searched against every chunk. So every pair of documents that could link is
   compared, or was found connected.

The links found connect the same documents as all links do. Defined cases: null and empty texts have no set and no link; rows of null id
are returned with a null component and link to nothing; rows of equal id belong together; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import blocks as B
from quarry.llm.components import EDGES, Forest, components
from quarry.llm.shared import written
from quarry.llm.store import release

K, PERCENT, CHUNK, PIVOTS = 5, 75, 1_000_000, 4
SETS = "doc_id long, n_shingles long, digest binary, shingles binary, prefix binary"


def needed(n, percent: int = PERCENT):
    """Least overlap with any set that a set of n shingles can link to."""
    return -(-percent * n // 100)


class Sets:
    """The sets of some texts one after the other: ``values`` (sorted in each text), between ``cuts``."""

    def __init__(self, texts: list[bytes], k: int):
        w = B.Words(texts, lower=True)
        left, count = w.left(), w.to - w.frm
        hashes = w.rolling(k)
        use = left >= k
        for short in range(1, k):  # texts of fewer words: one shingle, of the whole sequence
            whole = w.frm[count == short]
            if len(whole):
                hashes[whole] = B.mix(w.rolling(short)[whole] + np.uint64(short))
                use[whole] = True
        owner = np.repeat(np.arange(len(texts)), count)[use]
        values = hashes[use]
        order = np.lexsort((values, owner))
        owner, values = owner[order], values[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        self.values, self.owner = values[new], owner[new]
        self.cuts = np.searchsorted(self.owner, np.arange(len(texts) + 1))


def squeeze(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The 32 bits after those that name the bucket; together with it they keep the order."""
    return ((keys << np.uint64(buckets.bit_length() - 1)) >> np.uint64(32)).astype("<u4")


def pack(keys: np.ndarray) -> bytes:
    """Sorted 32-bit integers: their steps, byte plane by byte plane, compressed."""
    steps = np.diff(keys, prepend=keys[:1] * 0).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype="<u4")


def list_lengths(sent: DataFrame) -> DataFrame:
    """For each array of keys: how many blocks sent each key (255 at most)."""

    def meet(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("keys").to_pylist()]
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        counts = np.minimum(counts, 255).astype(np.uint8)
        packer = zstandard.ZstdCompressor(level=1)
        answers = [packer.compress(counts[np.searchsorted(values, p)].tobytes()) for p in parts]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "lengths": pa.array(answers, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(meet, "block int, bucket int, lengths binary")


def sets(docs: DataFrame, k: int = K, percent: int = PERCENT, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles, digest of the set; and for one of each equal set of a block that may have links: its shingles in
    the order of the lists' lengths, and those of its prefix that are in lists of more than one."""
    placed, n = B.in_blocks(docs.select("doc_id", "text"), block_bytes)
    grouped = placed.select("doc_id", "text", "block").groupBy("block")
    buckets = B.buckets_for(n)

    def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys as they are sent, and the bucket of each."""
        keys = np.unique(values)
        small, bucket = squeeze(keys, buckets), B.bucket_of(keys, buckets)
        new = np.ones(len(keys), bool)
        new[1:] = (small[1:] != small[:-1]) | (bucket[1:] != bucket[:-1])
        return small[new], bucket[new]

    def send(table: pa.Table) -> pa.Table:
        small, bucket = distinct(Sets(B.texts_of(table), k).values)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(cuts))
        return pa.table(
            {
                "block": pa.array(np.full(len(used), table.column("block")[0].as_py()), pa.int32()),
                "bucket": pa.array(used, pa.int32()),
                "keys": pa.array([pack(small[cuts[i] : cuts[i + 1]]) for i in used], pa.binary()),
            }
        )

    def choose(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = Sets(B.texts_of(table), k)
        answers = answers.sort_by("bucket")
        opener = zstandard.ZstdDecompressor()
        lengths = np.frombuffer(b"".join(opener.decompress(x) for x in answers.column("lengths").to_pylist()), np.uint8)
        small, bucket = distinct(own.values)
        joint = (bucket.astype(np.uint64) << np.uint64(32)) | small
        mine = (B.bucket_of(own.values, buckets).astype(np.uint64) << np.uint64(32)) | squeeze(own.values, buckets)
        length = lengths[np.searchsorted(joint, mine)]
        values, back, counts = np.unique(own.values, return_inverse=True, return_counts=True)
        shared = (length > 1) | (counts[back] > 1)
        columns: list[list] = [[], [], [], [], []]
        seen: set[bytes] = set()
        rows = sorted(
            zip(table.column("doc_id").to_pylist(), own.cuts[:-1].tolist(), own.cuts[1:].tolist(), strict=True),
            key=lambda x: (x[0] is None, x[0] or 0),
        )
        for doc_id, a, b in rows:
            size = b - a
            digest = xxhash.xxh128_digest(own.values[a:b].tobytes()) if size else None
            shingles = prefix = None
            if size and doc_id is not None and digest not in seen and int(shared[a:b].sum()) >= needed(size, percent):
                seen.add(digest)
                order = a + np.lexsort((own.values[a:b], length[a:b]))
                first = order[: size - needed(size, percent) + 1]
                shingles, prefix = B.plain(own.values[order]), B.plain(own.values[first[shared[first]]])
            for column, value in zip(columns, (doc_id, size, digest, shingles, prefix), strict=True):
                column.append(value)
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        names = ["doc_id", "n_shingles", "digest", "shingles", "prefix"]
        release()
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    answers = list_lengths(grouped.applyInArrow(send, B.KEYS)).groupBy("block")
    return grouped.cogroup(answers).applyInArrow(choose, SETS)


def divide_skip(
    ids: list[int], members: list[np.ndarray], mine: np.ndarray, known: list[int | None], percent: int = PERCENT
) -> list[tuple[int, int]]:
    """Links that connect the documents as all links would, between documents of which ``mine`` marks one at least;
    documents of the same ``known`` are connected already."""
    by_size = sorted(range(len(ids)), key=lambda i: (len(members[i]), ids[i]))
    ids, members, mine = [ids[i] for i in by_size], [members[i] for i in by_size], mine[by_size]
    known = [known[i] for i in by_size]
    sizes = np.array([len(m) for m in members])
    values = np.concatenate(members)
    owner = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    length = np.diff(np.append(new, len(values)))
    #: for each entry of ``members``, one after the other, its list
    place = np.empty(len(order), np.int64)
    place[order] = np.repeat(np.arange(len(new)), length)
    starts = np.cumsum(sizes) - sizes
    forest, links = Forest(), []
    of_known: dict[int, int] = {}
    for i, name in enumerate(known):
        if name is not None:
            forest.join(i, of_known.setdefault(name, i))
    roots = lambda: np.array([forest.root(i) for i in range(len(ids))])
    group = roots()
    for x in np.flatnonzero(mine).tolist():
        # nothing to find where all are connected, or for a set in lists of one only
        if not (group != group[x]).any():
            break
        least = needed(int(sizes[x]), percent)
        lists = place[starts[x] : starts[x] + sizes[x]]
        lists = lists[length[lists] > 1]
        if len(lists) < least:
            continue
        lists = lists[np.argsort(length[lists], kind="stable")]
        aside = min(least - 1, len(lists) - 1)
        short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
        # sorted lists one after the other, merged as runs
        merged = np.sort(np.concatenate([owner[new[i] : new[i] + length[i]] for i in short]), kind="stable")
        found, count = np.unique(merged, return_counts=True)
        fits = (count >= least - aside) & (100 * sizes[found] >= percent * sizes[x]) & (100 * sizes[x] >= percent * sizes[found])
        fits &= group[found] != group[x]
        found, count = found[fits], count[fits]
        for at, i in enumerate(long):
            if not len(found):
                break
            entries = owner[new[i] : new[i] + length[i]]
            count = count + (entries[np.minimum(np.searchsorted(entries, found), len(entries) - 1)] == found)
            reach = count + (len(long) - 1 - at) >= least
            found, count = found[reach], count[reach]
        linked = found[100 * count >= percent * (sizes[x] + sizes[found] - count)]
        changed = [forest.join(x, int(y)) for y in linked]
        links += [(ids[x], ids[int(y)]) for y, c in zip(linked, changed, strict=True) if c]
        if any(changed):
            group = roots()
    return links


def search(tasks: DataFrame, keys: list[str], percent: int = PERCENT) -> DataFrame:
    """Links (a, b) within groups of (doc, shingles, mine, known): ``known`` names what is connected already."""

    def run(table: pa.Table) -> pa.Table:
        # a document may have come twice: once to be asked about, once to be found
        best: dict[int, tuple[bytes, bool, int | None]] = {}
        for doc, raw, mine, known in zip(*(table.column(c).to_pylist() for c in ("doc", "shingles", "mine", "known")), strict=True):
            best[doc] = (raw, mine or (doc in best and best[doc][1]), known)
        members = [np.frombuffer(x[0], "<u8") for x in best.values()]
        mine, known = np.array([x[1] for x in best.values()]), [x[2] for x in best.values()]
        found = np.array(divide_skip(list(best), members, mine, known, percent), np.int64).reshape(-1, 2)
        release()
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return tasks.groupBy(*keys).applyInArrow(run, EDGES)


def keys_of(column: str) -> Column:
    """array<binary> of a column of 8-byte keys."""
    n = F.floor(F.octet_length(column) / 8).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substring(F.col(column), i * 8 + 1, F.lit(8)))


def linked(prefixes: DataFrame, sets_of: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that connect documents as all links would, from (doc, prefix) and (doc, shingles), no two sets being equal.

    They are written: a task that searches and contracts edges at once would hold two Python workers."""
    prefix = prefixes.select("doc", F.explode(keys_of("prefix")).alias("key"))
    leader = prefix.groupBy("key").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    cluster = components(prefix.join(leader, "key").where("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b")))
    of = cluster.select(F.col("node").alias("doc"), F.col("component").alias("cluster"))
    size = F.octet_length("shingles") / 8
    weighed = sets_of.select("doc", size.alias("size")).join(of, "doc").groupBy("cluster").agg(F.ceil(F.sum("size") / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int").alias("chunk")
    placed = written(of.join(weighed, "cluster").select("doc", "cluster", "chunks", chunk), "clusters")
    members = sets_of.join(placed, "doc").select("doc", "shingles", "cluster", "chunk", F.lit(True).alias("mine"), F.lit(None).cast("long").alias("known"))
    large = placed.where("chunks > 1")
    if not large.limit(1).count():
        return written(search(members, ["cluster", "chunk"], percent), "links")
    # a few documents of each large cluster go to all of its chunks
    least = [F.min_by("doc", F.xxhash64(F.lit(i), "doc")) for i in range(PIVOTS)]
    pivots = large.groupBy("cluster", "chunks").agg(F.array_distinct(F.array(*least)).alias("docs"))
    pivots = pivots.select("cluster", "chunks", F.explode("docs").alias("doc"))
    everywhere = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    copies = sets_of.join(pivots, "doc").select("doc", "shingles", "cluster", everywhere, F.lit(True).alias("mine"), F.lit(None).cast("long").alias("known"))
    links = written(search(members.unionByName(copies), ["cluster", "chunk"], percent), "links")
    # what is not in the largest component of its cluster, against every chunk of it
    labelled = large.join(components(links), F.col("doc") == F.col("node"), "left").select(
        "doc", "cluster", "chunk", "chunks", F.coalesce("component", "doc").alias("known")
    )
    counted = labelled.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("cluster").agg(F.max_by("known", F.struct("n", "known")).alias("largest"))
    part = F.pmod(F.xxhash64(F.lit("rest"), "doc"), F.col("chunks")).cast("int").alias("part")
    rest = written(labelled.join(largest, "cluster").where("known <> largest").select("doc", "cluster", "known", part, "chunks"), "rest")
    asked = sets_of.join(rest, "doc").select("doc", "shingles", "cluster", everywhere, "part", F.lit(True).alias("mine"), "known")
    parts = rest.select("cluster", "part").distinct()
    others = sets_of.join(labelled.join(parts, "cluster"), "doc").select("doc", "shingles", "cluster", "chunk", "part", F.lit(False).alias("mine"), "known")
    return links.unionByName(written(search(asked.unionByName(others), ["cluster", "chunk", "part"], percent), "links"))


def jaccard_join(docs: DataFrame, k: int = K, percent: int = PERCENT, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included)."""
    made = written(sets(docs, k, percent, block_bytes), "sets")
    rows = made.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    first = written(rows.groupBy("digest").agg(F.min("doc_id").alias("doc")), "representatives")
    reps = made.where("shingles IS NOT NULL").join(first, "digest").where("doc_id = doc")
    # rows of one id belong together, whatever their texts
    several = rows.groupBy("doc_id").agg(F.min("digest").alias("d"), F.max("digest").alias("e")).where("d <> e").select("doc_id")
    tied = rows.select("doc_id", "digest").join(several, "doc_id").join(first, "digest").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    found = components(linked(reps.select("doc", "prefix"), reps.select("doc", "shingles"), percent).unionByName(tied))
    return (
        made.select("doc_id", "n_shingles", "digest")
        .join(first, "digest", "left")
        .join(found, F.col("doc") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id")).alias("component_id"))
    )
