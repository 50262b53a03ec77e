"""Main text of pages by wrapper induction: what is alike in the pages of a host is its template, what varies is content.

1. Every page becomes its text blocks and its tree (``dom.py``), without elements that are never part of an article.
2. The distinct trees of a host are aligned by simple tree matching (most nodes matched, order and ancestry kept) and merged, in
   groups of ``GROUP``, then the merged trees in groups again, until a host has one. Merged trees count the pages of every node and lose
   nodes of fewer than ``RARE`` of them, so their size is bounded by that of the pages' trees.
3. Every page is aligned with its host's tree. A text that stands at the same node in at least ``SHARE`` of the host's pages, and in
   ``EVIDENCE`` at least, is template; all others fill varying slots. Pages of one content count once, so copies are no evidence.
4. A page's text are the varying blocks of its article: those in ``article`` or ``main`` elements (the largest and others of a
   quarter of its size) if there are any, else all that are left, without lists and blocks of links. Where most of the text of
   a host's pages would be template, they are near copies and keep all; so do a page that would keep nothing and one without host.

Trees are counted per host, and texts per host and node, before they are shuffled; a host's merged tree and its template texts (each
in most of its pages, so they are few) are joined to its pages, which the engine broadcasts or splits by size.

Defined cases: null or empty html has an empty text; a null url, or one without ``://``, has no host and no template; unclosed,
misnested and cut off markup is read as far as it goes; repeated rows have a text each; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.dom import Block, Node, read
from quarry.llm.shared import chunks, written
from quarry.llm.url_filter import host_of

GROUP, RARE, SHARE, EVIDENCE = 64, 0.05, 0.8, 3
PART = 0.25  # of the largest article
LINKED = 0.6
COPIES = 0.5  # template's share of the text of a host of copies
SKELETON = "host string, content long, tree string, nodes array<int>, texts array<long>, sizes array<int>"
#: a tree: [label, pages, [children]]
Tree = list


def blocks_of(html: str | None) -> tuple[Node, list[Block], list[str]]:
    """The page without what is never part of an article; the nodes of its tree are numbered in page order."""
    root, blocks, regions = read(html or "")
    kept = [b for b in blocks if not b.drop]
    if not kept:  # an article in a form, say
        kept = [b for b in blocks if b.drop == "soft"]
    return root, kept, regions


def tree_of(root: Node, blocks: list[Block]) -> str:
    """The tree as text, of the nodes that hold blocks; numbers these nodes."""
    holds = {id(b.node) for b in blocks}
    number = 0

    def keep(node: Node) -> list | None:
        nonlocal number
        node.number, number = number, number + 1
        before = number
        children = [c for c in map(keep, node.children.values()) if c is not None]
        if not children and id(node) not in holds:
            number = before - 1
            return None
        return [node.label, children]

    return json.dumps(keep(root) or ["", []], ensure_ascii=False, separators=(",", ":"))


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def matching(a: Tree, b: Tree) -> tuple[int, list]:
    """Simple tree matching of trees of equal label: (nodes matched, the matched pairs of children with theirs)."""
    ours, theirs = a[2], b[2]
    if not ours or not theirs:
        return 1, []
    labels: dict[str, list[int]] = {}
    for j, child in enumerate(theirs):
        labels.setdefault(child[0], []).append(j)
    # the heaviest increasing chain of pairs, by the place in the other tree
    best: list[tuple[int, tuple | None]] = [(0, None)] * (len(theirs) + 1)
    for i, child in enumerate(ours):
        new = None
        for j in labels.get(child[0], ()):
            n, pairs = matching(child, theirs[j])
            before, chain = max(best[: j + 1], key=lambda x: x[0])
            if before + n > best[j + 1][0]:
                new = new or list(best)
                new[j + 1] = (before + n, (chain, i, j, pairs))
        best = new or best
    weight, chain = max(best, key=lambda x: x[0])
    found = []
    while chain is not None:
        chain, i, j, pairs = chain
        found.append((i, j, pairs))
    return weight + 1, found[::-1]


def merge(a: Tree, b: Tree, pairs: list | None = None) -> Tree:
    """Both trees as one; nodes that only one has stay where it has them."""
    if pairs is None:
        pairs = matching(a, b)[1]
    children, i, j = [], 0, 0
    for x, y, below in [*pairs, (len(a[2]), len(b[2]), None)]:
        children += a[2][i:x] + b[2][j:y]
        if below is not None:
            children.append(merge(a[2][x], b[2][y], below))
        i, j = x + 1, y + 1
    return [a[0], a[1] + b[1], children]


def counted(tree: list, pages: int) -> Tree:
    return [tree[0], pages, [counted(c, pages) for c in tree[1]]]


def without_rare(tree: Tree, least: float) -> Tree:
    return [tree[0], tree[1], [without_rare(c, least) for c in tree[2] if c[1] >= least]]


@lru_cache(maxsize=4096)
def aligned(template: str, tree: str) -> tuple[int, ...]:
    """For each node of the page's tree, in page order, its node in the template, or -1."""
    whole, page = json.loads(template), counted(json.loads(tree), 1)
    where: list[int] = []

    def size(t: Tree) -> int:
        return 1 + sum(map(size, t[2]))

    def walk(t: Tree | None, p: Tree, at: int, pairs: list) -> None:
        where.append(at if t is not None else -1)
        partner = {j: (i, below) for i, j, below in pairs}
        starts = []
        if t is not None:
            at += 1
            for child in t[2]:
                starts.append(at)
                at += size(child)
        for j, child in enumerate(p[2]):
            i, below = partner.get(j, (None, []))
            walk(None if i is None else t[2][i], child, -1 if i is None else starts[i], below)

    walk(whole, page, 0, matching(whole, page)[1])
    return tuple(where)


def skeletons(pages: DataFrame) -> DataFrame:
    """host, content (hash), tree, and the distinct (node, hash and size of text) of its blocks, for every page of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                out = []
                for html in part.column("html").to_pylist():
                    root, blocks, _ = blocks_of(html)
                    tree = tree_of(root, blocks)
                    seen = dict.fromkeys((b.node.number, text_hash(b.text), len(b.text)) for b in blocks)
                    content = xxhash.xxh64_intdigest(tree + repr([text_hash(b.text) for b in blocks])) - (1 << 63)
                    out.append((content, tree, *([k[i] for k in seen] for i in range(3))))
                contents, trees, nodes, texts, sizes = zip(*out, strict=True)
                lists = ((nodes, pa.int32()), (texts, pa.int64()), (sizes, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("host"), pa.array(contents, pa.int64()), pa.array(trees, pa.string()), *(pa.array(c, pa.list_(t)) for c, t in lists)],
                    names=["host", "content", "tree", "nodes", "texts", "sizes"],
                )

    hosted = pages.select(host_of(F.col("url")).alias("host"), "html").where("host <> '' AND html IS NOT NULL")
    return written(hosted.mapInArrow(run, SKELETON).dropDuplicates(["host", "content"]), "skeletons")


def merged(table: pa.Table) -> pa.Table:
    """The trees of a group of a host as one."""
    rows = sorted(zip(table.column("tree").to_pylist(), table.column("pages").to_pylist(), strict=True))
    whole = None
    for text, pages in rows:
        tree = json.loads(text)
        tree = tree if len(tree) == 3 else counted(tree, pages)
        whole = tree if whole is None else merge(whole, tree)
    whole = without_rare(whole, RARE * whole[1])
    text = json.dumps(whole, ensure_ascii=False, separators=(",", ":"))
    return pa.table({"host": [table.column("host")[0].as_py()], "tree": [text], "pages": pa.array([whole[1]], pa.int64())})


def templates(found: DataFrame) -> DataFrame:
    """host, tree, pages: the merged tree of every host of skeletons, and how many different pages it has."""
    trees = written(found.groupBy("host", "tree").agg(F.count(F.lit(1)).alias("pages")), "trees")
    while True:
        counts = trees.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
        dealt = trees.join(counts, "host").withColumn("part", F.pmod(F.xxhash64("tree"), F.col("groups")))
        last = counts.agg(F.max("groups")).first()[0]
        trees = dealt.select("host", "part", "tree", "pages").groupBy("host", "part").applyInArrow(merged, "host string, tree string, pages long")
        trees = written(trees, "templates")
        if last is None or last == 1:
            return trees


def wrappers(pages: DataFrame) -> DataFrame:
    """host, template (its merged tree) and the template texts: nodes, texts; hosts without any are left out."""
    found = skeletons(pages)
    whole = templates(found)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts: list[str] = []
            found: list[tuple[int, int, int]] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("host", "template", "tree", "nodes", "texts", "sizes")), strict=True)
            for host, template, tree, at, hashes, sizes in rows:
                where = aligned(template, tree)
                slots = {(where[n], h, size) for n, h, size in zip(at, hashes, sizes, strict=True)}
                hosts += [host] * len(slots)
                found += slots
            nodes, texts, lengths = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(nodes, pa.int32()), pa.array(texts, pa.int64()), pa.array(lengths, pa.int64())],
                names=["host", "node", "text", "size"],
            )

    # only hosts with enough pages can have template texts
    enough = whole.where(F.col("pages") >= EVIDENCE).select("host", F.col("tree").alias("template"), "pages")
    slots = found.join(enough.drop("pages"), "host").select("host", "template", "tree", "nodes", "texts", "sizes")
    slots = slots.mapInArrow(align, "host string, node int, text long, size long")
    texts = slots.groupBy("host", "node", "text").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    texts = texts.join(enough.select("host", "pages"), "host")
    common = (F.col("node") >= 0) & (F.col("n") >= EVIDENCE) & (F.col("n") >= SHARE * F.col("pages"))
    texts = written(texts.withColumn("common", common), "texts")
    chars = F.col("n") * F.col("size")
    share = texts.groupBy("host").agg((F.sum(F.when(F.col("common"), chars).otherwise(0)) / F.sum(chars)).alias("share"))
    common = texts.where("common").join(share.where((F.col("share") > 0) & (F.col("share") <= COPIES)), "host")
    lists = common.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "text"))).alias("slots"))
    constant = lists.select("host", F.col("slots.node").alias("nodes"), F.col("slots.text").alias("texts"))
    return written(enough.drop("pages").join(constant, "host"), "wrappers")


def of_article(blocks: list[Block], regions: list[str]) -> list[Block]:
    """The blocks of the page's article or articles, without lists and blocks of links."""
    size = [0] * len(regions)
    for b in blocks:
        if b.region >= 0:
            size[b.region] += len(b.text) - b.linked
    articles = [i for i, tag in enumerate(regions) if tag != "main" and size[i] > 0]
    mains = [i for i, tag in enumerate(regions) if tag == "main" and size[i] > 0]
    if articles:
        most = max(size[i] for i in articles)
        chosen = {i for i in articles if size[i] >= PART * most}
        blocks = [b for b in blocks if b.region in chosen]
    elif mains:
        blocks = [b for b in blocks if b.region in mains]
    if not any(b.links for b in blocks):
        return blocks
    links: dict[int, list[int]] = {}
    for b in blocks:  # of all blocks at one place
        total = links.setdefault(id(b.node), [0, 0, 0])
        total[0] += b.links
        total[1] += b.linked
        total[2] += len("".join(b.text.split()))
    menus = {node for node, (n, linked, chars) in links.items() if n >= 3 and linked >= LINKED * chars}
    return [b for b in blocks if not (id(b.node) in menus and (b.listed or b.region < 0))]


def main_text(html: str | None, template: str | None = None, constant: frozenset[tuple[int, int]] = frozenset()) -> str:
    """The main text of a page, given its host's wrapper if there is one."""
    root, blocks, regions = blocks_of(html)
    kept = of_article(blocks, regions)
    if template is not None and kept:
        where = aligned(template, tree_of(root, blocks))
        kept = [b for b in kept if (where[b.node.number], text_hash(b.text)) not in constant] or kept
    return " ".join(b.text for b in kept)


def extracted(pages: DataFrame, *keep: Column) -> DataFrame:
    """The columns ``keep`` of pages (url, html), as a struct ``row``, and their main text, ``text``."""
    asked = pages.select(F.struct(*keep).alias("row"), host_of(F.col("url")).alias("host"), "html")
    joined = asked.join(wrappers(pages), "host", "left").select("row", "html", "template", "nodes", "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, constant = None, frozenset()
        for batch in batches:
            for part in chunks(batch, "html"):
                out = []
                wrapper = (part.column(c) for c in ("template", "nodes", "texts"))
                for html, template, nodes, texts in zip(part.column("html").to_pylist(), *(c.to_pylist() for c in wrapper), strict=True):
                    if template is not None and (template, texts) != last:
                        last, constant = (template, texts), frozenset(zip(nodes, texts, strict=True))
                    out.append(main_text(html, template, constant if template is not None else frozenset()))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(out, pa.string())], names=["row", "text"])

    schema = asked.select("row").withColumn("text", F.lit("")).schema
    return joined.mapInArrow(run, schema)
