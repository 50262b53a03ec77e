"""Index build: postings, document frequency, max-tf, N, word ids, weights.

Plan shape (one job per table, all declarative):

* ``wide_postings``: one aggregation of the token stream by (page_id, term)
  that carries both fields at once -- body/title tf and sorted positions.
  Tokens of one page sit in one input partition, so the map-side partial
  aggregate already reduces tokens to postings before the shuffle.
* ``postings``: the per-field long form (narrow ``inline``, no shuffle).
* ``term_df``/``document_frequency``: partial aggregation by term.
* ``max_tf``: partial aggregation by page, outer-joined to all pages so a page
  without terms gets a 0 row.
* ``document_weights``: TF-IDF weight per (page, term) and the weight divided
  by the page's vector norm, so a query's cosine score is one broadcast join
  plus a sum (no norm join at query time).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.util import dense_index
from quarry.session import cut_lineage

# Fixed value: a title occurrence counts as this many body occurrences.
TITLE_WEIGHT = 2.0


def wide_postings(tokens: DataFrame) -> DataFrame:
    """``(page_id, term, body_tf, title_tf, body_positions, title_positions)``.

    One aggregate buffer per (page, term): the (field, position) pairs are
    collected once, sorted (body first, positions ascending) and split by
    field with array functions."""
    field_order = F.when(F.col("field") == "body", F.lit(0)).otherwise(F.lit(1))
    occ = F.struct(field_order.alias("f"), F.col("pos").alias("p"))
    grouped = tokens.groupBy("page_id", "term").agg(F.array_sort(F.collect_list(occ)).alias("occ"))
    body = F.transform(F.filter("occ", lambda o: o["f"] == 0), lambda o: o["p"])
    title = F.transform(F.filter("occ", lambda o: o["f"] == 1), lambda o: o["p"])
    return grouped.select("page_id", "term", body.alias("body_positions"), title.alias("title_positions")).select(
        "page_id",
        "term",
        F.size("body_positions").cast("long").alias("body_tf"),
        F.size("title_positions").cast("long").alias("title_tf"),
        "body_positions",
        "title_positions",
    )


def postings(wide: DataFrame, field: str | None = None) -> DataFrame:
    """``(field, term, page_id, tf, positions array<int>)``; one field or both."""
    fields = ("body", "title") if field is None else (field,)
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{f}_tf").alias("tf"),
                F.col(f"{f}_positions").alias("positions"),
            )
            for f in fields
        ]
    )
    return (
        wide.select("term", "page_id", F.inline(rows))
        .where(F.col("tf") > 0)
        .select("field", "term", "page_id", "tf", "positions")
    )


def term_df(wide: DataFrame) -> DataFrame:
    """``(term, body_df, title_df, df)`` with ``df = body_df + title_df``."""
    return (
        wide.groupBy("term")
        .agg(
            F.count_if(F.col("body_tf") > 0).alias("body_df"),
            F.count_if(F.col("title_tf") > 0).alias("title_df"),
        )
        .withColumn("df", F.col("body_df") + F.col("title_df"))
    )


def document_frequency(wide: DataFrame, field: str | None = None) -> DataFrame:
    """``(field, term, df)``: pages whose ``field`` contains the term."""
    long = term_df(wide).select(
        "term",
        F.inline(
            F.array(
                F.struct(F.lit("body").alias("field"), F.col("body_df").alias("df")),
                F.struct(F.lit("title").alias("field"), F.col("title_df").alias("df")),
            )
        ),
    )
    long = long.where(F.col("df") > 0)
    if field is not None:
        long = long.where(F.col("field") == field)
    return long.select("field", "term", "df")


def page_max_tf_wide(wide: DataFrame, pages: DataFrame) -> DataFrame:
    """``(page_id, body_maxtf, title_maxtf)`` for every page, 0 when no terms."""
    mx = wide.groupBy("page_id").agg(
        F.max("body_tf").alias("body_maxtf"), F.max("title_tf").alias("title_maxtf")
    )
    return pages.select("page_id").join(mx, "page_id", "left").select(
        "page_id",
        F.coalesce("body_maxtf", F.lit(0)).cast("long").alias("body_maxtf"),
        F.coalesce("title_maxtf", F.lit(0)).cast("long").alias("title_maxtf"),
    )


def max_tf(wide: DataFrame, pages: DataFrame, field: str | None = None) -> DataFrame:
    """``(field, page_id, maxtf)``; one row per page and field (0 if empty)."""
    fields = ("body", "title") if field is None else (field,)
    mx = page_max_tf_wide(wide, pages)
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_maxtf").alias("maxtf")) for f in fields])
    return mx.select("page_id", F.inline(rows)).select("field", "page_id", "maxtf")


def doc_count(pages: DataFrame) -> DataFrame:
    """One row ``(n_docs long)``: pages in the corpus, with or without terms."""
    return pages.agg(F.count(F.lit(1)).alias("n_docs"))


def n_docs_scalar(pages: DataFrame) -> Column:
    """N as an uncorrelated scalar subquery (computed once, no cross join)."""
    return doc_count(pages).scalar()


def term_totals(wide: DataFrame) -> DataFrame:
    """``(term, body_total, title_total, total)``: corpus-wide sums of tf."""
    return (
        wide.groupBy("term")
        .agg(F.sum("body_tf").alias("body_total"), F.sum("title_tf").alias("title_total"))
        .select(
            "term",
            F.col("body_total").cast("long").alias("body_total"),
            F.col("title_total").cast("long").alias("title_total"),
            (F.col("body_total") + F.col("title_total")).cast("long").alias("total"),
        )
    )


def first_seen(wide: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """``(term, page_order, field_order, pos)``: where each term first occurs --
    page order (``page_order`` column of ``pages`` or page_id), body before
    title, then position."""
    w = wide
    order = F.col("page_id")
    order_name = "page_id"
    if pages is not None and "page_order" in pages.columns:
        w = w.join(pages.select("page_id", "page_order"), "page_id")
        order = F.col("page_order")
        order_name = "page_order"
    field = F.when(F.col("body_tf") > 0, F.lit(0)).otherwise(F.lit(1))
    first_pos = F.when(
        F.col("body_tf") > 0, F.try_element_at("body_positions", F.lit(1))
    ).otherwise(F.try_element_at("title_positions", F.lit(1)))
    if pages is not None:
        lo, hi = pages.agg(F.min(order_name), F.max(order_name)).first()
        if lo is not None and lo >= 0 and hi < (1 << 31):
            # (order, field, pos) packed into one long: min() then runs as a
            # hash aggregate instead of the sort-based min over a struct
            packed = F.shiftleft(order.cast("long"), 32) + F.shiftleft(field.cast("long"), 31) + first_pos.cast("long")
            m = w.select("term", packed.alias("k")).groupBy("term").agg(F.min("k").alias("k"))
            return m.select(
                "term",
                F.shiftright("k", 32).alias("page_order"),
                F.shiftright("k", 31).bitwiseAND(F.lit(1)).cast("int").alias("field_order"),
                F.col("k").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("pos"),
            )
    key = F.when(
        F.col("body_tf") > 0,
        F.struct(order.alias("page_order"), F.lit(0).alias("field_order"), F.try_element_at("body_positions", F.lit(1)).alias("pos")),
    ).otherwise(
        F.struct(order.alias("page_order"), F.lit(1).alias("field_order"), F.try_element_at("title_positions", F.lit(1)).alias("pos"))
    )
    return w.select("term", key.alias("k")).groupBy("term").agg(F.min("k").alias("k")).select("term", "k.*")


def assign_word_ids(wide: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """``(word_id long, term)``: ids 1.. in first-seen order."""
    fs = first_seen(wide, pages)
    ids = dense_index(fs, [F.col("page_order"), F.col("field_order"), F.col("pos"), F.col("term")], "word_id")
    return ids.select("word_id", "term")


def document_weights(wide: DataFrame, pages: DataFrame, tdf: DataFrame | None = None, by_page: DataFrame | None = None) -> DataFrame:
    """``(page_id, term, tf, idf, weight, norm, nweight)``.

    tf = body_tf + 2*title_tf; df = body_df + title_df; idf = ln(N/df);
    max_tf = greatest(body max, 2*title max, 1) (not the max of the sums);
    weight = tf*idf/max_tf over **all** terms of the page; norm = sqrt(sum
    weight^2) per page; nweight = weight/norm (0 when norm is 0). ``by_page``
    are the same postings where those of a page lie together, if there are such.
    """
    tdf = term_df(wide) if tdf is None else tdf
    mx = page_max_tf_wide(wide if by_page is None else by_page, pages).select(
        "page_id",
        F.greatest(
            F.col("body_maxtf").cast("double"), F.lit(TITLE_WEIGHT) * F.col("title_maxtf"), F.lit(1.0)
        ).alias("max_tf"),
    )
    n = n_docs_scalar(pages)
    weighted = (
        wide.select("page_id", "term", "body_tf", "title_tf")
        .join(tdf.select("term", "df"), "term")
        .join(mx, "page_id")
        .select(
            "page_id",
            "term",
            (F.col("body_tf") + F.lit(TITLE_WEIGHT) * F.col("title_tf")).alias("tf"),
            F.log(n / F.greatest(F.col("df"), F.lit(1))).alias("idf"),
            "max_tf",
        )
        .withColumn("weight", F.col("tf") * F.col("idf") / F.col("max_tf"))
    )
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("page_id")))
    return weighted.withColumn("norm", norm).withColumn(
        "nweight", F.when(F.col("norm") > 0, F.col("weight") / F.col("norm")).otherwise(F.lit(0.0))
    )


def doc_norms(weights: DataFrame) -> DataFrame:
    """``(page_id, norm, max_tf)`` per page with terms."""
    return weights.groupBy("page_id").agg(F.first("norm").alias("norm"), F.first("max_tf").alias("max_tf"))


def dedupe_pages(pages: DataFrame, order_col: str = "page_id") -> DataFrame:
    """One row per URL; the first writer (lowest ``order_col``) wins.

    An aggregate, not a window: ``min(struct(order, row))`` combines
    map-side, so a URL copied across a third of the rows is reduced to one
    row per task before the shuffle."""
    others = [c for c in pages.columns if c not in ("url", order_col)]
    first = F.min(F.struct(F.col(order_col).alias("_o"), *[F.col(c) for c in others])).alias("_m")
    return pages.groupBy("url").agg(first).select(
        *[F.col("url") if c == "url" else F.col("_m._o").alias(c) if c == order_col else F.col(f"_m.{c}") for c in pages.columns]
    )


@dataclass
class Index:
    """The materialisable index tables of one corpus."""

    pages: DataFrame  # page_id, url, title, last_modified, size
    wide: DataFrame
    term_df: DataFrame
    weights: DataFrame | None
    wide_blocks: DataFrame | None = None  # directory of a stored ``wide``: (segment,) block, term, first_page, last_page
    weight_blocks: DataFrame | None = None  # directory of stored ``weights``: block, term, most
    stored_norms: DataFrame | None = None  # (page_id, norm, max_tf, body_maxtf, title_maxtf) when materialised
    stored_vocab: DataFrame | None = None  # (word_id, term, ...) when materialised
    stored_keywords: DataFrame | None = None  # (page_id, place, term, total) of each page's first keywords when materialised
    _page_range: tuple | None = field(default=None, repr=False)

    def word_order(self) -> DataFrame:
        """``(term, seen)``: a key that sorts terms in first-seen order -- the
        stored dense word id, or (page_order, field_order, pos) computed from
        the postings."""
        if self.stored_vocab is not None:
            return self.stored_vocab.select("term", F.col("word_id").alias("seen"))
        fs = first_seen(self.wide, self.pages)
        return fs.select("term", F.struct("page_order", "field_order", "pos").alias("seen"))

    def page_id_range(self) -> tuple[int | None, int | None]:
        """(min, max) page id, computed once per index object."""
        if self._page_range is None:
            r = self.pages.agg(F.min("page_id"), F.max("page_id")).first()
            self._page_range = (r[0], r[1])
        return self._page_range

    def norms(self, asked: DataFrame | None = None) -> DataFrame:
        """``(page_id, norm, max_tf)`` per page with terms, or of the ``page_id`` rows asked for only: then no
        other page's postings are weighted."""
        if self.stored_norms is not None:
            return self.stored_norms if asked is None else self.stored_norms.join(asked, "page_id", "left_semi")
        if asked is None:
            return doc_norms(self.weights)
        return doc_norms(document_weights(self.wide.join(asked, "page_id", "left_semi"), self.pages, self.term_df))

    def term_keys(self, df: DataFrame, of: str = "wide", page: str | None = None) -> tuple[DataFrame, list[str]]:
        """``df`` with its join keys against ``wide`` or ``weights`` (``of``).

        For a stored index these are the blocks that hold a row's term, from the
        block directory, and the term: the join then reads only these blocks
        (dynamic partition pruning). A row gets one copy per block of its term;
        with a ``page`` column, the one block that the page falls in (rows of
        unknown terms stay, with a null block). Plain term otherwise."""
        blocks = self.wide_blocks if of == "wide" else self.weight_blocks
        if blocks is None:
            return df, ["term"]
        keys = [c for c in ("segment", "block") if c in blocks.columns]
        own = blocks.withColumnsRenamed({c: f"_{c}" for c in blocks.columns})
        on = F.col("term") == F.col("_term")
        if page is not None:
            on = on & F.col(page).between(F.col("_first_page"), F.col("_last_page"))
            if "segment" in df.columns:
                on = on & (F.col("segment") == F.col("_segment"))
        joined = df.join(own, on, "inner" if page is None else "left")
        new = [F.col(f"_{c}").alias(c) for c in keys if c not in df.columns]
        return joined.select(*df.columns, *new), [*keys, "term"]

    def hit_weights(self, asked: DataFrame, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Query keys (term, qweight, ...) with their postings' ``page_id, weight, nweight, norm``. ``hint`` says how their
        side of the join with the postings is sent."""
        keyed, keys = self.term_keys(asked, "weights")
        return self.weights.select("page_id", *keys, "weight", "nweight", "norm").join(hint(keyed), keys)

    def postings(self, field: str | None = None) -> DataFrame:
        return postings(self.wide, field)

    def max_tf(self, field: str | None = None) -> DataFrame:
        return max_tf(self.wide, self.pages, field)

    def n_docs(self) -> Column:
        return n_docs_scalar(self.pages)


def build_index(tokens: DataFrame | None, corpus: DataFrame, wide: DataFrame | None = None) -> Index:
    """Index tables from a token stream, or from ``wide`` postings that were
    grouped page by page (``analyze.page_postings``; no shuffle of tokens)."""
    pages = corpus.select(*[c for c in corpus.columns if c != "body"])
    wide = wide_postings(tokens) if wide is None else wide
    tdf = term_df(wide)
    weights = document_weights(wide, pages, tdf)
    return Index(pages=pages, wide=wide, term_df=tdf, weights=weights)



def latest_per_url(snapshot: DataFrame) -> DataFrame:
    """One row per URL of a snapshot: of several, the one last modified (as
    text; null first), ties by the other columns in their order.

    A partial aggregate, so repeated rows of a URL are reduced before the shuffle."""
    others = [c for c in snapshot.columns if c not in ("url", "last_modified", "page_id")]
    row = F.struct(F.coalesce("last_modified", F.lit("")).alias("_o"), *[F.col(c) for c in others], "last_modified")
    last = snapshot.groupBy("url").agg(F.max(row).alias("_m"))
    return last.select(*[F.col("url") if c == "url" else F.col(f"_m.{c}").alias(c) for c in snapshot.columns if c != "page_id"])


def assign_page_ids(snapshot: DataFrame, stored_pages: DataFrame) -> DataFrame:
    """Give pages of a snapshot (one row per URL) their ids: a known URL keeps
    its stored id (first writer wins), a new URL gets the next free id, in URL
    order."""
    snap = snapshot.drop("page_id") if "page_id" in snapshot.columns else snapshot
    known = snap.join(stored_pages.select("url", "page_id"), "url")
    fresh = snap.join(stored_pages.select("url"), "url", "left_anti")
    top = stored_pages.agg(F.coalesce(F.max("page_id"), F.lit(-1)).alias("m")).scalar()
    fresh = dense_index(fresh, [F.col("url")], "_rank").withColumn("page_id", (top + F.col("_rank")).cast("long")).drop("_rank")
    return known.unionByName(fresh)


def merge_index(old: Index, new_pages: DataFrame, new_wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replace the postings of changed pages (idempotent, unlike adding tf
    and df on re-crawl): ``(pages, wide)`` = old rows of unchanged pages
    union the new rows. ``new_pages`` carry their final page ids."""
    kept = old.pages.join(new_pages.select("url"), "url", "left_anti")
    pages = kept.unionByName(new_pages.select(*kept.columns))
    cols = [c for c in new_wide.columns if c not in ("segment", "block")]
    old_wide = old.wide.select(*cols)
    wide = old_wide.join(kept.select("page_id"), "page_id", "left_semi").unionByName(new_wide.select(*cols))
    return pages, wide


def refresh_index(old: Index, snapshot: DataFrame, analyze_fn) -> Index:
    """Re-index the pages of ``snapshot`` that are new or changed (by
    last_modified) and rebuild df and weights; unchanged pages are not
    re-analysed. Of several rows of a URL the one last modified counts.
    ``analyze_fn(corpus)`` gives tokens, or postings grouped page by page
    (``analyze.page_postings``; no shuffle of tokens)."""
    from quarry.operators.links import changed_pages

    # read several times below: the pages are found once, with the ids they get
    changed = cut_lineage(assign_page_ids(cut_lineage(changed_pages(latest_per_url(snapshot), old.pages)), old.pages))
    fresh = analyze_fn(changed)
    new_wide = fresh if "body_tf" in fresh.columns else wide_postings(fresh)
    cols = [c for c in old.pages.columns if c in changed.columns]
    pages, wide = merge_index(Index(old.pages.select(*cols), old.wide, old.term_df, old.weights), changed.select(*cols), new_wide)
    tdf = term_df(wide)
    return Index(pages=pages, wide=wide, term_df=tdf, weights=document_weights(wide, pages, tdf))
