"""Substring dedup: recurring phrases, located by sharded automata, and the passages around them removed.

A window is ``WINDOW`` consecutive words. A window that occurs again contains the same phrases of ``PHRASE`` words, among them
the one of least hash; so only these *anchor* phrases, about one in seven words, are compared first:

1. every block of documents sends its distinct anchor phrases (hashes), and learns which of them recur elsewhere;
2. each block compiles an Aho-Corasick automaton of its recurring phrases (word numbers, spelled as digits) and streams all its
   documents through it, which locates every occurrence; the windows anchored there are sent (64-bit hashes of their words), and
   those that a lower block has too come back;
3. windows that occur earlier, in a lower block or further up in the same one, cover the words that are removed.

An automaton holds only phrases that recur and that its own block contains, so it is bounded by the block. Blocks follow the
order of ``doc_id``, so "earlier" is a comparison of block numbers. Two different windows are taken for the same one only where
their 64-bit hashes collide.

Defined cases: null text has no words; null ids come last; rows of equal id are ordered by text; repeated rows repeat all their windows;
a document of fewer words than a window keeps all; an empty table gives no rows; other columns are carried in ``row``.
"""

from __future__ import annotations

from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.llm import blocks as B
from quarry.llm.store import release

WINDOW, PHRASE = 20, 8
#: Letters that spell a word number.
DIGITS = 3


def spelled(number: np.ndarray, n: int) -> str:
    """Word numbers below n as digits, each place with an alphabet of its own, so that a phrase matches at words only; -1 as a
    letter that no number has. An automaton's node then has few children, which it searches one by one."""
    base = 1
    while base**DIGITS < n:
        base += 1
    places = [number // base**i % base + 1 + i * base for i in range(DIGITS)]
    letters = np.where(number[:, None] >= 0, np.stack(places, axis=1), DIGITS * base + 1)
    return letters.astype("<u4").tobytes().decode("utf-32-le")


class Block:
    """The windows of a block's texts."""

    def __init__(self, texts: list[bytes], window: int, phrase: int):
        self.words = B.Words(texts)
        left = self.words.left()
        self.valid = left >= window
        self.phrases = self.words.rolling(phrase)
        #: phrases that run over the end of their text are no one's anchor
        self.phrases[left < phrase] = np.iinfo(np.uint64).max
        self.width = window - phrase + 1
        self.anchors = B.sliding_min(self.phrases, self.width)

    def recurring(self, elsewhere: np.ndarray) -> np.ndarray:
        """Anchor phrases that other blocks have, or that this one has twice."""
        values, counts = np.unique(self.phrases, return_counts=True)
        own = np.unique(self.anchors[self.valid])
        twice = own[B.is_in(own, values[counts > 1])]
        return np.union1d(elsewhere, twice)

    def locate(self, phrases: np.ndarray, phrase: int) -> np.ndarray:
        """Marks every word at which one of ``phrases`` starts."""
        located = np.zeros(len(self.phrases), bool)
        at = np.flatnonzero(B.is_in(self.phrases, phrases))
        if not len(at):
            return located
        _, first = np.unique(self.phrases[at], return_index=True)
        starts = at[first]
        used = np.unique(self.words.hashes[starts[:, None] + np.arange(phrase)])
        number = np.where(B.is_in(self.words.hashes, used), np.searchsorted(used, self.words.hashes), -1)
        text = spelled(number, len(used))
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for j in starts.tolist():
            automaton.add_word(text[DIGITS * j : DIGITS * (j + phrase)])
        automaton.make_automaton()
        for a, b in zip(self.words.frm.tolist(), self.words.to.tolist(), strict=True):
            ends = [end for end, _ in automaton.iter(text[DIGITS * a : DIGITS * b])]
            located[a - phrase + (np.array(ends, np.int64) + 1) // DIGITS] = True
        return located

    def anchored(self, located: np.ndarray) -> np.ndarray:
        """Windows whose anchor phrase has been located."""
        found = np.where(located, self.phrases, np.iinfo(np.uint64).max)
        return self.valid & (B.sliding_min(found, self.width) == self.anchors)


def released(table: pa.Table) -> pa.Table:
    release()
    return table


def in_order(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table.select(["doc_id", "text"]), [("doc_id", "ascending"), ("text", "ascending")]))


def substring_dedup(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """row (all columns of ``docs`` but the text), text, n_words, n_removed, kept (the words left, joined by a space)."""
    placed, n = B.in_blocks(docs, block_bytes)
    buckets = B.buckets_for(n)
    grouped = placed.groupBy("block")

    def anchors(table: pa.Table) -> pa.Table:
        own = Block(B.texts_of(table), window, phrase)
        return released(B.by_bucket(table.column("block")[0].as_py(), np.unique(own.anchors[own.valid]), buckets, B.plain))

    def windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return B.by_bucket(0, np.zeros(0, np.uint64), buckets, B.plain)
        own = Block(B.texts_of(table), window, phrase)
        located = own.locate(own.recurring(B.received(answers)), phrase)
        keys = np.unique(own.words.rolling(window)[own.anchored(located)])
        del own, located
        return released(B.by_bucket(table.column("block")[0].as_py(), keys, buckets, B.plain))

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = in_order(table)
        texts = B.texts_of(table)
        w = B.Words(texts)
        at = np.flatnonzero(w.left() >= window)
        keys = w.rolling(window)[at]
        _, first = np.unique(keys, return_index=True)
        late = np.ones(len(keys), bool)
        late[first] = False
        late |= B.is_in(keys, B.received(answers))
        depth = np.zeros(len(w.hashes) + 1, np.int64)
        depth[at[late]] += 1
        depth[at[late] + window] -= 1
        gone = np.cumsum(depth[:-1]) > 0
        upto = np.concatenate(([0], np.cumsum(gone)))
        removed = upto[w.to] - upto[w.frm]
        kept = [
            b" ".join(t.split() if not r else compress(t.split(), (~gone[a:b]).tolist()))
            for t, r, a, b in zip(texts, removed.tolist(), w.frm.tolist(), w.to.tolist(), strict=True)
        ]
        return pa.table(
            {
                "row": table.column("row"),
                "text": table.column("text"),
                "n_words": pa.array(w.to - w.frm, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    recurring = B.shared_keys(grouped.applyInArrow(anchors, B.KEYS)).groupBy("block")
    seen = B.shared_keys(grouped.cogroup(recurring).applyInArrow(windows, B.KEYS), later_only=True).groupBy("block")
    schema = f"row {placed.schema['row'].dataType.simpleString()}, text string, n_words long, n_removed long, kept string"
    return grouped.cogroup(seen).applyInArrow(remove, schema)
