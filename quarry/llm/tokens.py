"""Tokenising with a public BPE tokenizer file, with a bounded memo of word pieces.

The BPE tokenizers used here part a text at fixed borders before anything is merged, so the ids of a text are the ids of
its pieces, one after the other. ``PIECES`` cuts only at borders that are certain: between a character that is not white
space and the white space after it; between Latin letters and the ``.,;:!?`` before the next space; and between a line
end that follows a word and the letters after it.

The library encodes every piece a worker has not met lately, many at once: usual ones in a row, parted again by the bytes
that the ids stand for, and unusual ones parted by a special token. The memo has two generations: when the newer one is full it
becomes the older one, and what is used again moves up, so that usual pieces are not learned anew. A text that spells
a special token is encoded whole, and gets the token's id there, as from the file's tokenizer as it is. ``tests/llm``
compares with encoding whole texts.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: U+001C..U+001F are white space to ``re`` but not to the tokenizers.
PIECES = re.compile(
    r" ?[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,;:!?]*+(?:[ \n]|\Z))|[.,;:!?]++(?=[ \n]|\Z)|\n(?=[A-Za-zÀ-ÖØ-öø-ÿ])"
    r"|[^\S\x1c-\x1f]*+[\S\x1c-\x1f]++|[^\S\x1c-\x1f]+"
)
#: Pieces of which the tokenizers keep every byte, but for letter case.
USUAL = re.compile(r"[ \n]?([!-~À-ÖØ-öø-ÿ]+)")
WORD_END = "</w>"
#: Pieces that each generation of a worker's memo keeps, and their letters.
MEMO_PIECES, MEMO_CHARS = 400_000, 12_000_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark_id, self.mark = max((i, t.content) for i, t in special.items())
        self.special = [t.content for t in special.values()]
        vocab = self.tokenizer.get_vocab()
        #: with word ends, white space is dropped; every other character of a token stands for a byte
        self.word_ends = any(t.endswith(WORD_END) for t in vocab)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for t, i in vocab.items():
            self.bytes_of[i] = len(t) - len(WORD_END) * t.endswith(WORD_END)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def _marked(self, pieces: list[str]) -> list[bytes]:
        """Ids of any pieces."""
        if any(x in p for p in pieces if "<" in p for x in self.special):
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        self.tokenizer.encode_special_tokens = False
        try:
            (joined,) = self.tokenizer.encode_batch_fast([self.mark.join(pieces)], add_special_tokens=False)
        finally:
            self.tokenizer.encode_special_tokens = True
        ids = np.array(joined.ids, "<u4")
        ends = np.flatnonzero(ids == self.mark_id)
        return self._cut(ids, np.concatenate(([0], ends + 1)), np.concatenate((ends, [len(ids)])))

    @staticmethod
    def _cut(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def _in_a_row(self, pieces: list[str]) -> list[bytes]:
        """Ids of usual pieces."""
        bare = np.array([p[0] not in " \n" for p in pieces])
        units = ["\n" + p if b else p for p, b in zip(pieces, bare.tolist(), strict=True)]
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids, "<u4")
        upto = np.cumsum(self.bytes_of[ids])
        wanted = np.cumsum([len(u.encode()) - self.word_ends for u in units])
        ends = np.searchsorted(upto, wanted)
        if upto[-1] != wanted[-1] or (upto[ends] != wanted).any():
            raise RuntimeError("the tokenizer parts words differently")
        starts = np.concatenate(([0], ends[:-1] + 1)) + (0 if self.word_ends else bare)
        return self._cut(ids, starts, ends + 1)

    def _learn(self, pieces: list[str]) -> None:
        self.chars += sum(map(len, pieces))
        usual = list(filter(USUAL.fullmatch, pieces))
        for todo, encode in ((usual, self._in_a_row), (list(set(pieces).difference(usual)), self._marked)):
            for i in range(0, len(todo), 1_000):
                self.memo.update(zip(todo[i : i + 1_000], encode(todo[i : i + 1_000]), strict=True))

    def _whole(self, text: str) -> bytes:
        """Ids of a text with its special tokens."""
        self.tokenizer.encode_special_tokens = False
        try:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        finally:
            self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        special = {i for i, t in enumerate(texts) if "<" in t and any(x in t for x in self.special)}
        pieces = [[] if i in special else PIECES.findall(t) for i, t in enumerate(texts)]
        if len(self.memo) > MEMO_PIECES or self.chars > MEMO_CHARS:
            self.older, self.memo, self.chars = self.memo, {}, 0
        new = set().union(*pieces).difference(self.memo)
        again = new.intersection(self.older)
        self.memo.update((p, self.older[p]) for p in again)
        self.chars += sum(map(len, again))
        self._learn(list(new.difference(again)))
        get = self.memo.__getitem__
        return [self._whole(texts[i]) if i in special else b"".join(map(get, p)) for i, p in enumerate(pieces)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
