"""Plain versions of the operators, over Python lists."""

import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(row):
    return (row[0] is None, row[0] or 0, row[1] or "")


def dedup(rows, window=20):
    """(doc_id, n_words, n_removed, kept) in order."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=order):
        ws = WORD.findall(text or "")
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone, strict=True) if not g)))
    return out


def shingles(text, k=5):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def jaccard(rows, percent=75):
    """{doc_id: component} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i, _ in sets}


def least_edits(pattern, text):
    """Fewest edits between the pattern and any part of the text."""
    prev = [0] * (len(text) + 1)
    for i, ch in enumerate(pattern, 1):
        cur = [i]
        for j, other in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (ch != other), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def pieces(tokenizer, rows, end_id, capacity):
    out = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc_id, n, at, len(part), zlib.crc32(part.tobytes())))
    return out


def by_none(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v) if isinstance(v, str) else v or 0) for v in r))
