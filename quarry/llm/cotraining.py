"""Quality classifier by co-training: a text-content view and a page-metadata view that teach each other.

* The text view sees a document's content: relative frequencies of its byte trigrams (lower-cased A-Z), hashed to ``DIMS``; naive Bayes.
* The metadata view sees where the page is from and how it is laid out: source, language, length, lines, and shares of
  letters in capitals, digits, punctuation, bars, repeated words; logistic regression.

Both are fitted on a bounded sample of labelled documents, ``LABELLED`` of lowest hash, of which one in four is kept for
calibration. For ``ROUNDS`` rounds each view labels a pool of ``POOL`` unlabelled documents (of lowest hash), and hands the ``SHARE``
of them that it is surest of, in the labels' proportion and at least ``SURE`` sure, to the other view's training set. The views' scores are
then calibrated on the labels kept back (Platt scaling) and combined as independent evidence. All documents are scored whole.

Defined cases: null text counts as empty, null metadata as a value of its own; documents of several labels have their mean, and
null labels are left out; with labels of one class only, or none, every score is the share of good labels (0.5 without any);
repeated rows score alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import blocks as B

LABELLED, POOL, ROUNDS, SHARE, SURE, KEEP = 2_000, 2_000, 4, 0.1, 0.9, 0.5
DIM_BITS = 14
DIMS = 1 << DIM_BITS
NAMED = 32  # hashed values of source and of language
META = 12 + 2 * NAMED
FEATURES = "doc_id long, grams binary, shares binary, meta binary"
SCORES = "doc_id long, text_score double, meta_score double, score double, keep boolean"
CLASSES = np.zeros((6, 256))
for _i, _of in enumerate((range(65, 91), range(97, 123), range(48, 58), b"!?.,;:'\"-#*$%&@+=/\\()[]{}<>~^_`", b"|", b"\n")):
    CLASSES[_i, list(_of)] = 1


class Views:
    """Both views' features of some documents."""

    def __init__(self, texts: list[bytes], sources: list[str | None], langs: list[str | None]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        low = (self.raw + B.UPPER[self.raw] * np.uint8(32)).astype(np.uint32)
        gram = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:] if len(low) > 2 else low[:0]
        self.gram = ((gram * np.uint32(2654435761)) >> np.uint32(32 - DIM_BITS)).astype(np.int64)
        self.counts = np.maximum(sizes - 2, 0)
        words = B.Words(texts)
        n_words = words.to - words.frm
        order = np.lexsort((words.hashes, np.repeat(np.arange(len(texts)), n_words)))
        owner = np.repeat(np.arange(len(texts)), n_words)[order]
        new = np.ones(len(order), bool)
        new[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (owner[1:] != owner[:-1])
        distinct = np.bincount(owner[new], minlength=len(texts))
        size = np.maximum(sizes, 1)
        shares = [self._sums(c[self.raw]) / size for c in CLASSES]
        letters = np.maximum(shares[0] + shares[1], 1e-9)
        lines = shares[5] * size + 1
        numbers = [
            np.log1p(sizes),
            np.log1p(lines),
            np.log1p(size / lines),
            shares[0] / letters,
            *shares[:5],
            distinct / np.maximum(n_words, 1),
            sizes / np.maximum(n_words, 1) / 10,
            np.ones(len(texts)),
        ]
        names = np.zeros((len(texts), 2 * NAMED))
        for column, values in enumerate((sources, langs)):
            at = [zlib.crc32(repr(v).encode()) % NAMED for v in values]
            names[np.arange(len(texts)), column * NAMED + np.array(at, np.int64)] = 1
        self.meta = np.concatenate((np.stack(numbers, axis=1), names), axis=1)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(values)))
        return upto[self.ends] - upto[self.starts]

    def means(self, weights: np.ndarray) -> np.ndarray:
        """Mean weight of each document's trigrams."""
        upto = np.concatenate(([0], np.cumsum(weights[self.gram])))
        return (upto[np.maximum(self.starts + self.counts, self.starts)] - upto[np.minimum(self.starts, len(upto) - 1)]) / np.maximum(self.counts, 1)

    def sparse(self) -> list[tuple[bytes, bytes]]:
        """Distinct hashed trigrams of each document and their shares."""
        out = []
        for a, n in zip(self.starts.tolist(), self.counts.tolist(), strict=True):
            at, counts = np.unique(self.gram[a : a + n], return_counts=True)
            out.append((at.astype("<u2").tobytes(), (counts / max(n, 1)).astype("<f4").tobytes()))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 15) -> np.ndarray:
    """Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Sample:
    def __init__(self, rows: list):
        self.grams = [np.frombuffer(r["grams"], "<u2").astype(np.int64) for r in rows]
        self.shares = [np.frombuffer(r["shares"], "<f4").astype(np.float64) for r in rows]
        self.meta = np.array([np.frombuffer(r["meta"], "<f8") for r in rows]).reshape(-1, META)

    def text_weights(self, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log odds of each trigram, every document counting the same."""
        mass = np.full((2, DIMS), 1.0 / DIMS)
        for i, good in zip(rows.tolist(), y.tolist(), strict=True):
            mass[int(good)][self.grams[i]] += self.shares[i]
        mass /= mass.sum(axis=1, keepdims=True)
        return np.log(mass[1] / mass[0])

    def text_scores(self, weights: np.ndarray) -> np.ndarray:
        return np.array([float(weights[g] @ s) for g, s in zip(self.grams, self.shares, strict=True)])


class Model:
    """What scoring needs: weights of both views, their calibration (slope, intercept), and the prior."""

    def __init__(self, prior: float):
        self.prior, self.text = prior, None

    def scores(self, text_raw: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.text is None:
            flat = np.full(len(meta), self.prior)
            return flat, flat, flat
        text = self.text_line[0] * text_raw + self.text_line[1]
        page = self.meta_line[0] * (((meta - self.mean) / self.scale) @ self.page) + self.meta_line[1]
        base = np.log(self.prior / (1 - self.prior))
        return sigmoid(text), sigmoid(page), sigmoid(text + page - base)


def platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    scale = raw.std() or 1.0
    slope, intercept = logistic(np.stack((raw / scale, np.ones(len(raw))), axis=1), y, 1e-2)
    return slope / scale, intercept


def co_train(labelled: Sample, y: np.ndarray, pool: Sample) -> Model:
    model = Model(float(y.mean()) if len(y) else 0.5)
    kept_back = np.arange(len(y)) % 4 == 3
    own = np.flatnonzero(~kept_back)
    if len(set(y[own].tolist())) < 2 or len(set(y[kept_back].tolist())) < 2:
        return model
    both = Sample([])
    both.grams, both.shares = labelled.grams + pool.grams, labelled.shares + pool.shares
    both.meta = np.concatenate((labelled.meta, pool.meta))
    model.mean, model.scale = both.meta.mean(axis=0) * (np.arange(META) != 11), both.meta.std(axis=0)
    model.scale = np.where(model.scale > 1e-9, model.scale, 1.0)
    x = (both.meta - model.mean) / model.scale
    in_pool = np.arange(len(y), len(both.grams))
    taught = {"text": (own, y[own]), "page": (own, y[own])}
    for turn in range(ROUNDS + 1):
        model.text = both.text_weights(*taught["text"])
        rows, target = taught["page"]
        model.page = logistic(x[rows], target, 1.0)
        raw = {"text": both.text_scores(model.text), "page": x @ model.page}
        line = {view: platt(r[: len(y)][kept_back], y[kept_back]) for view, r in raw.items()}
        model.text_line, model.meta_line = line["text"], line["page"]
        if turn == ROUNDS or not len(in_pool):
            break
        n_good = round(SHARE * (turn + 1) * len(in_pool) * model.prior)
        n_bad = round(SHARE * (turn + 1) * len(in_pool) * (1 - model.prior))
        for view, other in (("text", "page"), ("page", "text")):
            p = sigmoid(line[view][0] * raw[view][in_pool] + line[view][1])
            order = np.argsort(p, kind="stable")
            good = [i for i in order[len(order) - n_good :].tolist() if p[i] >= SURE]
            bad = [i for i in order[:n_bad].tolist() if p[i] <= 1 - SURE]
            taught[other] = (
                np.concatenate((own, in_pool[good], in_pool[bad])).astype(np.int64),
                np.concatenate((y[own], np.ones(len(good)), np.zeros(len(bad)))),
            )
    return model


def views_of(batch: pa.RecordBatch) -> Views:
    texts = [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
    return Views(texts, batch.column("source").to_pylist(), batch.column("lang").to_pylist())


def features(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = views_of(batch)
            grams, shares = zip(*views.sparse(), strict=True) if batch.num_rows else ((), ())
            meta = [row.astype("<f8").tobytes() for row in views.meta]
            columns = [batch.column("doc_id"), *(pa.array(c, pa.binary()) for c in (grams, shares, meta))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "grams", "shares", "meta"])

    return docs.mapInArrow(run, FEATURES)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """``docs``: doc_id, text, source, lang. ``labels``: doc_id, quality. Only the two bounded samples reach the driver."""
    marked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    lowest = F.xxhash64("doc_id")
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    own = ids.join(marked, "doc_id").orderBy(lowest).limit(LABELLED).collect()
    rest = ids.join(marked, "doc_id", "left_anti").orderBy(lowest).limit(POOL).collect()
    y = {r["doc_id"]: float(r["quality"] >= 0.5) for r in own}
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r["doc_id"],) for r in own + rest], "doc_id long")  # at most LABELLED + POOL rows
    rows = features(docs.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"])).collect()
    rows.sort(key=lambda r: zlib.crc32(str(r["doc_id"]).encode()))
    first, second = [r for r in rows if r["doc_id"] in y], [r for r in rows if r["doc_id"] not in y]
    return co_train(Sample(first), np.array([y[r["doc_id"]] for r in first]), Sample(second))


def score(docs: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                views = views_of(batch)
                raw = views.means(model.text) if model.text is not None else np.zeros(batch.num_rows)
                text, page, both = model.scores(raw, views.meta)
                columns = [batch.column("doc_id"), *map(pa.array, (text, page, both)), pa.array(both >= KEEP)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_score", "meta_score", "score", "keep"])

    return docs.mapInArrow(run, SCORES)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score, meta_score, score (probability of good quality), keep."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string"), F.col("lang").cast("string"))
    return score(narrow, fit(narrow, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")))
