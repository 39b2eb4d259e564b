"""Toxicity by subword bags: embeddings averaged into a linear softmax.

A word is the mean of the vectors of its hashed character n-grams and of itself,
so a misspelling nobody has labelled shares most of its vector with the words it
resembles. Bags of words are averaged and given to a linear softmax. The average
over a whole text dilutes a few toxic words, so a text has three bags: all its
words, its two most toxic ones and its most toxic one. A logistic calibration
weighs what the softmax says of the three, and the text's length, as the most
toxic of many words is more toxic by chance. Vectors and softmax are trained
jointly in numpy: first on all windows of a few words of a text, then on its most
toxic one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.labelled import held_out, logistic, sample

#: Words: runs of ASCII letters, digits and underscores and of any character beyond ASCII, lower-cased.
WORDS = re.compile(rb"[0-9a-z_\x80-\xff]+").findall
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), 95, *range(97, 123), *range(128, 256)]] = True
#: Lengths of the n-grams, in bytes, with one mark at each end of a word.
SIZES = (3, 4, 5, 6)


def fold(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def grams(data: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length the hash bucket at each byte, and whether an n-gram of one word starts there.

    ``data`` begins and ends with a space; a space beside a word is its mark.
    """
    n = len(data)
    word = _IN_WORD[data]
    letters = np.where(word, np.where(data < 58, 48, data), 32).astype(np.uint32)  # one digit is as good as another
    step = np.where(word, n, np.arange(n))
    after = np.minimum.accumulate(np.append(step[1:], n)[::-1])[::-1]  # the first space behind each byte
    room = after - np.arange(n) + 1
    h = np.zeros(n, dtype=np.uint32)
    shift = np.uint32(32 - (buckets - 1).bit_length())
    for k in range(SIZES[-1]):
        h[: n - k] += letters[k:] * np.uint32((0x9E3779B1 * (2 * k + 1) * (k + 3) | 1) & 0xFFFFFFFF)
        if k + 1 in SIZES:
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * k)
            yield (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> shift, room >= k + 1


def word_means(data: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of ``value`` over the n-grams of each word of ``data``, and where the words start."""
    sums, count = np.zeros(len(data)), np.zeros(len(data), dtype=np.int64)
    for bucket, valid in grams(data, len(value)):
        sums += np.where(valid, value[bucket], 0)
        count += valid
    edge = np.diff(_IN_WORD[data].astype(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    c, k = np.concatenate(([0.0], np.cumsum(sums))), np.concatenate(([0], np.cumsum(count)))
    return (c[end] - c[start - 1]) / (k[end] - k[start - 1]), start


#: n-grams whose gradients set the step of all.
BUSIEST = 400
#: Sizes of the bags of a text's most toxic words.
BAGS = (1, 2)


def bag_features(s: np.ndarray) -> np.ndarray:
    """Means over the bags of a text, given what each of its words adds (missing words add nothing), and the logarithm of their number."""
    n = len(s)
    if not n:
        return np.zeros(len(BAGS) + 2)
    top = np.sort(np.partition(s, n - BAGS[-1])[-BAGS[-1] :] if n > BAGS[-1] else s)[::-1].astype(float)
    return np.array([*(top[:k].sum() / k for k in BAGS), s.mean(dtype=float), np.log(n)])


class Model:
    """``vectors`` (buckets x size), ``weights`` (2 x size), ``bias`` (2), and the calibration of a text's logit."""

    def __init__(self, buckets: int = 1 << 17, size: int = 8, window: int = 3, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.buckets, self.window = buckets, window
        self.vectors = rng.normal(0, 0.05, (buckets, size)).astype(np.float32)
        self.weights = rng.normal(0, 0.5, (2, size))
        self.bias = np.zeros(2)
        self.calibration = np.array([1.0] + [0.0] * (len(BAGS) + 2))
        self.value: np.ndarray | None = None

    def fit(self, texts: list[str], labels: list[int], share: float | None = None, epochs: int = 70, warm: int = 20, rate: float = 0.1) -> Model:
        """Train on texts with labels 0 and 1; a fifth of them only calibrates.

        ``share`` is the share of label 1 where the texts come from, if they were
        drawn by class. Without both classes scores stay near their share.
        """
        y = np.array(labels, dtype=float)
        if len(y) == 0 or y.min() == y.max():
            self.calibration = np.array([0.0] * (len(BAGS) + 2) + [0.0 if len(y) == 0 else np.log((y.sum() + 1) / (len(y) - y.sum() + 1))])
            return self
        index: dict[bytes, int] = {}
        docs = [np.array([index.setdefault(w, len(index)) for w in WORDS(fold(t))], dtype=np.int32) for t in texts]
        keep = np.array([len(d) > 0 for d in docs])
        docs, y = [d for d, k in zip(docs, keep) if k], y[keep]
        data = np.frombuffer(b" " + b" ".join(index) + b" ", dtype=np.uint8)
        owner = np.cumsum(data == 32) - 1  # a word's n-grams start at its left mark or within it
        found = [(owner[valid], bucket[valid]) for bucket, valid in grams(data, self.buckets)]
        by = np.argsort(np.concatenate([o for o, _ in found]), kind="stable")
        ids = np.concatenate([b for _, b in found])[by].astype(np.int32)
        count = np.bincount(np.concatenate([o for o, _ in found]), minlength=len(index))[: len(index)]
        at = np.concatenate(([0], np.cumsum(count)[:-1]))
        del index, data, owner, found, by
        aside = np.arange(len(docs)) % 5 == 4
        if len(np.unique(y[~aside])) < 2:
            aside[:] = False
        train = np.flatnonzero(~aside)
        tokens = np.concatenate([docs[i] for i in train])
        length = np.array([len(docs[i]) for i in train])
        doc = np.repeat(np.arange(len(train), dtype=np.int32), length)
        begin = np.concatenate(([0], np.cumsum(length)[:-1]))
        # The window that starts at each token, cut at the text's end; a text shorter than a window has one.
        first = np.arange(len(tokens))
        last = np.minimum(first + self.window, (begin + length)[doc])
        full = (last - first == self.window) | (first == begin[doc])
        target = y[train]
        mean = target.mean()
        cost = np.where(target == 1, 0.5 / max(mean, 1e-9), 0.5 / max(1 - mean, 1e-9))
        state = {k: [np.zeros_like(v, dtype=float), np.zeros_like(v, dtype=float)] for k, v in (("vectors", self.vectors), ("weights", self.weights), ("bias", self.bias))}
        for epoch in range(1, epochs + 1):
            turn = self.weights[1] - self.weights[0]
            word = np.add.reduceat((self.vectors @ turn)[ids], at) / count
            sums = np.concatenate(([0], np.cumsum(word[tokens])))
            logit = (sums[last] - sums[first]) / (last - first) + self.bias[1] - self.bias[0]
            logit[~full] = -np.inf
            if epoch <= warm:
                pick = np.flatnonzero(full)
                scale = cost[doc[pick]] / np.add.reduceat(full.astype(float), begin)[doc[pick]]
            else:  # one window for each text: its most toxic
                top = np.maximum.reduceat(logit, begin)
                hit = np.flatnonzero(logit == top[doc])
                pick = hit[np.unique(doc[hit], return_index=True)[1]]
                scale = cost[doc[pick]]
            p = 1 / (1 + np.exp(-np.clip(logit[pick], -30, 30)))
            g = (p - target[doc[pick]]) * scale / len(train)
            edge = np.zeros(len(tokens) + 1)
            np.add.at(edge, first[pick], g / (last - first)[pick])
            np.add.at(edge, last[pick], -g / (last - first)[pick])
            per_word = np.bincount(tokens, weights=np.cumsum(edge)[:-1], minlength=len(count)) / count
            per_gram = np.bincount(ids, weights=np.repeat(per_word, count), minlength=self.buckets)
            used = np.flatnonzero(per_gram)
            side = self.vectors[used].T @ per_gram[used]
            top_grams = np.sort(np.abs(per_gram[used]))[-BUSIEST:]
            grads = {"vectors": per_gram[:, None] * turn, "weights": np.array([-side, side]), "bias": np.array([-g.sum(), g.sum()])}
            for k, grad in grads.items():
                m, v = state[k]
                m += 0.1 * (grad - m)
                param = getattr(self, k)
                if k == "vectors":  # one step size for all, set by the busiest n-grams, so that rare ones move little
                    v += 0.01 * (np.square(top_grams).mean() * turn * turn - v)
                else:
                    v += 0.01 * (grad * grad - v)
                param -= (rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-7)).astype(param.dtype)
        apart = np.flatnonzero(aside) if aside.any() and len(np.unique(y[aside])) == 2 else train
        word = np.add.reduceat((self.vectors @ (self.weights[1] - self.weights[0]))[ids], at) / count
        self.calibration = logistic(np.array([bag_features(word[docs[i]]) for i in apart]), y[apart], ridge=0.05)
        if share:
            self.calibration[-1] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
        return self

    def scores(self, texts: list[str | None], block: int = 1 << 20) -> np.ndarray:
        """Calibrated probabilities that texts are toxic; texts without words score as words that add nothing."""
        if self.value is None:
            self.value = (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float32)
        out, held, size = [], [], 0
        for i, t in enumerate(texts):
            held.append(fold(t))
            size += len(held[-1]) + 1
            if size >= block or i == len(texts) - 1:
                begin = np.cumsum([1, *(len(d) + 1 for d in held)])
                mean, start = word_means(np.frombuffer(b" " + b" ".join(held) + b" ", dtype=np.uint8), self.value)
                cut = np.searchsorted(start, begin)
                out += [bag_features(mean[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                held, size = [], 0
        x = np.array(out).reshape(-1, len(BAGS) + 2)
        return 1 / (1 + np.exp(-np.clip(x @ self.calibration[:-1] + self.calibration[-1], -30, 30)))

    def pack(self) -> tuple:
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float32), self.calibration

    @classmethod
    def unpack(cls, packed: tuple) -> Model:
        self = cls.__new__(cls)
        self.value, self.calibration = packed
        return self


def fit(docs: DataFrame, labels: DataFrame, rows: int = 1500, max_bytes: int = 8192) -> Model:
    """A model from at most ``rows`` labelled texts of each class, none over ``max_bytes``, none held out."""
    texts, marks, share = sample(docs, labels, "toxic", rows, max_bytes)
    return Model().fit(texts, marks, share)


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = 1500, max_bytes: int = 8192, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document, null and empty texts included.

    Whole texts are scored, however long. Rows whose labels are null or contradict
    each other aren't learned from; repeated documents give repeated rows; without
    labels of both classes all scores are alike; an empty table gives an empty
    result; other columns of both tables are ignored.
    """
    return score_column(docs, fit(docs, labels, rows, max_bytes)).select("doc_id", held_out().alias("held_out"), F.col("score"), (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_column(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row."""
    handle = docs.sparkSession.sparkContext.broadcast(model.pack())  # an array of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.unpack(handle.value)
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.scores(b.column(1).to_pylist()))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text scores below ``threshold``, unchanged; null and empty texts are scored as no words, repeated rows alike."""
    handle = docs.sparkSession.sparkContext.broadcast(model.pack())
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.unpack(handle.value)
        for b in parts(batches):
            yield b.filter(pa.array(own.scores(b.column(where).to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)
