"""Quality by compression: which dictionary, good or bad, makes a text smaller.

Two zstandard dictionaries are trained, one from labelled good text and one from
bad. A text is compressed in blocks with each, so that what it has in common with
a dictionary counts and not only with itself. The sizes, normalised by each other
and by the text's length, become a probability by logistic calibration.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.labelled import held_out, logistic, sample

#: Bytes compressed at a time, and zstandard's level.
BLOCK = 1024
LEVEL = 3


class Model:
    """Two dictionaries and the weights of the calibration."""

    def __init__(self, dictionary_bytes: int = 64 << 10):
        self.dictionary_bytes = dictionary_bytes
        self.dictionaries: list[bytes] = []
        self.weights: np.ndarray | None = None
        self._coders: list | None = None

    def _dictionary(self, texts: list[bytes]) -> bytes:
        pieces = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
        try:
            return zstandard.train_dictionary(min(self.dictionary_bytes, max(1024, sum(map(len, pieces)) // 8)), pieces, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # too little text to train on: its bytes themselves serve
            return b"".join(pieces)[-self.dictionary_bytes :]

    def fit(self, texts: list[str], labels: list[int], share: float | None = None) -> Model:
        """Every third text calibrates, the others make the dictionaries. Without both classes all scores are alike."""
        y = np.array(labels, dtype=float)
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        aside = np.arange(len(y)) % 3 == 2
        if not all(((y == c) & ~aside).any() for c in (0, 1)):
            self.weights = None
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        self.dictionaries = [self._dictionary([d for d, k, a in zip(data, y, aside) if k == c and not a]) for c in (0, 1)]
        which = np.flatnonzero(aside)
        x = np.array([self.features(data[i]) for i in which])
        self.weights = logistic(x, y[which], ridge=0.01)
        if share and 0 < y[which].mean() < 1:
            own = y[which].mean()
            self.weights[-1] += np.log(share / (1 - share)) - np.log(own / (1 - own))
        return self

    def features(self, data: bytes) -> np.ndarray:
        """The normalised difference of the two sizes, and the sizes' share of the length, with their squares."""
        if self._coders is None:
            self._coders = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False) for d in self.dictionaries]
        n = max(len(data), 1)
        bad, good = (sum(len(c.compress(data[i : i + BLOCK])) for i in range(0, n, BLOCK)) for c in self._coders)
        difference, size = (bad - good) / (bad + good), (bad + good) / (2 * (n + 16))
        # An empty text has two equal frames: no difference, and the size of nothing.
        return np.array([10 * difference, size, 10 * difference * size, size * size, 20 * difference * difference, np.log(n)])

    def score(self, text: str | None) -> float:
        """Probability of label 1; null counts as empty."""
        if self.weights is None:
            return self.constant
        x = self.features((text or "").encode("utf-8", "surrogatepass"))
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_coders": None}


def fit(docs: DataFrame, labels: DataFrame, rows: int = 2000, max_bytes: int = 8192) -> Model:
    """A model from at most ``rows`` labelled texts of each class, none over ``max_bytes``, none held out."""
    return Model().fit(*sample(docs, labels, "quality", rows, max_bytes))


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = 2000, max_bytes: int = 8192, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document, from the whole text alone.

    Null and empty texts are scored as no bytes, long ones block by block to their
    end. Rows whose labels are null or contradict each other aren't learned from;
    repeated documents give repeated rows; without labels of both classes all
    scores are alike; an empty table gives an empty result; other columns of both
    tables are ignored.
    """
    handle = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows, max_bytes))  # two dictionaries of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.score(t) for t in b.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
