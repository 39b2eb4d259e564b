"""Benchmark passages in documents, by CGK embeddings and bit sampling.

Texts are sequences of words. The CGK walk reads a sequence and at each step
either stays or moves on, as a random bit for the step and the word tells; two
sequences at a small edit distance give outputs at a small Hamming distance, as
the walks meet again after an edit. Sampled positions of the outputs are
locality-sensitive keys. Windows of a text that are as long as an item (within a
size class) are looked up by these keys, and each match is verified by the exact
edit distance of the item to the best passage around the window.

An item of n words is found in a text if some passage differs by less than n / 5
edits of words. k edits leave r = (n - k) / (k + 1) words in a row unchanged, so only
windows near such a run of an item's words are embedded, in that item's size
class; no passage is lost by that. Keys alone lose passages: long items at the
greatest distance, with deletions most. So places that hold enough of an item's
runs are verified too: an item has n - r + 1 runs of r words, an edit breaks at
most r of them, and the runs left lie within k places of where the passage
begins. Each passage within the allowed edits is found by that, at any length.
Items under six words allow no edit, and are such a run themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.suffix import mix
from chronoloom.llm.words import HashSet, gram_hashes, word_hashes

#: Items under so many words allow no edit and need no keys.
LEAST_WORDS = 6
WALKS, SAMPLES, POSITIONS = 6, 8, 3
#: Bytes of documents searched at once.
BLOCK_BYTES = 4 << 20
#: Matches of an item's runs held at once, unless one text has more.
PLACES = 1 << 20
#: Bytes of benchmark text in one broadcast; a larger benchmark is searched in several passes.
PART_BYTES = 16 << 20


def edits_allowed(n: int) -> int:
    return (n - 1) // 5


def kept_run(n: int) -> int:
    """Words in a row that the allowed edits leave unchanged at least."""
    k = edits_allowed(n)
    return -(-(n - k) // (k + 1))


def best_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to any passage of ``text``, and where the first such passage ends."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    step = np.arange(len(text) + 1)
    for i, w in enumerate(item.tolist(), 1):
        low = np.minimum(row[1:] + 1, row[:-1] + (text != np.uint64(w)))
        row = np.concatenate(([i], low))
        # Insertions: the least of all entries to the left, one more for each step.
        row = np.minimum.accumulate(row - step) + step
    end = int(row.argmin())
    return int(row[end]), end


def size_classes(longest: int) -> list[int]:
    """Window sizes: an item belongs to the largest class not above its length; classes grow by an eighth."""
    out = [LEAST_WORDS]
    while out[-1] < longest:
        out.append(max(out[-1] + 1, out[-1] * 9 // 8))
    return out


def embed(words: np.ndarray, starts: np.ndarray, size: int, limit: np.ndarray, walk: int) -> np.ndarray:
    """CGK outputs of windows, 3 * size steps each: word hashes, 0 behind a window's end."""
    out = np.zeros((3 * size, len(starts)), dtype=np.uint64)
    at, end = starts.copy(), np.minimum(starts + size, limit)
    last = len(words) - 1
    for step in range(3 * size):
        inside = at < end
        w = np.where(inside, words[np.minimum(at, last)], np.uint64(0))
        out[step] = w
        at = at + (inside & ((mix(w + np.uint64(step * 64 + walk + 1)) & np.uint64(1)) == 1))
    return out


def sampled_keys(outputs: np.ndarray, size: int, walk: int) -> Iterator[np.ndarray]:
    """A key of each window for each sampling of the outputs' positions."""
    rng = np.random.default_rng((size, walk))
    for s in range(SAMPLES):
        key = np.full(outputs.shape[1], (size * 64 + walk) * 64 + s, dtype=np.uint64)
        # Positions behind the walk's usual reach of 2 * size steps say little.
        for p in np.sort(rng.choice(2 * size - 1, POSITIONS, replace=False)).tolist():
            key = mix(key + outputs[p])
        yield key


class Index:
    """Items with their runs of words and their keys by size class."""

    def __init__(self, ids: list[int], texts: list[str]):
        words, begin = word_hashes(texts)
        self.items = [(i, words[a:b]) for i, a, b in zip(ids, begin[:-1], begin[1:]) if b > a]
        classes = np.array(size_classes(max((len(w) for _, w in self.items), default=0)))
        by_class: dict[int, list[int]] = {}
        every: dict[int, list[np.ndarray]] = {}
        for k, (_, w) in enumerate(self.items):
            if len(w) < LEAST_WORDS:
                every.setdefault(len(w), []).append(gram_hashes(w, len(w)))
                continue
            by_class.setdefault(int(classes[np.searchsorted(classes, len(w), side="right") - 1]), []).append(k)
        self.classes: list[tuple[int, dict[int, HashSet], list[tuple[np.ndarray, np.ndarray]]]] = []
        for size, members in sorted(by_class.items()):
            flat = np.concatenate([self.items[k][1] for k in members])
            ends = np.cumsum([len(self.items[k][1]) for k in members])
            starts = np.concatenate(([0], ends[:-1]))
            tables = []
            for walk in range(WALKS):
                for key in sampled_keys(embed(flat, starts, size, ends, walk), size, walk):
                    order = np.argsort(key, kind="stable")
                    tables.append((key[order], np.array(members)[order]))
            runs: dict[int, list[np.ndarray]] = {}
            for k in members:
                w = self.items[k][1]
                runs.setdefault(kept_run(len(w)), []).append(gram_hashes(w, kept_run(len(w))))
            for r, g in runs.items():
                every.setdefault(r, []).extend(g)
            self.classes.append((size, {r: HashSet(np.concatenate(g), 16) for r, g in runs.items()}, tables))
        self.runs = {r: HashSet(np.concatenate(g)) for r, g in every.items()}
        self.places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        of: dict[int, list[int]] = {}
        for k, (_, w) in enumerate(self.items):
            of.setdefault(kept_run(len(w)), []).append(k)
        for r, members in of.items():
            grams = [gram_hashes(self.items[k][1], r) for k in members]
            flat, size = np.concatenate(grams), np.array([len(g) for g in grams])
            order = np.argsort(flat, kind="stable")
            offset = np.concatenate([np.arange(n) for n in size])
            self.places[r] = flat[order], np.repeat(np.array(members), size)[order], offset[order]
        length = np.array([len(w) for _, w in self.items], dtype=np.int64)
        self.edits = (length - 1) // 5
        run = np.array([kept_run(n) for n in length.tolist()], dtype=np.int64)
        self.least_runs = np.maximum(1, length - run + 1 - self.edits * run)

    def _by_runs(self, r: int, at: np.ndarray, grams: np.ndarray, begin: np.ndarray) -> set[tuple[int, int]]:
        """``(item, passage start)`` of places with as many of an item's runs of r words as the allowed edits must leave."""
        flat, members, offset = self.places[r]
        found: set[tuple[int, int]] = set()
        lo, hi = np.searchsorted(flat, grams, side="left"), np.searchsorted(flat, grams, side="right")
        doc = np.searchsorted(begin, at, side="right") - 1
        total = np.cumsum(hi - lo)
        a = 0
        # Texts don't share passages, so pieces end between texts.
        while a < len(at):
            b = int(np.searchsorted(total, (total[a - 1] if a else 0) + PLACES, side="right"))
            b = int(np.searchsorted(doc, doc[min(max(b, a), len(at) - 1)], side="left"))
            if b <= a:
                b = int(np.searchsorted(doc, doc[a], side="right"))
            n = hi[a:b] - lo[a:b]
            here = np.repeat(np.arange(a, b), n)
            entry = np.arange(len(here)) - np.repeat(np.cumsum(n) - n, n) + lo[here]
            k, d, start = members[entry], doc[here], at[here] - offset[entry]
            order = np.lexsort((start, d, k))
            k, d, start = k[order], d[order], start[order]
            last = np.arange(len(k)) + self.least_runs[k] - 1
            inside = np.minimum(last, len(k) - 1)
            ok = (last < len(k)) & (k[inside] == k) & (d[inside] == d) & (start[inside] - start <= 2 * self.edits[k])
            again = np.zeros(len(k), dtype=bool)
            again[1:] = (k[1:] == k[:-1]) & (d[1:] == d[:-1]) & (self.edits[k[1:]] == 0)
            ok &= ~again  # an exact match is as good as any other
            found.update(zip(k[ok].tolist(), np.maximum(start[ok], begin[d[ok]]).tolist()))
            a = b
        return found

    def _candidates(self, words: np.ndarray, begin: np.ndarray) -> set[tuple[int, int]]:
        """``(item, window start)`` of matching keys, and of places with enough runs, in texts laid end to end."""
        found: set[tuple[int, int]] = set()
        near: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for r, runs in self.runs.items():
            grams = gram_hashes(words, r)
            at = runs.find(grams)
            at = at[at + r <= begin[np.searchsorted(begin, at, side="right")]]
            near[r] = at, grams[at]
            found |= self._by_runs(r, *near[r], begin)
        for size, runs, tables in self.classes:
            at = np.concatenate([near[r][0][known.find(near[r][1])] for r, known in runs.items()])
            if not len(at):
                continue
            most = size * 9 // 8 + 1
            allowed = edits_allowed(most)
            doc = np.searchsorted(begin, at, side="right")
            # Window starts around the kept runs, every few words: a shift costs an edit or two.
            mark = np.zeros(len(words) + 1, dtype=np.int32)
            np.add.at(mark, np.maximum(begin[doc - 1], at - most - allowed), 1)
            np.add.at(mark, np.minimum(begin[doc], at + allowed + 1), -1)
            starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            starts = starts[starts % max(1, size // 24) == 0]
            limit = begin[np.searchsorted(begin, starts, side="right")]
            for walk in range(WALKS):
                outputs = embed(words, starts, size, limit, walk)
                for (keys, members), key in zip(tables[walk * SAMPLES : (walk + 1) * SAMPLES], sampled_keys(outputs, size, walk)):
                    lo, hi = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
                    for w in np.flatnonzero(hi > lo).tolist():
                        found.update((k, int(starts[w])) for k in members[lo[w] : hi[w]].tolist())
        return found

    def hits(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text ``(item, distance, first word, words)`` of the best passage of each item found in it."""
        out: list[list[tuple[int, int, int, int]]] = []
        held, size = [], 0
        for i, t in enumerate(texts):
            held.append(t)
            size += len(t or "")
            if size >= BLOCK_BYTES or i == len(texts) - 1:
                out += self._block(held)
                held, size = [], 0
        return out

    def _block(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        words, begin = word_hashes(texts)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        if len(words) and self.items:
            done: dict[tuple[int, int], int] = {}
            for k, at in sorted(self._candidates(words, begin)):
                item, w = self.items[k]
                doc = int(np.searchsorted(begin, at, side="right")) - 1
                # Windows that begin close to one already verified lie within the passage looked at then.
                if at <= done.get((doc, k), -1):
                    continue
                done[doc, k] = at + len(w) // 2
                allowed = edits_allowed(len(w))
                a, b = max(begin[doc], at - allowed), min(begin[doc + 1], at + 2 * len(w) + 2 * allowed)
                distance, end = best_distance(w, words[a:b])
                if distance <= allowed and ((doc, k) not in best or distance < best[doc, k][1]):
                    _, size = best_distance(w[::-1], words[a : a + end][::-1])
                    best[doc, k] = (item, distance, int(a - begin[doc]) + end - size, size)
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        for (doc, _), found in sorted(best.items()):
            out[doc].append(found)
        return out


def _parts(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """Indexes of the benchmark's items, each of at most PART_BYTES of text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("i is not null and t is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-size // PART_BYTES))
    for part in range(n):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == part).orderBy("i", "t").collect()
        yield Index([r["i"] for r in rows], [r["t"] for r in rows])


def contaminations(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, distance, first_word, n_words)``: each item found in a document, with its best passage.

    distance is in words and less than a fifth of the item's words (none in items
    under six words). Items without words, with a null id or a null text aren't
    searched; null and empty documents hold nothing; whole texts are searched,
    however long; of repeated items and of repeated documents each gives its rows.
    Empty tables give an empty result; other columns are ignored.
    """
    out = None
    for index in _parts(benchmark, item_col, item_text_col):
        handle = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], handle=handle) -> Iterator[pa.RecordBatch]:
            index = handle.value
            for b in parts(batches):
                rows = [(d, *h) for d, found in zip(b.column(0).to_pylist(), index.hits(b.column(1).to_pylist())) for h in found]
                cols = list(zip(*rows)) if rows else [()] * 5
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "item_id", "distance", "first_word", "n_words"])

        found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, item_id long, distance int, first_word long, n_words long")
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` in which no item is found, unchanged; rows without text or id stay, repeated rows each count."""
    where = docs.columns.index(text_col)
    schema = docs.schema
    for index in _parts(benchmark, item_col, item_text_col):
        handle = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], handle=handle) -> Iterator[pa.RecordBatch]:
            index = handle.value
            for b in parts(batches):
                yield b.filter(pa.array([not found for found in index.hits(b.column(where).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
