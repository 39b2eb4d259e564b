"""Texts as arrays of word hashes, for operators that look for known passages."""

from __future__ import annotations

import re

import numpy as np

from chronoloom.llm.suffix import CHUNK, _tables, mix, prefix_hashes

#: Words: runs of ASCII letters, digits and underscores and of any character beyond ASCII, lower-cased.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), 95, *range(97, 123), *range(128, 256)]] = True
_BREAK = re.compile(rb"[^0-9a-z_\x80-\xff]")


def _hash_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in a buffer that begins and ends with a space, and where they start."""
    x = np.frombuffer(data, dtype=np.uint8)
    edge = np.diff(_IN_WORD[x].astype(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    sums, down = prefix_hashes(x), _tables()[2]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)), start


def _pieces(data: bytes) -> list[bytes]:
    """A long text cut at breaks between words (within a word only if it fills a whole piece)."""
    out, at = [], 0
    while len(data) - at > CHUNK - 2:
        cut = at + CHUNK - 2
        back = max((m.start() for m in _BREAK.finditer(data, max(at + 1, cut - 4096), cut)), default=cut)
        out.append(data[at:back])
        at = back
    out.append(data[at:])
    return out


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text's begin (one entry more than texts)."""
    folded = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    hashes, counts = [], np.zeros(len(texts), dtype=np.int64)
    held, who, size = [], [], 2

    def flush() -> None:
        nonlocal held, who, size
        if held:
            h, start = _hash_block(b" " + b" ".join(held) + b" ")
            begin = np.cumsum([1, *(len(d) + 1 for d in held)])
            np.add.at(counts, who, np.diff(np.searchsorted(start, begin)))
            hashes.append(h)
        held, who, size = [], [], 2

    for i, d in enumerate(folded):
        for piece in _pieces(d) if len(d) > CHUNK - 2 else (d,):
            if size + len(piece) + 1 > CHUNK:
                flush()
            held.append(piece)
            who.append(i)
            size += len(piece) + 1
    flush()
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), np.concatenate(([0], np.cumsum(counts)))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n words in a row (none if there are fewer)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = mix(out + words[k : len(words) - n + 1 + k] + np.uint64(k))
    return out


class HashSet:
    """Membership of 64-bit hashes: a table of bits first, then a sorted array."""

    def __init__(self, values: np.ndarray, bits: int = 22):
        self.values = np.unique(values)
        self.mask = np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[(self.values & self.mask).astype(np.int64)] = True

    def find(self, x: np.ndarray) -> np.ndarray:
        """Positions of members in ``x``."""
        at = np.flatnonzero(self.table[(x & self.mask).astype(np.int64)])
        if not len(self.values):
            return at[:0]
        near = np.minimum(np.searchsorted(self.values, x[at]), len(self.values) - 1)
        return at[self.values[near] == x[at]]
