"""License notices in documents: MinHash bands over windows, verified by shingle containment.

A template of n words is looked for in windows of n words at every place where
one of its shingles occurs (a window without any can't contain four fifths of
them). Windows and templates have MinHash signatures; templates that agree with a
window in a band are its candidates. A window that holds the share c of a
template's shingles has a Jaccard similarity of at least c / (2 - c), so with
c = 0.8, two rows a band and BANDS bands a template is missed with a probability
of (1 - (2/3)**2)**20 < 1e-5; a full copy never is. Candidates are verified by
counting shingles exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.suffix import mix
from chronoloom.llm.words import HashSet, gram_hashes, word_hashes

SHINGLE, CONTAINED, BANDS, ROWS = 5, 0.8, 20, 2
#: Bytes of documents searched at once.
BLOCK_BYTES = 4 << 20

#: The public notices by which licenses are named.
NOTICES = (
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("mit", "Released under the MIT License."),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
)


class Templates:
    """Templates by length in words, with the band keys of their signatures."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        words, begin = word_hashes([t for _, t in templates])
        self.by_length: dict[int, list[tuple[str, np.ndarray]]] = {}
        for (name, _), a, b in zip(templates, begin[:-1], begin[1:]):
            if b > a:
                self.by_length.setdefault(int(b - a), []).append((name, np.unique(gram_hashes(words[a:b], min(SHINGLE, int(b - a))))))
        self.known = {n: HashSet(np.concatenate([s for _, s in own]), 16) for n, own in self.by_length.items()}
        self.bands: dict[int, list[dict[int, list[int]]]] = {}
        for n, own in self.by_length.items():
            tables: list[dict[int, list[int]]] = [{} for _ in range(BANDS)]
            for k, (_, s) in enumerate(own):
                for table, key in zip(tables, self.keys(s[None])):
                    table.setdefault(int(key[0]), []).append(k)
            self.bands[n] = tables

    @staticmethod
    def keys(shingles: np.ndarray) -> Iterator[np.ndarray]:
        """A key for each band, of rows of shingle hashes."""
        for band in range(BANDS):
            key = np.full(len(shingles), band, dtype=np.uint64)
            for row in range(ROWS):
                key = mix(key + mix(shingles ^ mix(np.uint64([band * ROWS + row + 1]))).min(axis=1))
            yield key

    def find(self, texts: list[str | None]) -> list[list[tuple[str, float, int, int]]]:
        """For each text ``(template, containment, first word, places)``: the best place, the first of equals, and how many there are."""
        out: list[list[tuple[str, float, int, int]]] = []
        held, size = [], 0
        for i, t in enumerate(texts):
            held.append(t)
            size += len(t or "")
            if size >= BLOCK_BYTES or i == len(texts) - 1:
                out += self._block(held)
                held, size = [], 0
        return out

    def _block(self, texts: list[str | None]) -> list[list[tuple[str, float, int, int]]]:
        words, begin = word_hashes(texts)
        out: list[list[tuple[str, float, int, int]]] = [[] for _ in texts]
        grams = {q: gram_hashes(words, q) for q in {min(SHINGLE, n) for n in self.by_length}}
        for n, own in sorted(self.by_length.items()):
            q = min(SHINGLE, n)
            g, width = grams[q], n - q + 1
            at = self.known[n].find(g)
            at = at[at + q <= begin[np.searchsorted(begin, at, side="right")]]  # not across texts
            if not len(at):
                continue
            doc = np.searchsorted(begin, at, side="right")
            mark = np.zeros(len(words) + 1, dtype=np.int32)
            np.add.at(mark, np.maximum(begin[doc - 1], at - width + 1), 1)
            np.add.at(mark, at + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            found: dict[tuple[int, int], list[tuple[float, int]]] = {}
            for part in np.array_split(starts, max(1, len(starts) * width >> 20)):
                owner = np.searchsorted(begin, part, side="right")
                last = begin[owner] - q  # a text's last shingle stands in for those behind its end
                s = g[np.minimum(part[:, None] + np.arange(width), last[:, None])]
                for table, key in zip(self.bands[n], self.keys(s)):
                    for w in np.flatnonzero(np.isin(key, np.array(list(table), dtype=np.uint64))).tolist():
                        for k in table[int(key[w])]:
                            place = int(owner[w]) - 1, k
                            spot = int(part[w] - begin[owner[w] - 1])
                            if not any(spot == x for _, x in found.get(place, ())):
                                share = float(np.isin(own[k][1], s[w]).mean())
                                if share >= CONTAINED:
                                    found.setdefault(place, []).append((share, spot))
            for (d, k), spots in found.items():
                share, first = min((-c, x) for c, x in spots)
                places, reach = 0, -1
                for x in sorted(x for _, x in spots):
                    if x > reach:
                        places, reach = places + 1, x + n - 1
                out[d].append((own[k][0], -share, first, places))
        return [sorted(x) for x in out]


def license_matches(docs: DataFrame, templates: Sequence[tuple[str, str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, template_id, containment, first_word, n_places)`` of every template that a document holds.

    Shingles have five words (a shorter template is one shingle); containment is
    the share of a template's distinct shingles within one window, at least 0.8.
    Null and empty texts and templates without words match nothing; repeated
    documents give repeated rows; an empty table gives an empty result; other
    columns are ignored. The templates are a parameter that goes to each task.
    """
    handle = docs.sparkSession.sparkContext.broadcast(Templates(tuple(templates)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = handle.value
        for b in parts(batches):
            rows = [(d, *m) for d, found in zip(b.column(0).to_pylist(), known.find(b.column(1).to_pylist())) for m in found]
            cols = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "template_id", "containment", "first_word", "n_places"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return picked.mapInArrow(run, "doc_id long, template_id string, containment double, first_word long, n_places long")
