"""SimHash near-duplicates found through Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last is
padded to 23). If two fingerprints differ in at most two bits, at least one of
the three segments agrees exactly, and the next segment differs in at most two.
The perfect (23, 12, 7) Golay code gives every 23-bit word the codewords within
distance 4: one for words within 2 of a codeword, six for words at distance 3.
Two words that differ in at most two bits always share one of these. So the
pairs (segment number, exact segment, codeword of the next segment) are join
keys that lose no link, and a key match is verified by counting differing bits.

Keys shared by many fingerprints are linked without pairs: two words differ in
at most two bits exactly if some word lies within one bit of both, so every
member names its 65 such centres and joins the least member of each centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.suffix import with_row_key
from chronoloom.operators.components import connected_components
from chronoloom.sources.shared import materialize

#: Fixed value: a generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))


@lru_cache(maxsize=1)
def golay_neighbours() -> tuple[np.ndarray, np.ndarray]:
    """For each 23-bit word its codewords (as 12-bit messages) within distance 4: ``(flat, offset)``.

    Built from the code itself: each of the 4096 codewords is written to the
    words at distance up to 4 from it.
    """
    message = np.arange(4096, dtype=np.int64)
    code = np.zeros(4096, dtype=np.int64)
    for i in range(12):
        code ^= np.where((message >> i) & 1, GENERATOR << i, 0)
    masks = [0]
    one = [1 << i for i in range(23)]
    for i in range(23):
        masks.append(one[i])
        for j in range(i):
            masks.append(one[i] | one[j])
            for k in range(j):
                masks.append(one[i] | one[j] | one[k])
    near = np.full((1 << 23), -1, dtype=np.int16)
    distance = np.zeros(1 << 23, dtype=np.int8)
    for m in masks:
        near[code ^ m] = message
        distance[code ^ m] = bin(m).count("1")
    return near, distance


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, message)`` of every codeword within distance 4 of ``words[row]``."""
    near, distance = golay_neighbours()
    words = words.astype(np.int64)
    rows, keys = [np.arange(len(words))], [near[words].astype(np.int64)]
    far = np.flatnonzero(distance[words] == 3)
    seen = []
    # A codeword at distance 4 is the nearest one of the words one bit towards it, which lie at distance 3 from it.
    for i in range(23):
        step = words[far] ^ (1 << i)
        seen.append(np.where(distance[step] == 3, near[step].astype(np.int64), -1))
    if len(far):
        table = np.sort(np.stack(seen, axis=1), axis=1)
        first = np.ones_like(table, dtype=bool)
        first[:, 1:] = table[:, 1:] != table[:, :-1]
        own = table == near[words[far]].astype(np.int64)[:, None]
        at = np.nonzero(first & ~own & (table >= 0))
        rows.append(far[at[0]])
        keys.append(table[at])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of a text as an unsigned 64-bit number; 0 for null and for texts without words.

    A-Z are lower-cased, words are runs of anything but space and 0x09-0x0D,
    shingles of ``width`` words count as often as they occur (fewer words: the
    whole sequence), each hashed by XXH64 with seed 42. A bit is set if it is
    set in over half of the hashes.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist())
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], 42) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 8192):  # bounded memory for very long texts
        part = h[at : at + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts(batches):
        fp = np.fromiter((fingerprint(t) for t in b.column(1).to_pylist()), dtype=np.uint64, count=b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``: fp is the fingerprint as a signed 64-bit number."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return picked.mapInArrow(_fingerprints, "doc_id long, fp long")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        segments = [(fp >> np.uint64(at)) & np.uint64((1 << bits) - 1) for at, bits in SEGMENTS]
        rows, keys = [], []
        for s in range(3):
            row, message = golay_keys(segments[(s + 1) % 3].astype(np.int64))
            rows.append(row)
            keys.append((np.int64(s) << 36) | (segments[s].astype(np.int64)[row] << 12) | message)
        row = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(fp.view(np.int64)[row])], names=["key", "fp"])


def fingerprint_keys(rows: DataFrame) -> DataFrame:
    """``(key, node)`` and ``fp`` for the Golay keys of ``rows (fp, node)``: fingerprints within two bits share a key."""
    keys = rows.select("fp").distinct().mapInArrow(_keys, "key long, fp long")
    return keys.join(rows, "fp").select("key", "node", "fp")


def fingerprint_links(fps: DataFrame, max_bucket: int = 512) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of "at most two differing bits" among distinct ``fp``.

    Keys with at most ``max_bucket`` fingerprints are joined and each match is
    verified; larger ones link through centres. Both ways are exact.
    """
    keys = materialize(fps.mapInArrow(_keys, "key long, fp long"), "golay")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialize(keys.join(sizes, "key"), "golay")
    small = shared.filter(F.col("n") <= max_bucket)
    a, b = small.select("key", F.col("fp").alias("u")), small.select("key", F.col("fp").alias("v"))
    near = (a["key"] == b["key"]) & (a["u"] < b["v"]) & (F.bit_count(a["u"].bitwiseXOR(b["v"])) <= 2)
    pairs = a.join(b, near).select("u", "v").distinct()
    hot = shared.filter(F.col("n") > max_bucket).select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(64)), lambda i: F.when(i < 64, F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))).otherwise(F.col("fp")))
    centres = hot.select("fp", F.explode(flips).alias("c"))
    least = centres.groupBy("c").agg(F.min("fp").alias("u"), F.count("*").alias("n")).filter("n > 1").select("c", "u")
    stars = centres.join(least, "c").filter("u < fp").select("u", F.col("fp").alias("v"))
    return pairs.union(stars)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``(doc_id, fingerprint, component_id)`` for every document.

    Documents whose fingerprints differ in at most two bits are linked;
    component_id is the smallest doc_id reachable. Null, empty and blank texts
    have fingerprint zero and are linked like any other. An empty table gives
    an empty result; other columns of ``docs`` are ignored.
    """
    fps = materialize(with_fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    distinct = materialize(distinct, "distinct")
    groups = connected_components(fingerprint_links(distinct.select("fp")))
    known = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("g"))
    least = known.groupBy("g").agg(F.min("first").alias("component_id"))
    named = known.join(least, "g").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_rows(keyed: DataFrame, key: str, components: DataFrame, id_col: str) -> DataFrame:
    """Rows that come first in their component by ``(id, key)``, rows without an id last; ``components (row, component)``."""
    ids = keyed.select(F.col(key).alias("row"), F.col(id_col).cast("long").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "row")
    first = components.join(ids, "row").groupBy("component").agg(F.min(order)["row"].alias("row"))
    return keyed.join(first, keyed[key] == first["row"], "left_semi").drop(key)


def first_of_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that come first, by id, in their component, unchanged; each row counts by its own text, whatever its id.

    A row without an id stays only where no row of its component has one.
    """
    keyed, key = with_row_key(docs)
    components = simhash_components(keyed, key, text_col).select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    return first_rows(keyed, key, components, id_col)
