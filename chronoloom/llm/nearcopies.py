"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates share a key. Keys are of two kinds: Golay keys of SimHash fingerprints
of the shingles (``simhash``; such a pair counts if the fingerprints differ in at
most two bits), and bands of MinHash values. At a similarity of 0.8 fingerprints
differ in about ten of 64 bits, a radius at which Golay keys select nothing; 24
bands of six values miss a pair at 0.8 with a probability of (1 - 0.8**6)**24 =
0.0007. A candidate whose 144 MinHash values agree in less than 0.7 is dropped
(three standard deviations below 0.8: one in 750 pairs at exactly 0.8, one in
50,000 at 0.83); each other is verified by the exact similarity of the two sets
of (64-bit hashed) shingles.

Equal sets are one node. Every key's bucket is first linked as a star to one
member, the same for all keys of a group of close copies; then only pairs that
aren't connected yet are compared, so that a large group costs no pairs. What is
left of a small bucket meets in a join; that of a larger one, whatever its size,
is cut into blocks, of which each task compares two in arrays: by 512 further
MinHash values made for these texts alone, so that what is far from 0.8 stays out
(again three standard deviations) and only likely pairs come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.llm.simhash import fingerprint_keys, first_rows
from chronoloom.llm.suffix import mix, with_row_key
from chronoloom.llm.words import gram_hashes
from chronoloom.operators.components import connected_components
from chronoloom.sources.shared import drop_shared, materialize

WIDTH = 5
BANDS, VALUES = 24, 6
#: Members of a bucket whose pairs a join makes, and of the blocks that larger ones are cut into.
FEW, BLOCK = 32, 1024
#: Share of equal MinHash values below which a pair isn't verified.
LIKELY = 0.7
#: Values of texts in large buckets, and their share.
WIDE, WIDE_LIKELY = 512, 0.747
#: Buckets with more components than this get further stars before their pairs are compared.
CROWD = 64
_RNG = np.random.default_rng(58)
_XOR, _ODD = (_RNG.integers(0, 1 << 63, (BANDS * VALUES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(k) for k in (0, 1))
_XOR_WIDE, _ODD_WIDE = (_RNG.integers(0, 1 << 63, (WIDE, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(k) for k in (0, 1))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles; fewer words than ``width``: one of all words; none: empty.

    Words are those of ``simhash.fingerprint``.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(w, 42) for w in words), dtype=np.uint64, count=len(words))
    return np.unique(gram_hashes(h, min(width, len(h)))) if len(h) else h


def signature(s: np.ndarray) -> tuple[int, np.ndarray, bytes]:
    """SimHash fingerprint of a set of shingles, the keys of its MinHash bands (none for the empty set), and a byte of each MinHash value."""
    if not len(s):
        return 0, np.zeros(0, dtype=np.int64), b""
    least = np.full(BANDS * VALUES, (1 << 64) - 1, dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(s), 1024):  # bounded memory for very long texts
        part = s[at : at + 1024]
        least = np.minimum(least, ((part[None, :] ^ _XOR) * _ODD).min(axis=1))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    table = least.reshape(BANDS, VALUES)
    key = mix(np.arange(BANDS, dtype=np.uint64))
    for k in range(VALUES):
        key = mix(key + table[:, k])
    return int(np.packbits(2 * ones > len(s), bitorder="little").view("<i8")[0]), key.view(np.int64), mix(least).astype(np.uint8).tobytes()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts(batches):
        rows = []
        for t in b.column(1).to_pylist():
            s = shingles(t)
            rows.append((xxhash.xxh3_128_digest(s.tobytes()), len(s), *signature(s)))
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["row", "digest", "n", "fp", "bands", "values"])


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A byte of each of WIDE MinHash values of texts."""
    for b in parts(batches):
        out = []
        for t in b.column(1).to_pylist():
            s = shingles(t)
            least = np.full(WIDE, (1 << 64) - 1, dtype=np.uint64)
            for at in range(0, len(s), 256):
                least = np.minimum(least, ((s[at : at + 256][None, :] ^ _XOR_WIDE) * _ODD_WIDE).min(axis=1))
            out.append(mix(least).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["node", "values"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts(batches, 256):
        sets = [shingles(t).view(np.int64) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "s"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(u, v, a, b)`` of whose MinHash bytes enough agree."""
    for b in batches:
        a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1) for k in (2, 3))
        keep = pa.array((a == c).mean(axis=1) >= LIKELY if b.num_rows else np.zeros(0, dtype=bool))
        yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["u", "v"])


def _tile(t: pa.Table) -> pa.Table:
    """Likely pairs of two blocks of a bucket, or within one."""
    side, node, n, fp, c = (t.column(k).to_numpy() for k in ("side", "node", "n", "fp", "c"))
    values = np.frombuffer(b"".join(t.column("values").to_pylist()), dtype=np.uint8).reshape(len(node), -1)
    x = np.flatnonzero(side == 0)
    y = x if t.column("i")[0].as_py() == t.column("j")[0].as_py() else np.flatnonzero(side == 1)
    golay, u, v = t.column("golay")[0].as_py(), [], []
    for at in range(0, len(x), 128):
        a = x[at : at + 128]
        equal = np.zeros((len(a), len(y)), dtype=np.uint16)
        for k in range(values.shape[1]):
            equal += values[a, k][:, None] == values[y, k][None]
        near = (equal >= WIDE_LIKELY * WIDE) & (c[a][:, None] != c[y][None])
        near &= 5 * np.minimum(n[a][:, None], n[y][None]) >= 4 * np.maximum(n[a][:, None], n[y][None])
        if golay:
            near &= np.bitwise_count((fp[a][:, None] ^ fp[y][None]).view(np.uint64)) <= 2
        i, j = np.nonzero(near)
        u.append(np.minimum(node[a[i]], node[y[j]]))
        v.append(np.maximum(node[a[i]], node[y[j]]))
    pairs = np.unique(np.stack((np.concatenate(u), np.concatenate(v))), axis=1) if u else np.zeros((2, 0), dtype=np.int64)
    return pa.table({"u": pairs[0], "v": pairs[1]})


def _verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, likely_too: DataFrame | None = None) -> DataFrame:
    """Pairs ``(u, v)`` whose sets have a Jaccard similarity of at least 0.8: nine times the common part is four times the sum of sizes."""
    a, b = (nodes.select(F.col("node").alias(k), F.col("values").alias(x)) for k, x in (("u", "a"), ("v", "b")))
    likely = pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(_likely, "u long, v long")
    likely = materialize(likely if likely_too is None else likely.union(likely_too).distinct(), "likely")
    wanted = likely.select(F.col("u").alias("node")).union(likely.select("v")).distinct()
    sets = rows.join(wanted, rows["row"] == wanted["node"], "left_semi").select("row", "t").mapInArrow(_sets, "node long, s array<long>")
    a, b = (sets.select(F.col("node").alias(k), F.col("s").alias(x)) for k, x in (("u", "a"), ("v", "b")))
    common = F.size(F.array_intersect("a", "b"))
    links = materialize(likely.join(a, "u").join(b, "v").filter(9 * common >= 4 * (F.size("a") + F.size("b"))).select("u", "v"), "near-links")
    drop_shared(likely)
    return links


#: What a candidate must fulfil: sizes that a similarity of 0.8 allows, and for Golay keys fingerprints within two bits.
_ALIKE = "5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) and (not a.golay or bit_count(a.fp ^ b.fp) <= 2)"


def near_copy_components(rows: DataFrame) -> DataFrame:
    """``(row, component)`` for ``rows (row long, t string)`` with distinct ``row``: the least row that links of near copies reach.

    Null, empty and blank texts have the empty set, and are copies of each other.
    """
    sigs = materialize(rows.mapInArrow(_signatures, "row long, digest binary, n long, fp long, bands array<long>, values binary"), "signatures")
    first = materialize(sigs.groupBy("digest").agg(F.min("row").alias("node")), "sets")
    nodes = materialize(sigs.join(first, F.col("row") == F.col("node"), "left_semi").filter("n > 0").select(F.col("row").alias("node"), "n", "fp", "bands", "values"), "nodes")
    bands = nodes.select(F.explode("bands").alias("key"), "node", "n", "fp", F.lit(False).alias("golay"))
    golay = fingerprint_keys(nodes.select("fp", "node")).join(nodes.select("node", "n"), "node").select("key", "node", "n", "fp", F.lit(True).alias("golay"))
    keys = bands.union(golay)
    kind = ["golay", "key"]
    shared = materialize(keys.join(keys.groupBy(kind).agg(F.count("*").alias("c")).filter("c > 1").select(kind), kind), "bands")
    done = [nodes, shared]

    def stars(table: DataFrame, salt: int) -> DataFrame:
        """Pairs of each bucket's leader and its members outside the leader's component."""
        order = F.struct(F.xxhash64("node", F.lit(salt)), "node", "n", "fp", "c", "golay")
        lead = table.groupBy(kind).agg(F.min(order).alias("l")).select(F.col("key").alias("k"), F.col("golay").alias("g"), "l.*").alias("b")
        met = table.alias("a").join(lead, F.expr("a.key = b.k and a.golay = b.g")).filter("a.c != b.c").filter(_ALIKE)
        return met.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()

    links = _verified(stars(shared.withColumn("c", F.col("node")), 0), nodes, rows)
    for salt in range(1, 5):
        groups = materialize(connected_components(links), "near-groups")
        known = shared.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
        left = materialize(known.join(known.groupBy(kind).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select(kind), kind), "apart")
        done += [links, groups, left]
        if salt == 4 or left.groupBy(kind).agg(F.count_distinct("c").alias("c")).filter(F.col("c") > CROWD).isEmpty():
            break
        links = materialize(links.union(_verified(stars(left, salt), nodes, rows)), "near-links")
    sized = left.join(left.groupBy(kind).agg(F.count("*").alias("m")), kind)
    few = sized.filter(F.col("m") <= FEW)
    met = few.alias("a").join(few.alias("b"), kind).filter("a.c < b.c").filter(_ALIKE)
    many = sized.filter(F.col("m") > FEW)
    crowded = many.select("node").distinct()
    wide = rows.join(crowded, rows["row"] == crowded["node"], "left_semi").select("row", "t").mapInArrow(_wide, "node long, values binary")
    many = many.join(wide, "node").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    tile = lambda t: F.struct(F.least(F.col("own"), t).alias("i"), F.greatest(F.col("own"), t).alias("j"), F.when(F.col("own") <= t, 0).otherwise(1).alias("side"))
    spread = many.withColumn("own", own).withColumn("to", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), tile)))
    tiles = spread.select(*kind, "to.*", "node", "n", "fp", "c", "values").groupBy(*kind, "i", "j").applyInArrow(_tile, "u long, v long")
    pairs = met.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()
    groups = connected_components(links.union(_verified(pairs, nodes, rows, tiles)))
    named = first.join(groups, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    out = materialize(sigs.join(named, "digest").select("row", "component"), "near-copies")
    drop_shared(sigs, first, *done)
    return out


def first_of_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row, by id, of each group of near copies, unchanged; each row counts by its own text, whatever its id."""
    keyed, key = with_row_key(docs)
    rows = keyed.select(F.col(key).alias("row"), F.col(text_col).alias("t"))
    return first_rows(keyed, key, near_copy_components(rows), id_col)
