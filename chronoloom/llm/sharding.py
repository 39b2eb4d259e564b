"""Shards of near-equal bytes: a minimax contiguous partition of atomic groups.

Equal texts form a group that stays together; groups are ordered by a 64-bit
hash of the text. The smallest capacity that a greedy cut into ``shards`` pieces
can keep is found by binary search. The search runs on sums over ranges of the
hash: a range counts as indivisible for an upper bound of the capacity and as
divisible anywhere for a lower one, and only ranges at possible cuts are divided
further until the bounds meet. So the driver sees a bounded number of sums and
never a group each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from chronoloom.sources.shared import materialize

#: Bits of the first ranges, bits added by each division, ranges divided at once.
FIRST_BITS, MORE_BITS, AT_ONCE = 16, 8, 512
#: A slot is counted within at most this many pieces of the table, besides the ranges.
PIECES = 4096


class Ranges:
    """Sums over consecutive hash ranges, in order: start, bits, bytes, and whether one group makes up all of it."""

    def __init__(self, rows: list[tuple[int, int, int, bool]]):
        rows = sorted(rows)
        self.start = [r[0] for r in rows]
        self.bits = [r[1] for r in rows]
        self.atomic = np.array([r[3] for r in rows], dtype=bool)
        self.bytes = np.array([r[2] for r in rows], dtype=np.int64)
        self.sums = np.concatenate(([0], np.cumsum(self.bytes)))

    def greedy(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Positions (in bytes) of the cuts that fill each shard as far as capacity allows, the last one's end included."""
        at, cuts = 0, []
        for _ in range(shards):
            to = int(np.searchsorted(self.sums, at + capacity, side="right")) - 1
            if to < len(self.bytes) and divisible and not self.atomic[to]:
                at = at + capacity
            else:
                at = int(self.sums[to]) if self.sums[to] > at else at
            cuts.append(at)
        return cuts

    def least(self, shards: int, divisible: bool) -> int:
        """The smallest capacity whose greedy cut takes everything, by binary search."""
        total = int(self.sums[-1])
        lo, hi = -(-total // shards), total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.greedy(mid, shards, divisible)[-1] >= total:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def to_divide(self, shards: int, low: int, high: int) -> list[int]:
        """Divisible ranges in which a cut for some capacity from low to high may fall, the largest first."""
        open_ = np.zeros(len(self.bytes), dtype=bool)
        for a, b in zip(self.greedy(low, shards, False), self.greedy(high, shards, True)):
            first = max(0, int(np.searchsorted(self.sums, a, side="right")) - 1)
            last = int(np.searchsorted(self.sums, b, side="left"))
            open_[first : last + 1] = True
        who = np.flatnonzero(open_ & ~self.atomic)
        return who[np.argsort(-self.bytes[who], kind="stable")][:AT_ONCE].tolist()


def _sums(rows: DataFrame, bits: int) -> list[tuple[int, int, int, bool]]:
    got = rows.groupBy(F.shiftright("h", 64 - bits).alias("p")).agg(F.sum("size").alias("s"), F.min("h").alias("a"), F.max("h").alias("z")).collect()
    return [(r["p"] << (64 - bits), bits, r["s"], r["a"] == r["z"] or bits == 64) for r in got]


def minimax_cuts(keyed: DataFrame, shards: int) -> tuple[list[int], int]:
    """Hash values at which shards after the first begin, and the capacity; of a table (h, size)."""
    ranges = Ranges(_sums(keyed, FIRST_BITS))
    if not len(ranges.bytes):
        return [], 0
    while True:
        low, high = ranges.least(shards, True), ranges.least(shards, False)
        divide = ranges.to_divide(shards, low, high) if low < high else []
        if not divide:
            break
        rows = [r for i, r in enumerate(zip(ranges.start, ranges.bits, ranges.bytes.tolist(), ranges.atomic.tolist())) if i not in set(divide)]
        for bits in sorted({ranges.bits[i] for i in divide}):
            prefixes = [ranges.start[i] >> (64 - bits) for i in divide if ranges.bits[i] == bits]
            rows += _sums(keyed.filter(F.shiftright("h", 64 - bits).isin(prefixes)), bits + MORE_BITS)
        ranges = Ranges(rows)
    cuts, out = ranges.greedy(high, shards, False), []
    for c in cuts[:-1]:
        to = int(np.searchsorted(ranges.sums, c, side="left"))
        if to < len(ranges.start):
            out.append(ranges.start[to])
    return out, high


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every document.

    size is the text's UTF-8 bytes plus 1 (null: 1), text_crc32 unsigned (null:
    0). Equal texts, repeated rows included, share a shard; nulls are a group of
    their own. The largest shard is as small as any cut of the ordered groups
    allows; if one group exceeds all others, later shards may be empty. Slots run
    from 0 without gaps. grown_shard is null: another shard would move other
    rows too. An empty table gives an empty result.
    """
    t = F.col(text_col)
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(t), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(t.isNull(), F.xxhash64(F.lit(0))).otherwise(F.xxhash64(t)).alias("h"),
    )
    base = materialize(base, "sized")
    cuts, _ = minimax_cuts(base.select("h", "size"), shards)
    shard = sum(((F.col("h") >= c).cast("int") for c in cuts), F.lit(0))
    placed = base.withColumn("shard", shard).withColumn("p", F.shiftright("h", 64 - FIRST_BITS))
    # Ranges with many rows are dealt into pieces, so that no task numbers more than a few thousandths of the table.
    share = max(1, base.count() // PIECES)
    dense = base.groupBy(F.shiftright("h", 64 - FIRST_BITS).alias("p")).agg(F.count("*").alias("n")).filter(F.col("n") > share)
    dense = dense.select("p", F.ceil(F.col("n") / share).alias("pieces"))  # at most PIECES rows
    salted = placed.join(F.broadcast(dense), "p", "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("doc_id", F.rand(7)), F.col("pieces")), F.lit(0)))
    return _slots(salted)


def _slots(salted: DataFrame) -> DataFrame:
    salted = materialize(salted.drop("pieces"), "placed")  # a piece drawn once stays
    key = ["shard", "p", "piece"]
    counts = salted.groupBy(*key).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("p", "piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*key, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy(*key).orderBy("h", "doc_id"))
    return salted.join(offsets, key).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + own - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
