"""Exact cosine range join of vectors within labels, by pivots.

Vectors are scaled to length one, where cosine and Euclidean distance order
pairs alike, so the triangle inequality holds. In a large label each vector's
home is the cell of its nearest pivot. A partner within the radius of a vector
at home in cell j lies at most the radius beyond the plane halfway between its
own pivot and j's; only such vectors are copied to j, and only if j's number is
the lower one, so that a pair meets once. Then cells join independently. How
many pivots a label gets is decided on a sample of it: the number that leaves
least to compare, or none where the inequality excludes nothing (many dimensions
without clusters). Equal vectors are joined once and counted by their number.

Cells are divided into blocks, and each pair of blocks is one task's work; tasks
return counts and one link to the least member of each local component, never
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.operators.components import connected_components, least_reachable
from chronoloom.sources.shared import drop_shared, materialize

#: Numbers in a block of vectors, and vectors compared at once with a block.
BLOCK_NUMBERS, STRIP = 1 << 19, 512
#: Labels with more vectors may get pivots; at most so many labels (the largest) do, the others are one cell.
PIVOT_FROM, PIVOT_LABELS = 2048, 64
#: Sampled vectors of a label, and numbers in all samples together.
SAMPLE, SAMPLE_NUMBERS = 512, 1 << 21


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """Rows of a binary column that all hold vectors of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data = column.buffers()[2] or b""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return _units(np.frombuffer(data, dtype=dtype, count=(ends[-1] - ends[0]) // int(dtype[1]), offset=ends[0]).reshape(len(column), -1))


def _encode(dtype: str):
    """Vectors as the bytes of their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(b.num_columns - 1)
            ends = np.concatenate(([0], np.cumsum(v.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int32)
            values = np.ascontiguousarray(v.flatten().to_numpy(zero_copy_only=False), dtype=dtype)
            packed = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(ends * np.int32(dtype[1])), pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], packed], names=[*b.schema.names[:-1], "u"])

    return run


def cells_of(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and whether it is copied to each (lower) cell."""
    d2 = 2 - 2 * (x @ pivots.T)
    home = d2.argmin(axis=1)
    own = d2[np.arange(len(x)), home][:, None]
    apart = np.linalg.norm(pivots[:, None] - pivots[None], axis=2)
    # Distance beyond the plane halfway to pivot j; a rounding's width more does no harm.
    return home, ((d2 - own) <= 2 * apart[home] * (radius + 1e-9) + 1e-9) & (np.arange(len(pivots)) < home[:, None])


def choose_pivots(x: np.ndarray, radius: float, n: int) -> np.ndarray:
    """The first vectors of a sample as pivots of a label of ``n`` vectors: so many that least is left to compare, none unless they save a tenth.

    The rest of the sample tells each cell's share h of vectors at home and k of
    copies; h * h / 2 + h * k is compared there (without pivots: 1 / 2), and each
    copy costs about as much as a comparison with a strip.
    """
    best, least = 0, 0.45
    p = 2
    while p <= len(x) // 2:
        home, copied = cells_of(x[p:], x[:p], radius)
        h, k = np.bincount(home, minlength=p) / len(home), copied.mean(axis=0)
        cost = (h * h / 2 + h * k).sum() + k.sum() * STRIP / n
        if cost < least:
            best, least = p, cost
        p *= 2
    return x[:best]


def _cells(pivots: list[np.ndarray], radius: float, dtype: str):
    """Rows ``(..., g, u)``, g being the number of a label with pivots, with their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = b.column(b.num_columns - 2).fill_null(-1).to_numpy(zero_copy_only=False)
            for g in np.unique(label).tolist():
                rows = np.flatnonzero(label == g)
                for at in range(0, len(rows), 1024):
                    part = b.take(pa.array(rows[at : at + 1024]))
                    cell, home, which = np.zeros(part.num_rows, dtype=np.int32), np.ones(part.num_rows, dtype=bool), np.arange(part.num_rows)
                    if g >= 0 and len(pivots[g]):
                        own, copied = cells_of(_matrix(part.column(part.num_columns - 1), dtype), pivots[g], radius)
                        who, to = np.nonzero(copied)
                        which, cell, home = np.concatenate((which, who)), np.concatenate((own, to)).astype(np.int32), np.concatenate((home, np.zeros(len(who), dtype=bool)))
                    part = part.take(pa.array(which))
                    kept = [i for i in range(part.num_columns) if i != part.num_columns - 2]
                    yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(cell), pa.array(home)], names=[*(part.schema.names[i] for i in kept), "cell", "home"])

    return run


def _tile(threshold: float, dtype: str):
    """Links and local components of two blocks, or within one if the second is empty."""

    def run(t: pa.Table) -> pa.Table:
        side = t.column("side").to_numpy()
        mine, other = (t.filter(pa.array(side == s)) for s in (0, 1))
        within = t.column("kind")[0].as_py() == 0 and t.column("i")[0].as_py() == t.column("j")[0].as_py()
        if within:
            other = mine
        first = np.concatenate([mine.column("first").to_numpy(), other.column("first").to_numpy()])
        links = np.zeros(len(first), dtype=np.int64)
        root = np.arange(len(first))
        if mine.num_rows and other.num_rows:
            m, o = mine.num_rows, other.num_rows
            x, y = _matrix(mine.column("u"), dtype), _matrix(other.column("u"), dtype)
            n_x, n_y = mine.column("n").to_numpy(), other.column("n").to_numpy()
            if within:
                root[m:] = np.arange(m)
            for at in range(0, m, STRIP):
                near = x[at : at + STRIP] @ y.T >= threshold
                if within:
                    near[np.arange(len(near)), at + np.arange(len(near))] = False
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                a += at
                links[:m] += np.bincount(a, weights=n_y[b], minlength=m).astype(np.int64)
                if not within:
                    links[m:] += np.bincount(b, weights=n_x[a], minlength=o).astype(np.int64)
                root = least_reachable(len(first), np.concatenate((np.arange(len(first)), root[a])), np.concatenate((root, root[m + b])))
        # The least id of each component of the tile.
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, root, first)
        told = np.flatnonzero(links > 0)
        return pa.table({"first": first[told], "links": links[told], "least": least[root[told]]})

    return run


def cosine_links(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every vector.

    Vectors with equal, non-null labels and a cosine of at least ``threshold`` in
    double precision are linked. Null and zero vectors and those with null or
    non-finite components link with nothing. Repeated vectors link with each
    other; vectors are compared with those of their own length only. An empty
    table gives an empty result; other columns are ignored.
    """
    v = F.col(vector_col)
    fine = F.coalesce(F.col(label_col).isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v"), fine.alias("fine"))
    dtype = "f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "f8"
    known = materialize(rows.filter("fine").groupBy("label", "v").agg(F.min("id").alias("first"), F.count("*").alias("n")), "vectors")
    group = ["label", "d"]
    sized = known.select("label", F.size("v").alias("d"), "first", "n", "v")

    # Pivots of the largest labels, from samples by hash; their number and size are bounded.
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    large = sized.groupBy(group).agg(F.count("*").alias("m")).filter(F.col("m") > PIVOT_FROM).orderBy(F.desc("m"), *group).limit(PIVOT_LABELS).collect()
    packed = "first long, n long, u binary"
    of_label = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sized.select(group).schema)
    pivots: list[np.ndarray] = []
    if large:
        wanted = [min(SAMPLE, SAMPLE_NUMBERS // (len(large) * r["d"])) for r in large]
        numbered = known.sparkSession.createDataFrame([(r["label"], r["d"], g, max(1, r["m"] // max(1, w))) for g, (r, w) in enumerate(zip(large, wanted))], f"{of_label}, g int, every long")
        marked = sized.join(F.broadcast(numbered), group, "left")
        drawn = marked.filter("g is not null").filter(F.pmod(F.xxhash64("v"), "every") == 0).select("g", "v").limit(2 * sum(wanted)).collect()
        samples: list[list] = [[] for _ in large]
        for r in sorted(drawn, key=lambda r: r["g"]):
            samples[r["g"]].append(r["v"])
        pivots = [choose_pivots(_units(np.array(s, dtype=np.float64)), radius, r["m"]) if len(s) >= 8 else np.zeros((0, r["d"])) for s, r in zip(samples, large)]
    else:
        marked = sized.withColumn("g", F.lit(None).cast("int"))
    flat = marked.select(*group, "first", "n", "g", "v").mapInArrow(_encode(dtype), f"{of_label}, first long, n long, g int, u binary")
    cells = materialize(flat.mapInArrow(_cells(pivots, radius, dtype), f"{of_label}, {packed}, cell int, home boolean"), "cells")

    block = F.greatest(F.lit(16), F.floor(F.lit(BLOCK_NUMBERS) / F.col("d")))
    size = cells.groupBy(*group, "cell").agg(*(F.ceil(F.count_if(c) / block).cast("int").alias(a) for c, a in ((F.col("home"), "mine"), (~F.col("home"), "copies"))))
    dealt = cells.join(size, [*group, "cell"])
    own = F.pmod(F.xxhash64("first"), F.when(F.col("home"), F.col("mine")).otherwise(F.col("copies"))).cast("int")

    def tiles(n: str, tile) -> F.Column:
        return F.transform(F.filter(F.sequence(F.lit(0), F.col(n)), lambda t: t < F.col(n)), tile)

    def tile(kind: int, i, j, side) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    b = F.col("block")
    at_home = F.concat(tiles("mine", lambda t: tile(0, F.least(b, t), F.greatest(b, t), F.when(b <= t, 0).otherwise(1))), tiles("copies", lambda t: tile(1, b, t, F.lit(0))))
    as_copy = tiles("mine", lambda t: tile(1, t, b, F.lit(1)))
    spread = dealt.withColumn("block", own).withColumn("to", F.explode(F.when(F.col("home"), at_home).otherwise(as_copy))).select(*group, "cell", "to.*", "first", "n", "u")
    found = spread.groupBy(*group, "cell", "kind", "i", "j").applyInArrow(_tile(threshold, dtype), "first long, links long, least long")
    counts = materialize(found, "tiles")
    drop_shared(cells)
    groups = connected_components(counts.filter("first <> least").select(F.col("first").alias("u"), F.col("least").alias("v")))
    per = counts.groupBy("first").agg(F.sum("links").alias("links"))
    named = known.join(per, "first", "left").join(groups.withColumnRenamed("node", "first"), "first", "left")
    named = named.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    out = rows.filter("fine").join(named, ["label", "v"]).select("id", "n_links", "component_id")
    out = out.union(rows.filter("not fine").select("id", F.lit(0).cast("long"), "id"))
    return out.select(F.col("id").alias("vec_id"), F.col("n_links").cast("long"), F.col("component_id").cast("long"), (F.col("id") == F.col("component_id")).alias("kept"))
