"""Exact repeated-passage removal by a hash-compared suffix sort.

A byte is removed if a 200-byte window that covers it starts anywhere else.

1. Seeds. In each window the 32-byte gram with the least hash (leftmost on
   ties) is its anchor. It depends on the window's bytes alone, so equal windows
   have equal anchors at equal offsets. Consecutive windows share anchors; one
   row stands for such a run of windows: the anchor's hash, a digest of all bytes
   of the run (128 bits), and where it lies. About one row per 85 bytes results.
2. Anchors that occur once can't lie in a repeated window and drop out. Runs
   whose bytes occur twice as a whole are repeated wholly; both are counts with
   partial aggregation, so large groups of copies cost one row per task. Anchors
   and runs that hold more than a thousandth of all rows are at most a thousand,
   and are looked up by broadcast, so that no task gets all rows of one.
3. What is left are runs that share an anchor but not all bytes: the ends of
   shared passages. For one run of each kind the bytes are fetched, and the runs
   of an anchor are suffix-sorted: a mergesort whose comparisons find the common
   extension of two suffixes by binary search over prefix polynomial hashes.
   The same is done to the left. Neighbouring common extensions (verified
   byte by byte) give the classes of equal right and left parts, and a window is
   repeated if its pair of classes is.
4. Anchors with very many runs are first divided: windows by the anchor's
   offset into halves, rows by a hash of the bytes that all windows of a half
   cover, until a bucket is small or a half is one window, which is then counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.llm.batches import parts
from chronoloom.sources.shared import drop_shared, materialize

WINDOW = 200
GRAM = 32
#: Bytes hashed at once; longer texts are cut into overlapping pieces.
CHUNK = 1 << 20
#: Runs of one anchor that one task sorts together.
BUCKET = 4096
#: Runs sorted at once.
BATCH = 8192

_BASE, _BASE2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _tables(base: int = _BASE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte value, and powers of the base and of its inverse mod 2^64."""
    size = CHUNK + 2 * WINDOW + 2
    letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))

    def powers(base: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return letters, powers(base), powers(pow(base, -1, 1 << 64))


def prefix_hashes(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Polynomial hashes of all prefixes of a byte array."""
    letters, up, _ = _tables(base)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(letters[data] * up[: len(data)], out=out[1:])
    return out


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    n = len(keys)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def find_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts laid end to end: anchor hash, two run hashes, anchor, first and last window."""
    n = len(data)
    if n < WINDOW:
        none = np.zeros(0, dtype=np.int64)
        return *(none.view(np.uint64),) * 3, none, none, none
    _, _, down = _tables()
    sums = prefix_hashes(data)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    order = (grams & np.uint64(~0x1FFFFF & (1 << 64) - 1)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(order, WINDOW - GRAM + 1) & np.uint64(0x1FFFFF)).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.zeros(n + 1, dtype=np.int32)
    long = ends - starts >= WINDOW
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - WINDOW + 1, -1)
    valid = np.cumsum(inside)[: n - WINDOW + 1] > 0
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    last = valid.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
    lo, hi = np.flatnonzero(new), np.flatnonzero(last)
    a = anchor[lo]
    shape = mix(((a - lo) << 8 | (hi - lo)).astype(np.uint64) + np.uint64(1))
    whole = mix((sums[hi + WINDOW] - sums[lo]) * down[lo] + shape)
    anchor_hash = grams[a]
    del sums, grams, order, anchor
    sums = prefix_hashes(data, _BASE2)
    again = mix((sums[hi + WINDOW] - sums[lo]) * _tables(_BASE2)[2][lo] + shape)
    return anchor_hash, whole, again, a, lo, hi


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column(0), b.column(1)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
            size = offsets[to] - offsets[at]
            # One text that is longer than a chunk goes in pieces; every window lies in exactly one.
            for piece in range(0, max(1, int(size) - WINDOW + 1) if size > CHUNK else 1, CHUNK):
                begin = offsets[at] + piece
                end = min(offsets[to], begin + CHUNK + WINDOW - 1) if size > CHUNK else offsets[to]
                ends = offsets[at + 1 : to + 1] - begin if size <= CHUNK else np.array([end - begin])
                gram, whole, again, a, lo, hi = find_runs(data[begin:end], ends)
                doc = np.searchsorted(ends, a, side="right")
                first = np.concatenate(([0], ends[:-1]))[doc] if len(a) else a
                where = ((a - first + piece) << 16) | ((a - lo) << 8) | (hi - lo)
                hashes = [pa.array(h.view(np.int64)) for h in (gram, whole, again)]
                yield pa.RecordBatch.from_arrays([*hashes, ids.take(pa.array(doc + at)), pa.array(where)], names=["anchor", "run", "run2", "key", "loc"])
            at = to


def _common(h: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Common prefix of rows x and y by binary search over their prefix hashes."""
    lo, hi = np.zeros(len(x), dtype=np.int64), np.minimum(size[x], size[y])
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi + 1) >> 1
        same = h[x, mid] == h[y, mid]
        lo = np.where(open_ & same, mid, lo)
        hi = np.where(open_ & ~same, mid - 1, hi)


def suffix_sort(rows: np.ndarray, size: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort byte strings within buckets (given in bucket order): ``(order, common)``.

    common[k] is the common prefix of the k-th and the string before it, -1 at
    the start of a bucket. All buckets are merged at once, level by level; each
    element finds its place in the sibling run by binary search.
    """
    n, width = rows.shape
    letters, up, _ = _tables()
    h = np.zeros((n, width + 1), dtype=np.uint64)
    np.cumsum(letters[rows] * up[:width], axis=1, out=h[:, 1:])

    def before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        k = _common(h, size, x, y)
        ends = (k == size[x]) | (k == size[y])
        at = np.minimum(k, width - 1)
        return np.where(ends, size[x] < size[y], rows[x, at] < rows[y, at])

    order = np.arange(n)
    begin = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    count = np.diff(np.concatenate((begin, [n])))
    base, total = np.repeat(begin, count), np.repeat(count, count)
    place, run = np.arange(n) - base, 1
    while run < count.max(initial=0):
        mine = place // run
        sibling = mine ^ 1
        s_lo, s_hi = np.minimum(sibling * run, total), np.minimum((sibling + 1) * run, total)
        todo = np.flatnonzero(s_lo < s_hi)
        lo, hi = s_lo[todo].copy(), s_hi[todo].copy()
        left, who = (mine[todo] & 1) == 0, order[todo]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            other = order[base[todo[open_]] + mid]
            me = who[open_]
            # An element of the left run goes before its equals in the right run.
            goes = np.where(left[open_], before(other, me), ~before(me, other))
            lo[open_] = np.where(goes, mid + 1, lo[open_])
            hi[open_] = np.where(goes, hi[open_], mid)
        to = place.copy()
        to[todo] = place[todo] % run + np.minimum(mine[todo], sibling[todo]) * run + (lo - s_lo[todo])
        moved = np.empty_like(order)
        moved[base + to] = order
        order = moved
        run *= 2
    first = np.zeros(n, dtype=bool)
    first[begin] = True
    x, y = np.concatenate((order[:1], order[:-1])), order
    common = _common(h, size, x, y)
    # Collision check: the bytes must agree up to there, and the order must hold at the next byte.
    limit = np.minimum(size[x], size[y])
    same = rows[x] == rows[y]
    same &= np.arange(width) < limit[:, None]
    true = np.where(same.all(axis=1), width, same.argmin(axis=1))
    at = np.minimum(true, width - 1)
    sorted_ = np.where(true >= limit, size[x] <= size[y], rows[x, at] < rows[y, at])
    if not (first | ((true == common) & sorted_)).all():
        order = np.array(sorted(range(n), key=lambda i: (base[i], rows[i, : size[i]].tobytes())))
        x, y = np.concatenate((order[:1], order[:-1])), order
        same = (rows[x] == rows[y]) & (np.arange(width) < np.minimum(size[x], size[y])[:, None])
        common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return order, np.where(first, -1, common)


def repeated_windows(bucket: np.ndarray, segments: list[bytes], at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which windows of runs in one bucket are equal: a boolean per run and anchor offset.

    ``at`` is the anchor's place in each segment; windows start lo to hi.
    """
    n, reach = len(segments), WINDOW - GRAM
    size = np.fromiter(map(len, segments), dtype=np.int64, count=n)
    right, left = np.zeros((n, WINDOW), dtype=np.uint8), np.zeros((n, reach), dtype=np.uint8)
    for i, s in enumerate(segments):
        x = np.frombuffer(s, dtype=np.uint8)
        p = at[i]
        right[i, : size[i] - p] = x[p:]
        left[i, :p] = x[:p][::-1]
    classes = []
    for rows, length in ((right, size - at), (left, at)):
        order, common = suffix_sort(rows, length, bucket)
        classes.append((order, common))
    out = np.zeros((n, reach + 1), dtype=bool)
    (r_order, r_common), (l_order, l_common) = classes
    r, l = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for i in range(reach + 1):
        has = (at - hi <= i) & (i <= at - lo)
        if not has.any():
            continue
        r[r_order] = np.cumsum(r_common < WINDOW - i)
        l[l_order] = np.cumsum(l_common < i)
        who = np.flatnonzero(has)
        key = r[who] * (n + 1) + l[who]
        by = np.argsort(key, kind="stable")
        same = np.diff(key[by]) == 0
        twin = np.concatenate((same, [False])) | np.concatenate(([False], same))
        out[who[by[twin]], i] = True
    return out


def _spans(key: list, begin: np.ndarray, at: np.ndarray, dup: np.ndarray) -> pa.RecordBatch:
    """Byte ranges covered by the repeated windows of each run."""
    edge = np.zeros((len(dup), 1), dtype=bool)
    step = np.diff(np.hstack((edge, dup, edge)).astype(np.int8), axis=1)
    row, i_first = np.nonzero(step == 1)
    _, i_after = np.nonzero(step == -1)
    b = begin[row] + at[row] - (i_after - 1)
    e = begin[row] + at[row] - i_first + WINDOW
    return pa.RecordBatch.from_arrays([pa.array([key[i] for i in row.tolist()], pa.int64()), pa.array(b), pa.array(e)], names=["key", "b", "e"])


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; whole buckets are gathered up to BATCH rows."""

    def flush(rows: list[dict]) -> pa.RecordBatch:
        bucket = np.array([r["bucket"] for r in rows], dtype=np.int64)
        at, lo, hi = (np.array([r[k] for r in rows], dtype=np.int64) for k in ("at", "lo", "hi"))
        dup = repeated_windows(bucket, [r["seg"] for r in rows], at, lo, hi)
        dup[[r["n"] > 1 for r in rows]] = False  # these are repeated wholly, and marked so already
        return _spans([r["key"] for r in rows], np.array([r["begin"] for r in rows], dtype=np.int64), at, dup)

    held: list[dict] = []
    for b in batches:
        held += b.to_pylist()
        if len(held) > BATCH:
            cut = len(held) - 1
            while cut and held[cut - 1]["bucket"] == held[-1]["bucket"]:
                cut -= 1
            if cut:
                yield flush(held[:cut])
                held = held[cut:]
    if held:
        yield flush(held)


_ROW = "bucket long, key long, begin long, n long, at int, lo int, hi int, i_lo int, i_hi int, seg binary"
_NAMES = [f.split()[0] for f in _ROW.split(", ")]


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of runs: (key, text, runs) to rows for the sort."""
    for b in batches:
        cols: list[list] = [[] for _ in _NAMES]
        for doc, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            text = memoryview(text.as_buffer())
            for r in runs:
                a, before, span = r["loc"] >> 16, (r["loc"] >> 8) & 255, r["loc"] & 255
                begin = a - before
                for c, x in zip(cols, (r["anchor"], doc, begin, r["n"], before, 0, span, 0, WINDOW - GRAM, bytes(text[begin : begin + span + WINDOW]))):
                    c.append(x)
        types = [pa.int64()] * 4 + [pa.int32()] * 5 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=_NAMES)


def _halves(rows: DataFrame) -> DataFrame:
    """Divide the windows of each row by the anchor's offset; the new bucket hashes what all windows of a half cover."""
    mid = F.floor((F.col("i_lo") + F.col("i_hi")) / 2).cast("int")
    out = None
    for i_lo, i_hi in ((F.col("i_lo"), mid), (mid + 1, F.col("i_hi"))):
        half = rows.select("*", i_lo.alias("a"), i_hi.alias("z"))
        half = half.select("*", F.greatest("lo", F.col("at") - F.col("z")).alias("s"), F.least("hi", F.col("at") - F.col("a")).alias("e")).filter("s <= e")
        shared = F.substring("seg", F.col("at") - F.col("a") + 1, F.lit(WINDOW) - F.col("z") + F.col("a"))
        half = half.select(
            F.xxhash64("bucket", "a", "z", shared).alias("bucket"), "key", (F.col("begin") + F.col("s")).alias("begin"), "n", (F.col("at") - F.col("s")).alias("at"),
            F.lit(0).alias("lo"), (F.col("e") - F.col("s")).alias("hi"), F.col("a").alias("i_lo"), F.col("z").alias("i_hi"),
            F.substring("seg", F.col("s") + 1, F.col("e") - F.col("s") + WINDOW).alias("seg"),
        )
        out = half if out is None else out.union(half)
    return out


#: Keys with at most so many rows are never looked up by broadcast.
HEAVY = 10_000


def _matched(rows: DataFrame, counted: DataFrame, on: list[str], n: str, total: int, how: str) -> DataFrame:
    """``rows.join(counted, on, how)`` (inner or left_semi) where ``counted`` tells in ``n`` how many of the ``total`` rows a key has.

    Keys with over a thousandth of the rows, at most a thousand, are broadcast.
    """
    limit = max(HEAVY, total // 1000)
    if total <= HEAVY or counted.filter(F.col(n) > limit).isEmpty():
        return rows.join(counted, on, how)
    heavy = F.broadcast(counted.filter(F.col(n) > limit))
    light = rows.join(heavy, on, "left_anti").join(counted.filter(F.col(n) <= limit), on, how)
    return light.unionByName(rows.join(heavy, on, how))


def row_hash(docs: DataFrame, id_col: str | None, text_col: str) -> F.Column:
    """A 64-bit hash of id and text that tells all different rows of ``docs`` apart (checked by a second, wider digest)."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("-")) if id_col else F.lit("")
    salt = 0
    while True:
        key = F.xxhash64(F.lit(salt), name, text)
        seen = docs.select(key.alias("k"), F.concat(F.md5(text), name).alias("d")).groupBy("k").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        if seen.filter("lo < hi").isEmpty():
            return key
        salt += 1


def repeated_spans(docs: DataFrame, key_col: str = "key", text_col: str = "t") -> DataFrame:
    """Byte ranges ``(key, b, e)`` that repeated windows cover; they may overlap.

    ``key_col`` (long) names a text: rows with equal keys have equal texts.
    """
    texts = docs.select(F.col(key_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    runs = materialize(texts.mapInArrow(_scan, "anchor long, run long, run2 long, key long, loc long"), "runs")
    twice = materialize(runs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "anchors")
    shared = materialize(_matched(runs, twice, ["anchor"], "n", runs.count(), "left_semi"), "shared-runs")
    drop_shared(runs, twice)
    run = ["anchor", "run", "run2"]
    kinds = materialize(shared.groupBy(run).agg(F.count("*").alias("n"), F.min(F.struct("key", "loc")).alias("one")), "run-kinds")
    whole = _matched(shared, kinds.filter("n > 1").select(*run, "n"), run, "n", shared.count(), "left_semi")
    a, before, span = F.shiftright("loc", 16), F.shiftright("loc", 8).bitwiseAND(255), F.col("loc").bitwiseAND(255)
    marks = whole.select("key", (a - before).alias("b"), (a - before + span + WINDOW).alias("e"))

    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("c"), F.min("n").alias("least")).filter("c > 1 and least = 1").select("anchor", "c")
    wanted = _matched(kinds, mixed, ["anchor"], "c", kinds.count(), "left_semi").select("anchor", "n", "one.key", "one.loc")
    # Of a text's runs, so that a row holds less for the sort than the text is long.
    per_text = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "n", "loc")).alias("runs"))
    rows = texts.join(per_text.hint("shuffle_hash"), "key").select("key", "t", "runs")
    todo = materialize(rows.mapInArrow(_fetch, _ROW), "run-bytes")
    found, done = [marks], [shared, kinds, todo]
    while True:
        sizes = todo.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1")
        sized = materialize(_matched(todo, sizes, ["bucket"], "c", todo.count(), "inner"), "run-buckets")
        small = sized.filter(F.col("c") <= BUCKET).drop("c")
        sorted_ = small.repartition("bucket").sortWithinPartitions("bucket")
        found.append(sorted_.mapInArrow(_sort_buckets, "key long, b long, e long"))
        large = sized.filter(F.col("c") > BUCKET).drop("c")
        ready = large.filter("i_lo = i_hi")
        same = ready.groupBy("bucket", "seg").agg(F.count("*").alias("m")).filter("m > 1").select("bucket", "seg")
        found.append(ready.join(same, ["bucket", "seg"], "left_semi").select("key", F.col("begin").alias("b"), (F.col("begin") + WINDOW).alias("e")))
        done.append(sized)
        more = large.filter("i_lo < i_hi")
        if more.isEmpty():
            break
        todo = materialize(_halves(more), "run-bytes")
        done.append(todo)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    spans = materialize(out.distinct(), "spans")
    drop_shared(*done)
    return spans


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted((s["b"], s["e"]) for s in spans or ()):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def free_name(name: str, columns: list[str]) -> str:
    """A column name that isn't taken."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, written out so that it stays, and the key's name."""
    key = free_name("row_key", docs.columns)
    return materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def _with_spans(docs: DataFrame, id_col: str | None, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with the spans of each row's text as a list, and that column's name."""
    key, out = free_name("span_key", docs.columns), free_name("span_list", docs.columns)
    keyed = docs.withColumn(key, row_hash(docs, id_col, text_col))
    spans = repeated_spans(keyed, key, text_col)
    per_text = spans.groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct("b", "e")).alias(out))
    return keyed.join(per_text.hint("shuffle_hash"), key, "left").drop(key), out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in parts(batches):
        size, cut, runs, sha = [], [], [], []
        for text, spans in zip(b.column(1), b.column(2).to_pylist()):
            text = memoryview(text.as_buffer())
            merged = _merged(spans)
            kept, at = hashlib.sha256(), 0
            for begin, end in merged:
                kept.update(text[at:begin])
                at = end
            kept.update(text[at:])
            size.append(len(text))
            cut.append(sum(e - s for s, e in merged))
            runs.append(len(merged))
            sha.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(cut, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every document.

    Null texts count as empty; texts under 200 bytes lose nothing. Each row is a
    document of its own, whatever its id: repeated rows and copies lose everything
    if they have 200 bytes, and texts that share an id or have none lose only what
    repeats of themselves. An empty table gives an empty result; other columns of
    ``docs`` are ignored.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    joined, spans = _with_spans(picked, "doc_id", "t")
    return joined.select("doc_id", F.col("t").cast("binary").alias("t"), spans).mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_spans(text: str | None, spans: list[dict] | None) -> str | None:
    """A text without its repeated bytes; a character goes if all of its bytes do."""
    if text is None or not spans:
        return text
    data, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    for begin, end in _merged(spans):
        while begin < end and data[begin] & 0xC0 == 0x80:
            begin += 1
        while end > begin and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:begin])
        at = end
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from the texts (whole characters only) and n_chars, if there, recounted.

    Each row is a text of its own, whatever its id. Null texts stay null, texts
    under 200 bytes as they are; of copies none stays (both repeat); an empty
    table gives an empty one.
    """
    names, types = docs.columns, docs.schema
    joined, spans = _with_spans(docs, id_col if id_col in names else None, text_col)
    where = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            texts = [cut_spans(t, s) for t, s in zip(b.column(where).to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            cols = [pa.array(texts, pa.string()) if i == where else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    out = joined.select(*names, spans).mapInArrow(run, types)
    return out.withColumn("n_chars", F.length(text_col).cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in names else out
