"""Periods of uneven series: a least-squares periodogram up to the mean Nyquist frequency, its peaks, their harmonics, and Fourier shapes.

A power needs four sums over an object's samples for each frequency. Tasks take
slices of samples and blocks of frequencies, in which the sines are products of
two small tables, and Spark adds the sums up. So no task needs a whole series or
a whole spectrum, however long.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from chronoloom.operators.spatial import brightest_first
from chronoloom.sources.shared import materialize

#: Samples of a slice, and of a step within one; frequencies of a block: SIDE times SIDE.
SLICE, STEP, SIDE = 1 << 16, 1 << 13, 1 << 8
BLOCK = SIDE * SIDE


def block_sums(t: np.ndarray, u: np.ndarray, first: float, step: float, n: int) -> np.ndarray:
    """For n frequencies the sums of u cos, u sin, cos of twice and sin of twice the phase: four rows."""
    rows = -(-n // SIDE)
    out = np.zeros((2, rows, min(n, SIDE)), dtype=np.complex128)
    for at in range(0, len(t), STEP):
        x = 2j * np.pi * t[at : at + STEP]
        within = np.exp(np.outer(x, step * np.arange(out.shape[2])))
        begins = np.exp(np.outer(first + step * SIDE * np.arange(rows), x))
        out[0] += (begins * u[at : at + STEP]) @ within
        out[1] += (begins * begins) @ (within * within)
    flat = out.reshape(2, -1)[:, :n]
    return np.stack([flat[0].real, flat[0].imag, flat[1].real, flat[1].imag])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of runs of rows ``(id, block, slice, t, u, first, step, n)`` of one object, block and slice."""
    held, now = [], None

    def flush() -> pa.RecordBatch:
        t, u = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        ident, block, _, first, step, n = now
        count = min(BLOCK, n - block * BLOCK)
        s = block_sums(t, u, first + block * BLOCK * step, step, count)
        k = np.arange(count, dtype=np.int64) + block * BLOCK
        return pa.RecordBatch.from_arrays([pa.array(np.full(count, ident)), pa.array(k), *map(pa.array, s)], names=["id", "k", "uc", "us", "c2", "s2"])

    for b in batches:
        c = {name: b.column(name).to_numpy(zero_copy_only=False) for name in b.schema.names}
        new = np.flatnonzero((np.diff(c["id"]) != 0) | (np.diff(c["block"]) != 0) | (np.diff(c["slice"]) != 0)) + 1
        for at, end in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
            if at == end:
                continue
            key = tuple(c[name][at].item() for name in ("id", "block", "slice", "first", "step", "n"))
            if held and key != now:
                yield flush()
                held = []
            now = key
            held.append((c["t"][at:end].copy(), c["u"][at:end].copy()))
    if held:
        yield flush()


def _objects(df: DataFrame, keys: Sequence[str], time: str, value: str, oversample: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Each object's numbers (with an ``id``), and its samples as ``(id, n, t from its first, u from its mean)``."""
    t, v = F.col(time).cast("double"), F.col(value).cast("double")
    rows = df.select(*keys, t.alias("_t"), v.alias("_u")).filter("abs(_t) < double('infinity') and abs(_u) < double('infinity')")
    stat = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_t").alias("t0"), (F.max("_t") - F.min("_t")).alias("span"), F.avg("_u").alias("mean"), F.var_pop("_u").alias("var"))
    stat = stat.filter((F.col("n") >= least) & (F.col("span") > 0) & (F.col("var") > 0)).withColumn("step", 1.0 / (F.col("span") * oversample))
    stat = stat.withColumn("n_freq", F.floor((F.col("n") / 2.0 - 1) * oversample).cast("long") + 1).withColumn("id", F.monotonically_increasing_id())
    stat = materialize(stat, "series")
    rows = rows.join(stat, list(keys)).select("id", "n", (F.col("_t") - F.col("t0")).alias("t"), (F.col("_u") - F.col("mean")).alias("u"), (1.0 / F.col("span")).alias("first"), "step", "n_freq")
    return stat, rows


def periodogram(df: DataFrame, keys: Sequence[str], time: str, value: str, oversample: int = 5, least: int = 9) -> DataFrame:
    """``(*keys, k, frequency, power)``: the share of each series' variance that a sine of the frequency takes.

    Frequencies begin at one cycle in the series' span and rise by a cycle in
    ``oversample`` spans to half the mean sampling rate, n / (2 span). Series under
    ``least`` samples, without a span or without variance have no rows; nulls and
    what isn't finite are left out.
    """
    stat, rows = _objects(df, keys, time, value, oversample, least)
    spectrum = _spectrum(stat, rows)
    return spectrum.join(stat.select("id", *keys), "id").select(*keys, "k", "frequency", "power")


def _spectrum(stat: DataFrame, rows: DataFrame) -> DataFrame:
    last = F.floor((F.col("n_freq") - 1) / BLOCK).cast("long")
    dealt = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("slice", F.pmod(F.xxhash64("t", "u"), F.ceil(F.col("n") / SLICE)))
    dealt = dealt.select("id", "block", "slice", "t", "u", "first", "step", F.col("n_freq").alias("n"))
    dealt = dealt.repartition("id", "block", "slice").sortWithinPartitions("id", "block", "slice")
    sums = dealt.mapInArrow(_sums, "id long, k long, uc double, us double, c2 double, s2 double").groupBy("id", "k").agg(*[F.sum(c).alias(c) for c in ("uc", "us", "c2", "s2")])
    cc, ss, cs, uc, us = (F.col("n") + F.col("c2")) / 2, (F.col("n") - F.col("c2")) / 2, F.col("s2") / 2, F.col("uc"), F.col("us")
    det = cc * ss - cs * cs
    power = (uc * uc * ss + us * us * cc - 2 * uc * us * cs) / F.when(det > 1e-9 * F.col("n") * F.col("n"), det) / (F.col("n") * F.col("var"))
    return sums.join(stat.select("id", "n", "var", "span", "step"), "id").select("id", "k", (1.0 / F.col("span") + F.col("k") * F.col("step")).alias("frequency"), F.coalesce(power, F.lit(0.0)).alias("power"))


def prominent(spectrum: DataFrame, keys: Sequence[str], prominence: float = 3.0, distance: int = 20, reach: int = 150) -> DataFrame:
    """The peaks of ``peaks`` with their ``prominence``, not told apart into signals: ``(*keys, k, frequency, power, prominence, _step)``, of which ``_step`` is the step of frequency."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("k")
    if not hasattr(spectrum, "_shared_path"):
        spectrum = materialize(spectrum.select(*keys, "k", "frequency", "power"), "spectrum")
    stat = spectrum.groupBy(*keys).agg(F.avg("power").alias("_mean"), ((F.max("frequency") - F.min("frequency")) / F.greatest(F.lit(1), F.max("k") - F.min("k"))).alias("_step"))
    tops = spectrum.withColumns({"_b": F.lag("power").over(w), "_a": F.lead("power").over(w)}).filter("power > _b and power > _a").select(*keys, "k", "frequency", "power")
    tops = tops.join(stat, keys).filter(F.col("power") >= prominence * F.col("_mean"))  # prominence can't be more than the power itself
    tops = materialize(tops.withColumns({"_x": F.col("k").cast("double"), "_y": F.lit(0.0), "_o": -F.col("k")}), "tops")
    tops = materialize(brightest_first(tops, keys, distance - 1, "power", "_o", "_x", "_y").drop("_x", "_y", "_o"), "tops")
    # Steps meet in blocks, so a top is listed a few times, not once a step; a block's share is added up before any shuffle.
    block = lambda k: F.floor(k / max(reach, 1)).cast("long")
    listed = tops.select(*keys, F.col("k").alias("_p"), F.col("power").alias("_top"), F.explode(F.sequence(block(F.col("k") - reach), block(F.col("k") + reach))).alias("_b"))
    steps = spectrum.select(*keys, block(F.col("k")).alias("_b"), "k", "power")
    around = lambda of: steps.join(of.hint("merge"), [*keys, "_b"]).filter(F.abs(F.col("k") - F.col("_p")) <= reach)
    higher, own = F.col("power") > F.col("_top"), [*keys, "_p"]
    walls = around(listed).groupBy(*own).agg(F.max(F.when(higher & (F.col("k") < F.col("_p")), F.col("k"))).alias("_l"), F.min(F.when(higher & (F.col("k") > F.col("_p")), F.col("k"))).alias("_r"))
    side = lambda on: F.min(F.when(on, F.col("power")))
    left = (F.col("k") <= F.col("_p")) & (F.col("_l").isNull() | (F.col("k") > F.col("_l")))
    right = (F.col("k") >= F.col("_p")) & (F.col("_r").isNull() | (F.col("k") < F.col("_r")))
    feet = around(listed.join(walls.hint("merge"), own)).groupBy(*keys, F.col("_p").alias("k")).agg(F.greatest(side(left), side(right)).alias("_foot"))
    found = tops.join(feet.hint("merge"), [*keys, "k"]).withColumn("prominence", (F.col("power") - F.col("_foot")) / F.col("_mean")).filter(F.col("prominence") >= prominence)
    return found.select(*keys, "k", "frequency", "power", "prominence", "_step")


def peaks(spectrum: DataFrame, keys: Sequence[str], prominence: float = 3.0, distance: int = 20, reach: int = 150) -> DataFrame:
    """Peaks of periodograms ``(*keys, k, frequency, power)``: with ``prominence``, in units of the mean power, ``signal`` and ``harmonic``.

    A peak is higher than both neighbours, has no higher one nearer than
    ``distance`` steps (of equals the later stays), and rises by ``prominence``
    above the higher of its two feet, each the least power up to the next higher
    one within ``reach`` steps. The most prominent peak begins signal 1; peaks
    whose ratio to it, rounded to tenths, exceeds a whole number by no more than three
    steps of frequency belong to it, with that number as ``harmonic``; and so on
    with those that are left.
    """
    keys = list(keys)
    found = prominent(spectrum, keys, prominence, distance, reach)
    todo, done, signal = materialize(found, "peaks"), [], 0
    while not todo.isEmpty():
        signal += 1
        first = todo.groupBy(*keys).agg(F.max_by("frequency", F.struct("prominence", -F.col("k"))).alias("_f"))
        ratio = F.col("frequency") / F.col("_f")
        split = materialize(todo.join(first, keys).withColumn("harmonic", F.floor(ratio).cast("long")).withColumn("_in", F.round(ratio, 1) - F.floor(ratio) <= 3 * F.col("_step")), "peaks")
        done.append(split.filter("_in").select(*keys, "k", "frequency", "power", "prominence", F.lit(signal).cast("long").alias("signal"), "harmonic"))
        todo = split.filter("not _in").select(*todo.columns)
    if not done:
        return found.select(*keys, "k", "frequency", "power", "prominence", F.lit(None).cast("long").alias("signal"), F.lit(None).cast("long").alias("harmonic"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def fourier_period(df: DataFrame, keys: Sequence[str], time: str, value: str, oversample: int = 5, order: int = 3) -> DataFrame:
    """``(*keys, period, power, r21, r31, phi21, phi31)``: best period of each series, and ratios and phases of its harmonics.

    The period is the most prominent peak's, or where there is none that of the
    greatest power; the shape is a Fourier series of ``order`` (3 or more) by least squares at it.
    Series of fewer than 3 + 2 ``order`` samples, without span or variance have nulls.
    Peaks aren't told apart into signals for it, which takes a round each.
    """
    keys, least = list(keys), 3 + 2 * order
    stat, rows = _objects(df, keys, time, value, oversample, least)
    spectrum = materialize(_spectrum(stat, rows), "spectrum")
    order_by = F.struct("power", -F.col("k"))
    top = spectrum.groupBy("id").agg(F.max_by(F.struct("frequency", "power"), order_by).alias("g"))
    best = materialize(prominent(spectrum, ["id"]), "peaks").groupBy("id").agg(F.max_by(F.struct("frequency", "power"), F.struct("prominence", -F.col("k"))).alias("p"))
    best = materialize(top.join(best, "id", "left").select("id", F.coalesce("p", "g").alias("b")).select("id", "b.*"), "best")
    phase = 2 * np.pi * F.col("frequency") * F.col("t")
    basis = [F.lit(1.0), *[g(m * phase) for m in range(1, order + 1) for g in (F.cos, F.sin)]]
    n = len(basis)
    placed = rows.join(best, "id").select("id", "u", *[b.alias(f"b{i}") for i, b in enumerate(basis)])
    products = [F.sum(F.col(f"b{i}") * F.col(f"b{j}")) for i in range(n) for j in range(i, n)]
    fits = placed.groupBy("id").agg(F.array(*products).alias("a"), F.array(*[F.sum(F.col(f"b{i}") * F.col("u")) for i in range(n)]).alias("y"))
    shapes = ["r21", "r31", "phi21", "phi31"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(n)
        for b in batches:
            out = []
            for sums, y in zip(b.column("a").to_pylist(), b.column("y").to_pylist()):
                a = np.zeros((n, n))
                a[upper] = sums
                x = np.linalg.lstsq(a + np.triu(a, 1).T, np.array(y), rcond=1e-12)[0]
                amp = [float(np.hypot(x[2 * m - 1], x[2 * m])) for m in (1, 2, 3)]
                phi = [float(np.arctan2(-x[2 * m], x[2 * m - 1])) for m in (1, 2, 3)]
                out.append((amp[1] / amp[0], amp[2] / amp[0], (phi[1] - 2 * phi[0]) % (2 * np.pi), (phi[2] - 3 * phi[0]) % (2 * np.pi)) if amp[0] > 0 else (None,) * 4)
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array([o[i] for o in out], pa.float64()) for i in range(4)]], names=["id", *shapes])

    shape = fits.mapInArrow(solve, "id long, " + ", ".join(f"{c} double" for c in shapes))
    known = stat.select("id", *keys).join(best, "id").join(shape, "id").select(*keys, (1 / F.col("frequency")).alias("period"), "power", *shapes)
    return df.select(*keys).distinct().join(known, keys, "left")
