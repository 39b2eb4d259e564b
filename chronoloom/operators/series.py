"""Series of rows per object: sessions, bins, gaps, look-ups, light-curve measures.

A window is partitioned by object, and objects are many; none of the operators
orders a whole table. An object whose history is too long for one task can be
divided beforehand at any gap wider than the session's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.functions.values import horner, normal_quantile, tail_depth


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap, order: Sequence[str] = (), out: str = "eventid", first: int = 1) -> DataFrame:
    """Number the runs of rows that lie no more than ``gap`` apart, by ``time`` (ties by ``order``)."""
    w = Window.partitionBy(*keys).orderBy(time, *order)
    new = F.coalesce((F.col(time) - F.lag(time).over(w) > gap).cast("int"), F.lit(0))
    return df.withColumn("_new", new).withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + first).drop("_new")


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def blocks(df: DataFrame, keys: Sequence[str], frame: str, value: str, k: int, full_only: bool = False, segment: str | None = None) -> DataFrame:
    """Means of blocks of k frames, counted from the start of each segment; the last, partial one counts unless ``full_only``."""
    keys = [*keys, segment] if segment else list(keys)
    start = F.min(frame).over(Window.partitionBy(*keys)) if segment else F.lit(0)
    out = df.withColumn("bin", F.floor((F.col(frame) - start) / k).cast("long")).groupBy(*keys, "bin").agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
    return out.filter(F.col("n") == k) if full_only else out


def extend(df: DataFrame, keys: Sequence[str], frame: str, significance: str, start: str, end: str, level: float = 3.0, misses: int = 5) -> DataFrame:
    """Lengthen events both ways while frames reach ``level``, until ``misses`` frames in all (not in a row) don't.

    ``df`` has a row for each frame of an event's light curve, with the event's
    bounds on each. Within the bounds every frame at ``level`` counts.
    """
    miss = (~(F.col(significance) >= level)).cast("int")
    after, before = F.col(frame) > F.col(end), F.col(frame) < F.col(start)
    ahead = Window.partitionBy(*keys).orderBy(frame).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*keys).orderBy(F.desc(frame)).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("_right", F.sum(F.when(after, miss).otherwise(0)).over(ahead)).withColumn("_left", F.sum(F.when(before, miss).otherwise(0)).over(back))
    hit = (F.col(significance) >= level) & ((~after & ~before) | (after & (F.col("_right") < misses)) | (before & (F.col("_left") < misses)))
    own = F.when(hit, F.col(frame))
    return out.groupBy(*keys).agg(F.coalesce(F.min(own), F.first(start)).alias("frame_start"), F.coalesce(F.max(own), F.first(end)).alias("frame_end"), F.count(own).alias("n_detections"))


def significance(df: DataFrame, keys: Sequence[str], time: str, value: str, start: str, end: str, buffer, base, sign: str | None = None) -> DataFrame:
    """Compare the samples of an event with a baseline around it.

    Baseline: samples nearer than ``base`` to the event but beyond ``buffer`` of
    it (both strict). Gives the greatest and mean significance, the peak and its
    time, the baseline's median and population deviation, and whether it is flat
    (slope, median and deviation small); fewer than two baseline samples: null.
    Where ``sign`` is negative the peak is the least sample and significance the
    absolute value.
    """
    t, v = F.col(time), F.col(value)
    up = F.col(sign) >= 0 if sign else F.lit(True)
    inside = t.between(F.col(start), F.col(end))
    near = (t > F.col(start) - base) & (t < F.col(end) + base)
    off = (t < F.col(start) - buffer) | (t > F.col(end) + buffer)
    b = F.when(near & off, v)
    agg = df.groupBy(*keys).agg(
        F.count(b).alias("n_base"), F.median(b).alias("base_median"), F.stddev_pop(b).alias("base_std"), F.regr_slope(b, F.when(near & off, t)).alias("slope"),
        F.avg(F.when(inside, v)).alias("mean"), F.min(F.when(inside, F.struct(F.when(up, -v).otherwise(v).alias("v"), t.alias("t"), v.alias("own")))).alias("_p"), F.min(up).alias("_up"),
    )
    agg = agg.withColumns({"peak": F.col("_p.own"), "peak_time": F.col("_p.t")})
    sigma = F.when((F.col("n_base") >= 2) & (F.col("base_std") > 0), F.col("base_std"))
    med = F.when(F.col("n_base") >= 2, F.col("base_median"))
    flat = (F.abs(F.col("slope")) / sigma < 2) & (F.abs(med) < sigma) & (sigma < 5)
    signed = lambda c: F.when(F.col("_up"), (F.col(c) - med) / sigma).otherwise(F.abs((F.col(c) - med) / sigma))
    return agg.select(*keys, "n_base", "peak", "peak_time", signed("peak").alias("sig_max"), signed("mean").alias("sig_mean"), F.coalesce(flat, F.lit(False)).cast("int").alias("lc_flat"))


def cadence(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Median step, and steps longer than the median by more than one population deviation."""
    w = Window.partitionBy(*keys).orderBy(time)
    steps = df.withColumn("step", F.col(time) - F.lag(time).over(w))
    stat = steps.groupBy(*keys).agg(F.median("step").alias("cadence"), F.stddev_pop("step").alias("spread"))
    return steps.join(stat, list(keys)).groupBy(*keys).agg(F.first("cadence").alias("cadence"), F.count(F.when(F.col("step") > F.col("cadence") + F.col("spread"), 1)).alias("n_breaks"))


def split_at_largest_gap(df: DataFrame, keys: Sequence[str], time: str, out: str = "part") -> DataFrame:
    """1 up to the largest step (the first of equals), 2 behind it."""
    w = Window.partitionBy(*keys).orderBy(time)
    steps = df.withColumn("_step", F.col(time) - F.lag(time).over(w))
    cut = F.max_by(F.col(time), F.struct(F.col("_step"), -F.col(time))).over(Window.partitionBy(*keys))
    at = F.when(F.max("_step").over(Window.partitionBy(*keys)).isNotNull(), cut)
    return steps.withColumn(out, F.when(F.col(time) >= at, 2).otherwise(1)).drop("_step")


def nearest_on_grid(value: Column, start, step) -> Column:
    """Index of the nearest point of an even grid, the earlier one of two equally near."""
    return F.ceil((value - start) / step - 0.5).cast("long")


def interpolate(df: DataFrame, knots: DataFrame, key: Sequence[str], at: str, x: str, y: str, bucket) -> DataFrame:
    """Linear interpolation of ``y`` at ``at``: an equi join on buckets of the intervals between knots.

    At and beyond the outer knots it is theirs; without knots null. An interval is
    listed in each bucket it reaches, so rows meet the few intervals of their own
    bucket.
    """
    w = Window.partitionBy(*key).orderBy(x)
    spans = knots.select(*key, F.col(x).alias("_x0"), F.col(y).alias("_y0"), F.lead(x).over(w).alias("_x1"), F.lead(y).over(w).alias("_y1")).filter("_x1 is not null")
    spans = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_x0") / bucket).cast("long"), F.floor(F.col("_x1") / bucket).cast("long"))))
    rows = df.withColumn("_b", F.floor(F.col(at) / bucket).cast("long")).alias("r")
    on = [F.col(f"r.{k}") == F.col(f"s.{k}") for k in key] + [F.col("r._b") == F.col("s._b"), F.col(f"r.{at}") >= F.col("s._x0"), F.col(f"r.{at}") < F.col("s._x1")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    slope = (F.col("_y1") - F.col("_y0")) / (F.col("_x1") - F.col("_x0"))
    found = rows.join(spans.alias("s"), cond, "left").select("r.*", (F.col("_y0") + slope * (F.col(at) - F.col("_x0"))).alias("interpolated")).drop("_b")
    knot = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    outer = knots.filter(F.col(x).isNotNull()).groupBy(*key).agg(F.min(knot).alias("_first"), F.max(knot).alias("_last"))
    beyond = F.when(F.col(at) >= F.col("_last.x"), F.col("_last.y")).when(F.col(at) <= F.col("_first.x"), F.col("_first.y"))
    return found.join(outer, list(key), "left").withColumn("interpolated", F.coalesce("interpolated", beyond)).select(*df.columns, "interpolated")


def window_until_gap(df: DataFrame, keys: Sequence[str], time: str, longest_gap, longest) -> DataFrame:
    """Rows from each object's first up to the first step over ``longest_gap`` or ``longest`` after the start."""
    w = Window.partitionBy(*keys).orderBy(time)
    step = F.coalesce(F.col(time) - F.lag(time).over(w), F.lit(0))
    out = df.withColumn("_step", step).withColumn("_worst", F.max("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_first", F.min(time).over(Window.partitionBy(*keys)))
    return out.filter((F.col("_worst") <= longest_gap) & (F.col(time) - F.col("_first") <= longest)).drop("_step", "_worst", "_first")


def curve_features(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, error: str) -> DataFrame:
    """Shape statistics of a series that need no period, weighted by 1 / error where the name says so.

    gap95 is 1 - p95 / maximum; von_neumann the squared steps over the variance;
    cusum_range that of the running sum about the weighted mean, over n weighted
    deviations; amplitude_ratio of the weighted deviations above and below the
    mean; stetson_k of the residuals from the median. Null where a divisor is 0.
    """
    w, whole = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
    v, weight = F.col(value), 1.0 / F.col(error)

    def over(a, b):
        return a / F.when(b != 0, b)

    base = df.withColumn("_m", F.avg(v).over(whole)).withColumn("_med", F.median(v).over(whole)).withColumn("_d", v - F.lag(value).over(w)).withColumn("_w", weight)
    base = base.withColumn("_wm", F.sum(v * F.col("_w")).over(whole) / F.sum("_w").over(whole))
    base = base.withColumn("_c", F.sum(v - F.col("_wm")).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_r", (v - F.col("_med")) / F.col(error))
    n, var, m = F.count(v), F.var_pop(v), F.col("_m")
    wstd = F.sqrt(F.sum(F.pow(v - F.col("_wm"), 2) * F.col("_w")) / F.sum("_w"))
    q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.75), F.lit(0.95)))
    high = F.round(v - m, 9)  # a value at the mean isn't above it, whatever the order of sums
    above, below = (over(F.sum(F.when(c, F.pow(v - m, 2) * F.col("_w"))), F.sum(F.when(c, F.col("_w")))) for c in (high > 0, high <= 0))
    return base.groupBy(*keys).agg(
        n.alias("n"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_pop(v).alias("std"), F.median(F.abs(v - F.col("_med"))).alias("mad"),
        F.max("_wm").alias("weighted_mean"), wstd.alias("weighted_std"),
        over(F.sum(F.pow(v - m, 3)) / n, F.pow(var, 1.5)).alias("skew"), (over(F.sum(F.pow(v - m, 4)) / n, var * var) - 3).alias("kurtosis"),
        over(over(F.sum(F.abs("_r")), F.sqrt(F.sum(F.col("_r") * F.col("_r")))), F.sqrt(n)).alias("stetson_k"), (q[1] - q[0]).alias("iqr"),
        over(over(F.sum(F.pow("_d", 2)), n - 1), var).alias("von_neumann"), over((F.max("_c") - F.min("_c")) / n, wstd).alias("cusum_range"),
        (1 - over(q[2], F.max(v))).alias("gap95"), F.sqrt(over(above, below)).alias("amplitude_ratio"),
    )


def masked_samples(samples: DataFrame, events: DataFrame, keys: Sequence[str], frame: str, event: str, start: str, end: str, reach: int, width: int) -> DataFrame:
    """The samples around each event that no other event of its object covers: ``(*keys, event, start, end, samples...)``.

    Samples lie within ``reach`` of the event; of events that cover a sample the
    last (by ``event``) has it. Intervals and samples meet in buckets of ``width``.
    """
    keys = list(keys)

    def met(left: DataFrame, spare: int) -> DataFrame:
        lo, hi = (F.col(start) - spare, F.col(end) + spare)
        spread = events.select(*keys, event, start, end).withColumn("_b", F.explode(F.sequence(F.floor(lo / width).cast("long"), F.floor(hi / width).cast("long"))))
        return left.withColumn("_b", F.floor(F.col(frame) / width).cast("long")).join(spread, [*keys, "_b"]).filter(F.col(frame).between(lo, hi)).drop("_b")

    points = samples.select(*keys, frame).distinct()
    cover = met(points, 0).groupBy(*keys, frame).agg(F.max(event).alias("_cover"))
    near = met(samples, reach).join(cover, [*keys, frame], "left")
    return near.filter(F.col("_cover").isNull() | (F.col("_cover") == F.col(event))).drop("_cover")


def shapiro_w(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How nearly each group's values follow a normal curve: ``(*keys, n, shapiro_w)``, the Shapiro-Wilk statistic by Royston's approximation (AS R94).

    At most 1; null for fewer than three values or where all are equal. Nulls and
    NaN are left out. Ranks and sums share one partitioning by the keys.
    """
    x, i, n = F.col("_v"), F.col("_i"), F.col("n")
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(x.isNotNull() & ~F.isnan("_v"))
    whole = Window.partitionBy(*keys)
    # Sums run over values less the group's mean, so that large offsets don't cost digits.
    rows = rows.withColumns({"_i": F.row_number().over(whole.orderBy("_v")), "n": F.count("*").over(whole), "_v": x - F.avg("_v").over(whole)})
    rows = rows.withColumn("_p", (i - 0.375) / (n + 0.25)).withColumn("_t", tail_depth(F.col("_p"))).withColumn("_m", normal_quantile(F.col("_p"), F.col("_t")))
    edge = F.when(n > 5, 2).otherwise(1)
    inner = F.when((i > edge) & (i <= n - edge), F.col("_m") * x)
    at = lambda k: F.max(F.when(i == k, x))
    got = rows.groupBy(*keys, "n").agg(F.sum(x * x).alias("_ss"), F.sum(F.col("_m") * F.col("_m")).alias("_mm"), F.coalesce(F.sum(inner), F.lit(0.0)).alias("_in"), at(1).alias("_x1"), at(2).alias("_x2"), at(n - 1).alias("_y2"), at(n).alias("_y1"), F.max("_m").alias("_top"), F.max(F.when(i == n - 1, F.col("_m"))).alias("_next"))
    u, top, next_ = 1 / F.sqrt(n), F.col("_top"), F.col("_next")
    long = F.sqrt("_mm")
    a1 = F.when(n == 3, math.sqrt(0.5)).otherwise(horner((0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056), u) + top / long)
    a2 = horner((0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633), u) + next_ / long
    phi = F.when(n > 5, (F.col("_mm") - 2 * top * top - 2 * next_ * next_) / (1 - 2 * a1 * a1 - 2 * a2 * a2)).otherwise((F.col("_mm") - 2 * top * top) / (1 - 2 * a1 * a1))
    middle = F.when(n > 3, F.col("_in") / F.sqrt(phi)).otherwise(0.0)
    b = middle + a1 * (F.col("_y1") - F.col("_x1")) + F.when(n > 5, a2 * (F.col("_y2") - F.col("_x2"))).otherwise(0.0)
    return got.select(*keys, "n", F.when((n >= 3) & (F.col("_y1") > F.col("_x1")), F.least(F.lit(1.0), b * b / F.col("_ss"))).alias("shapiro_w"))
