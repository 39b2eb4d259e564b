"""Robust statistics as aggregates and windows: exact medians, clipping in passes, inverse-variance means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.sources.shared import drop_shared, materialize

MAD_TO_SIGMA = 1.4826


#: Distinct values of a group that one task may hold at once (a percentile counts each once), and the shares at which larger groups are cut.
HELD = 1 << 20
CUTS = 256


def has_large(df: DataFrame, keys: Sequence[str], value: str, held: int = HELD) -> bool:
    """Whether a group has more than ``held`` distinct values, by a sketch: equal values cost a percentile nothing."""
    return not df.groupBy(*keys).agg(F.approx_count_distinct(value).alias("_n")).filter(F.col("_n") > held).isEmpty()


def quantile(df: DataFrame, keys: Sequence[str], value: str, share: float = 0.5, out: str = "median", count: str = "n", held: int = HELD, large: bool | None = None) -> DataFrame:
    """Exact quantile of each group, interpolated between neighbours: ``(*keys, out, count)``; nulls and NaN are left out.

    Groups of up to ``held`` distinct values are aggregated at once (all, if the
    caller knows that none is larger: ``large`` False). In larger ones a sketch, which
    tasks merge, gives cuts; counts tell the two cuts between which the rank lies;
    and only what lies there is looked at again, until few values or one are left.
    Cuts only steer, counts make the result exact.
    """
    v = F.col(value).cast("double")
    rows = df.select(*keys, F.when(~F.isnan(v), v).alias("_v"))
    if not keys:
        return quantile(rows.withColumn("_all", F.lit(0)), ["_all"], "_v", share, out, count, held, large).drop("_all")
    keys = list(keys)
    if large is None:
        large = has_large(rows, keys, "_v", held)
    if not large:
        return rows.groupBy(*keys).agg(F.percentile("_v", F.lit(share)).alias(out), F.count("_v").alias(count))
    named = [f"_key{i}" for i in range(len(keys))]
    if keys != named:  # columns of the passes must not meet a caller's
        got = quantile(rows.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], "_v"), named, "_v", share, "_out", "_count", held, large)
        return got.select(*[F.col(n).alias(k) for k, n in zip(keys, named)], F.col("_out").alias(out), F.col("_count").alias(count))
    sizes = materialize(rows.groupBy(*keys).agg(F.count("_v").alias(count)), "sizes")
    at = (F.col(count) - 1) * F.lit(share)
    # k0, k1: ranks (from 0, among the values still looked at) of the two neighbours, null once v0, v1 are known; part: how far the quantile lies between.
    unknown, k = F.lit(None).cast("double"), F.floor(at).cast("long")
    state = sizes.filter(F.col(count) > 0).select(*keys, k.alias("k0"), F.least(k + 1, F.col(count) - 1).alias("k1"), unknown.alias("v0"), unknown.alias("v1"), (at - k).alias("part"), F.col(count).alias("m"))
    small, state = state.filter(F.col("m") <= held), materialize(state.filter(F.col("m") > held), "ranks")
    rows = rows.filter("_v is not null")
    parts = [_joined(rows, small.select(*keys), keys).groupBy(*keys).agg(F.percentile("_v", F.lit(share)).alias(out))]
    rows = _joined(rows, state.select(*keys), keys)
    between = (F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("part")).alias(out)
    while not state.isEmpty():
        cuts = rows.groupBy(*keys).agg(F.percentile_approx("_v", [i / CUTS for i in range(CUTS + 1)], 100 * CUTS).alias("_c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        first, last = F.coalesce("k0", "k1"), F.coalesce("k1", "k0")
        low, high = F.floor(first / F.col("m") * CUTS).cast("int") - 1, F.ceil((last + 1) / F.col("m") * CUTS).cast("int") + 1
        a = F.when(low <= 0, F.col("lo")).otherwise(F.get("_c", F.greatest(low, F.lit(0))))
        b = F.when(high >= CUTS, F.col("hi")).otherwise(F.get("_c", F.least(high, F.lit(CUTS))))
        steer = materialize(_joined(cuts, state, keys).select(*state.columns, a.alias("a"), b.alias("b"), "lo", "hi"), "cuts")
        up_to = [F.count_if(F.col("_v") <= F.col(c)).alias(f"to_{c}") for c in ("a", "b", "lo")] + [F.count_if(F.col("_v") < F.col(c)).alias(f"under_{c}") for c in ("a", "b", "hi")]
        seen = _joined(rows, steer.select(*keys, "a", "b", "lo", "hi"), keys).groupBy(*keys).agg(*up_to)
        seen = _joined(steer, seen, keys)
        good = (F.col("under_a") <= first) & (last < F.col("to_b"))
        pick = lambda yes, no: F.when(good, F.col(yes)).otherwise(F.col(no))
        seen = seen.withColumns({"_a": pick("a", "lo"), "_b": pick("b", "hi"), "_from": pick("to_a", "to_lo"), "_to": pick("under_b", "under_hi")})
        value = lambda i: F.coalesce(f"v{i}", F.when(F.col(f"k{i}") < F.col("_from"), F.col("_a")).when(F.col(f"k{i}") >= F.col("_to"), F.col("_b")))
        seen = seen.withColumns({"v0": value(0), "v1": value(1)}).withColumns({f"k{i}": F.when(F.col(f"v{i}").isNull(), F.col(f"k{i}") - F.col("_from")) for i in (0, 1)})
        seen = materialize(seen.select(*keys, "k0", "k1", "v0", "v1", "part", (F.col("_to") - F.col("_from")).alias("m"), "_a", "_b"), "ranges")
        known = F.col("k0").isNull() & F.col("k1").isNull()
        parts.append(seen.filter(known).select(*keys, between))
        open_ = seen.filter(~known)
        near = _joined(rows, open_.select(*keys, "m", "_a", "_b"), keys).filter("_v > _a and _v < _b").select(*keys, "m", "_v")
        lists = near.filter(F.col("m") <= held).groupBy(*keys).agg(F.array_sort(F.collect_list("_v")).alias("_l"))  # at most ``held`` values
        listed = _joined(open_, lists, keys)
        parts.append(listed.withColumns({f"v{i}": F.coalesce(f"v{i}", F.get("_l", F.col(f"k{i}").cast("int"))) for i in (0, 1)}).select(*keys, between))
        state = open_.filter(F.col("m") > held).drop("_a", "_b")
        rows = materialize(near.filter(F.col("m") > held).select(*keys, "_v"), "values")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return _joined(sizes, found, keys, "left").select(*keys, out, count)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joined where all keys are equal, nulls to each other."""
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(named[f"_r_{k}"])
    return left.join(named, on, how).drop(*[f"_r_{k}" for k in keys])


def mad_by_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median, 1.4826 times the median absolute deviation, and count; nulls are left out."""
    large = has_large(df, keys, value)
    med = quantile(df, keys, value, large=large)
    apart = df.join(med, list(keys)).withColumn("_d", F.abs(F.col(value) - F.col("median")))
    return med.join(quantile(apart, keys, "_d", out="_mad", count="_n", large=large).select(*keys, (F.col("_mad") * MAD_TO_SIGMA).alias("sigma")), list(keys))


def linear_median(c: Column) -> Column:
    """Median of magnitudes taken over the fluxes they stand for."""
    return 2.5 * F.log10(F.median(F.pow(F.lit(10.0), 0.4 * c)))


def flux_median(df: DataFrame, keys: Sequence[str], value: str, out: str, large: bool | None = None) -> DataFrame:
    """``linear_median`` of groups of any size, with their count ``n``."""
    flux = df.withColumn("_flux", F.pow(F.lit(10.0), 0.4 * F.col(value)))
    return quantile(flux, keys, "_flux", out="_q", large=large).select(*keys, (2.5 * F.log10("_q")).alias(out), "n")


def sigma_clip(df: DataFrame, keys: Sequence[str], value: str, sigma: float, passes: int, out: str = "kept") -> DataFrame:
    """Mark values within ``sigma`` population deviations of the median of those kept so far, ``passes`` times.

    The bound is strict, so a group without deviation keeps nothing. Each pass
    reads the rows once: what it measures, a row a group, is written to the shared
    folder, so that the next one doesn't measure it again.
    """
    large = has_large(df, keys, value)
    out_df = df.withColumn(out, F.col(value).isNotNull())
    for _ in range(passes):
        kept = out_df.filter(out)
        std = F.stddev_pop(value).alias("_std")
        if large:
            stat = quantile(kept, keys, value, out="_med", large=True).drop("n").join(kept.groupBy(*keys).agg(std), list(keys))
        else:
            stat = kept.groupBy(*keys).agg(F.median(value).alias("_med"), std)
        near = F.abs(F.col(value) - F.col("_med")) < sigma * F.col("_std")
        out_df = out_df.join(materialize(stat, "clip"), list(keys), "left").withColumn(out, F.col(out) & F.coalesce(near, F.lit(False))).drop("_med", "_std")
    return out_df


def error_mask(df: DataFrame, keys: Sequence[str], error: str, times_median: float, cap: float) -> DataFrame:
    """Rows whose error is finite, positive, at most ``times_median`` times the group's median and at most ``cap``."""
    good = F.when((F.col(error) > 0) & ~F.isnan(F.col(error)) & (F.col(error) < float("inf")), F.col(error))
    stat = df.groupBy(*keys).agg(F.median(good).alias("_med"))
    return df.join(stat, list(keys)).filter(good.isNotNull() & (F.col(error) <= times_median * F.col("_med")) & (F.col(error) <= cap)).drop("_med")


def c4(n: Column) -> Column:
    """By what a sample deviation of n values falls short of the true one on average: c4(n) by its series, exact enough from n = 2."""
    m = n - 1.0
    return F.when(n == 2, 0.7978845608).when(n == 3, 0.8862269255).when(n == 4, 0.9213177319).when(n == 5, 0.9399856030).when(n >= 6, 1.0 - 1.0 / (4 * m) + 1.0 / (32 * m * m) + 5.0 / (128 * m * m * m))


def inverse_variance_mean(df: DataFrame, keys: Sequence[str], value: str, error: str) -> DataFrame:
    """Weighted mean, its error, corrected deviation, error of the plain mean and normalised chi-square."""
    w = 1.0 / F.pow(F.col(error), 2)
    stat = df.groupBy(*keys).agg((F.sum(w * F.col(value)) / F.sum(w)).alias("mean"), F.sqrt(1.0 / F.sum(w)).alias("mean_err"), F.count("*").alias("n"), F.stddev_samp(value).alias("_s"))
    chi = df.join(stat.select(*keys, "mean"), list(keys)).groupBy(*keys).agg(F.sum(F.pow((F.col(value) - F.col("mean")) / F.col(error), 2)).alias("_x2"))
    stdev = F.col("_s") / c4(F.col("n"))
    return stat.join(chi, list(keys)).select(*keys, "mean", "mean_err", "n", stdev.alias("stdev"), (stdev / F.sqrt("n")).alias("stderr"), (F.col("_x2") / F.when(F.col("n") > 1, F.col("n") - 1)).alias("chi2_norm"))


def sigma_cut_mean(df: DataFrame, keys: Sequence[str], value: str, sigma: float, passes: int = 3, first_percentile: float = 80.0, least: int = 3) -> DataFrame:
    """Means after a first cut at a percentile of the distance from the median and further cuts in sigmas.

    A group left with fewer than ``least`` values keeps those it had before.
    """
    v = F.col(value)
    med = df.groupBy(*keys).agg(F.median(v).alias("_c"))
    cut = df.join(med, list(keys)).withColumn("_r", F.abs(v - F.col("_c")))
    limit = cut.groupBy(*keys).agg(F.percentile("_r", F.lit(first_percentile / 100)).alias("_l"), F.count(v).alias("_n"))
    kept = cut.join(limit, list(keys)).withColumn("_k", (F.col("_r") <= F.col("_l")) | (F.col("_n") < least)).drop("_c", "_r", "_l", "_n")
    for _ in range(passes):
        stat = kept.groupBy(*keys).agg(F.avg(F.when(F.col("_k"), v)).alias("_m"), F.stddev_samp(F.when(F.col("_k"), v)).alias("_s"), F.count(F.when(F.col("_k"), v)).alias("_n"))
        kept = kept.join(stat, list(keys)).withColumn("_k", F.when(F.col("_n") >= least, F.coalesce(F.abs(v - F.col("_m")) <= sigma * F.col("_s"), F.col("_k"))).otherwise(F.col("_k"))).drop("_m", "_s", "_n")
    return kept.groupBy(*keys).agg(F.avg(F.when(F.col("_k"), v)).alias("mean"), F.stddev_samp(F.when(F.col("_k"), v)).alias("stdev"), F.count(F.when(F.col("_k"), v)).alias("n_kept"), F.count(F.when(~F.col("_k"), v)).alias("n_cut"))


def binned_zeropoint(df: DataFrame, keys: Sequence[str], magnitude: str, zeropoint: str, width: float, least: int = 5) -> tuple[DataFrame, DataFrame]:
    """Robust zeropoint per magnitude bin, and per group combined by inverse variance.

    A bin's value is the median over fluxes, its scatter 1.4826 MAD (or the
    deviation, where that is zero); bins under ``least`` members are left out. A
    group with fewer than two bins takes the value over all of its members.
    """
    d = df.withColumn("bin", F.floor(F.col(magnitude) / width).cast("long"))

    large = has_large(d, keys, zeropoint)

    def robust(by: list[str]) -> DataFrame:
        med = flux_median(d, by, zeropoint, "zp", large)
        apart = d.join(med.select(*by, "zp"), by).withColumn("_d", F.abs(F.col(zeropoint) - F.col("zp")))
        dev = quantile(apart, by, "_d", out="_q", count="_n", large=large).select(*by, (F.col("_q") * MAD_TO_SIGMA).alias("_mad"))
        std = d.groupBy(*by).agg(F.stddev_pop(zeropoint).alias("_std"))
        return med.join(dev, by).join(std, by).select(*by, "zp", "n", F.when(F.col("_mad") > 0, F.col("_mad")).otherwise(F.col("_std")).alias("scatter"))

    bins = robust([*keys, "bin"]).filter(F.col("n") >= least)
    w = F.when(F.col("scatter") > 0, F.col("n") / F.pow("scatter", 2))
    joint = bins.groupBy(*keys).agg((F.sum(w * F.col("zp")) / F.sum(w)).alias("_zp"), F.sqrt(1.0 / F.sum(w)).alias("_e"), F.count(w).alias("n_bins"))
    whole = robust(list(keys))
    enough = F.col("n_bins") >= 2
    total = whole.join(joint, list(keys), "left").select(*keys, F.when(enough, F.col("_zp")).otherwise(F.col("zp")).alias("zp"), F.when(enough, F.col("_e")).otherwise(F.col("scatter") / F.sqrt("n")).alias("e_zp"), F.coalesce("n_bins", F.lit(0)).cast("long").alias("n_bins"), F.col("n").alias("n_stars"))
    return bins, total


def stetson_k(df: DataFrame, keys: Sequence[str], value: str, error: str) -> DataFrame:
    """How peaked a series is about its median, in units of the errors: near 0.8 for noise; null where all values are the median."""
    mid = df.groupBy(*keys).agg(F.median(value).alias("_m"))
    res = (F.col(value) - F.col("_m")) / F.col(error)
    out = df.join(mid, list(keys)).groupBy(*keys).agg(F.count(res).alias("n"), F.sum(F.abs(res)).alias("_a"), F.sqrt(F.sum(res * res)).alias("_b"))
    return out.select(*keys, "n", (F.col("_a") / F.when(F.col("_b") > 0, F.col("_b")) / F.sqrt("n")).alias("stetson_k"))


def median_offset(df: DataFrame, keys: Sequence[str], dx: str, dy: str, box: float) -> DataFrame:
    """Median shift per group of rows whose shifts lie within a box, and how many there are."""
    near = df.filter((F.abs(F.col(dx)) < box) & (F.abs(F.col(dy)) < box))
    return near.groupBy(*keys).agg(F.median(dx).alias("off_x"), F.median(dy).alias("off_y"), F.count("*").alias("n"))


def zeropoint_series(df: DataFrame, keys: Sequence[str], zeropoint: str) -> DataFrame:
    """For each group (a detector and sector, or a sector) the median over fluxes, 1.4826 times the deviation of the values from their median, and the count."""
    own = df.filter(F.col(zeropoint).isNotNull() & ~F.isnan(F.col(zeropoint).cast("double")))
    large = has_large(own, keys, zeropoint)
    mid = materialize(flux_median(own, keys, zeropoint, "zp", large).join(quantile(own, keys, zeropoint, out="_m", large=large).drop("n"), list(keys)), "medians")  # written, so that rows meet it by its true size
    apart = own.join(mid.select(*keys, "_m"), list(keys)).withColumn("_d", F.abs(F.col(zeropoint) - F.col("_m")))
    dev = quantile(apart, keys, "_d", out="_q", count="_n", large=large).select(*keys, (F.col("_q") * MAD_TO_SIGMA).alias("scatter"))
    return mid.drop("_m").join(dev, list(keys))


def within_cut(value: Column) -> Column:
    """Whether a value lies within its group's last cut (columns ``centre``, ``reach``, ``strict`` of ``sigma_cut_loop``)."""
    away = F.abs(value - F.col("centre"))
    return F.coalesce((away < F.col("reach")) | ((away == F.col("reach")) & ~F.col("strict")), F.lit(False))


def sigma_cut_loop(df: DataFrame, keys: Sequence[str], value: str, sigma: float = 3.0, first_percentile: float = 80.0, least: int = 3, passes: int = 10) -> DataFrame:
    """Cut until nothing changes: ``(*keys, mean, stdev, n_kept, n_cut, centre, reach, strict)``, a row a group with values.

    The first pass keeps what lies nearer to the median than ``first_percentile``
    of the distances (the ``least`` nearest, with ties, if that leaves fewer; all of
    a group of at most ``least``), and measures from the kept values' median, the
    deviation corrected for small numbers. Later passes keep, of all values, those
    within ``sigma`` deviations of the last mean. A group is done once a pass keeps
    as many as the one before, its deviation is zero, or a pass would leave under
    two values, which is then not taken. Nulls and NaN are left out.

    Passes hand on one row a group, written to the shared folder; rows aren't copied.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    large = has_large(rows, keys, "_v")
    mid = materialize(quantile(rows, keys, "_v", out="centre", count="_all", large=large), "centres")
    apart = _joined(rows, mid, keys).withColumn("_d", F.abs(F.col("_v") - F.col("centre")))
    limit = quantile(apart, keys, "_d", first_percentile / 100, out="_l", count="_c", large=large).drop("_c")
    under = _joined(apart, limit, keys).groupBy(*keys).agg(F.count_if(F.col("_d") < F.col("_l")).alias("_under"), F.first("_l").alias("_l"), F.first("centre").alias("centre"), F.first("_all").alias("_all"))
    under = materialize(under, "limits")
    few = under.filter((F.col("_under") < least) & (F.col("_all") > least)).select(*keys)
    nearest = _joined(apart, few, keys).withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy("_d"))).filter(F.col("_i") <= least).groupBy(*keys).agg(F.max("_d").alias("_near"))
    whole = F.col("_all") <= least
    reach = F.when(whole, float("inf")).otherwise(F.coalesce("_near", "_l"))
    start = _joined(under, nearest, keys, "left").select(*keys, "centre", reach.alias("reach"), (~whole & F.col("_near").isNull()).alias("strict"), "_all")
    kept = _joined(rows, start, keys).filter(within_cut(F.col("_v"))).select(*keys, "_v")
    first = quantile(kept, keys, "_v", out="mean", count="n_kept", large=large)
    about = _joined(kept, first, keys).groupBy(*keys).agg(F.sum(F.pow(F.col("_v") - F.col("mean"), 2)).alias("_ss"))
    n = F.col("n_kept")
    spread = F.when(n > 1, F.sqrt(F.col("_ss") / (n - 1)) / c4(n))
    state = _joined(_joined(start, first, keys), about, keys).withColumn("stdev", spread)
    state = materialize(state.select(*keys, "mean", "stdev", "n_kept", "centre", "reach", "strict", "_all", (~F.coalesce(F.col("stdev") > 0, F.lit(False))).alias("_done")), "cut")
    for _ in range(passes - 1):
        if state.filter(~F.col("_done")).isEmpty():
            break
        inside = F.when(F.abs(F.col("_v") - F.col("mean")) <= sigma * F.col("stdev"), F.col("_v"))
        seen = _joined(rows, state.filter(~F.col("_done")).select(*keys, "mean", "stdev"), keys).groupBy(*keys).agg(F.avg(inside).alias("_m"), F.stddev_samp(inside).alias("_s"), F.count(inside).alias("_n"))
        took = F.coalesce(F.col("_n") >= 2, F.lit(False))
        pick = lambda new, old: F.when(took, new).otherwise(F.col(old)).alias(old)
        done = F.col("_done") | ~took | F.coalesce((F.col("_n") == n) | (F.col("_s") == 0), F.lit(False))
        moved = _joined(state, seen, keys, "left").select(*keys, pick(F.col("_m"), "mean"), pick(F.col("_s"), "stdev"), pick(F.col("_n"), "n_kept"), pick(F.col("mean"), "centre"), pick(sigma * F.col("stdev"), "reach"), pick(F.lit(False), "strict"), "_all", done.alias("_done"))
        old, state = state, materialize(moved, "cut")
        drop_shared(old)
    drop_shared(mid, under)
    return state.select(*keys, "mean", "stdev", "n_kept", (F.col("_all") - n).alias("n_cut"), "centre", "reach", "strict")


def error_cut_loop(df: DataFrame, keys: Sequence[str], value: str, error: str, sigma: float = 3.0, passes: int = 10) -> DataFrame:
    """Inverse-variance means after cuts by each value's own error: ``(*keys, mean, mean_err, stdev, chi2_norm, n_kept, n_cut)``.

    The first pass takes the median of all values; later ones keep, of all, those
    within ``sigma`` of their own errors of the last result. A group is done once a
    pass keeps the same rows, and fails (all null but the counts) where one keeps
    none. A single value left has its own error and no deviation. Rows without a
    value or a positive error are left out.
    """
    keys = list(keys)
    number = lambda c: F.col(c).cast("double")
    rows = df.select(*keys, number(value).alias("_v"), number(error).alias("_e")).filter((F.col("_e") > 0) & ~F.isnan("_e") & F.col("_v").isNotNull() & ~F.isnan("_v"))
    mid = quantile(rows, keys, "_v", out="mean", count="_all")
    none = F.lit(None).cast("double")
    state = materialize(mid.select(*keys, "mean", none.alias("_before"), F.col("_all").alias("n_kept"), *[none.alias(c) for c in ("mean_err", "stdev", "chi2_norm")], "_all", F.lit(False).alias("_done")), "error-cut")
    away = lambda c: F.abs(F.col("_v") - F.col(c)) <= sigma * F.col("_e")
    for _ in range(passes - 1):
        if state.filter(~F.col("_done")).isEmpty():
            break
        met = _joined(rows, state.filter(~F.col("_done")).select(*keys, "mean", "_before"), keys)
        good, was = away("mean"), F.coalesce(away("_before"), F.lit(True))
        w = F.when(good, 1 / (F.col("_e") * F.col("_e")))
        got = met.groupBy(*keys).agg((F.sum(w * F.col("_v")) / F.sum(w)).alias("_m"), F.sqrt(1 / F.sum(w)).alias("_me"), F.stddev_samp(F.when(good, F.col("_v"))).alias("_s"), F.count(w).alias("_n"), F.count_if(good != was).alias("_changed"))
        chi = _joined(met, got.select(*keys, "_m", "_n"), keys).groupBy(*keys).agg((F.sum(F.when(good, F.pow((F.col("_v") - F.col("_m")) / F.col("_e"), 2))) / F.when(F.max("_n") > 1, F.max("_n") - 1)).alias("_x"))
        new = _joined(state, _joined(got, chi, keys), keys, "left")
        pick = lambda fresh, old: F.when(F.col("_done"), F.col(old)).otherwise(fresh).alias(old)
        several = lambda c: F.when(F.col("_n") > 1, F.col(c))
        done = F.col("_done") | (F.col("_n") == 0) | (F.col("_changed") == 0)
        moved = new.select(*keys, pick(F.col("_m"), "mean"), pick(F.col("mean"), "_before"), pick(F.col("_n"), "n_kept"), pick(F.col("_me"), "mean_err"), pick(several("_s"), "stdev"), pick(several("_x"), "chi2_norm"), "_all", done.alias("_done"))
        old, state = state, materialize(moved, "error-cut")
        drop_shared(old)
    return state.select(*keys, "mean", "mean_err", "stdev", "chi2_norm", "n_kept", (F.col("_all") - F.col("n_kept")).alias("n_cut"))


def block_medians(pixels: DataFrame, keys: Sequence[str], frame: str, value: str, n: int, x: str = "x", y: str = "y", margin: int = 44, size: int = 2048) -> DataFrame:
    """Median of each of n * n blocks of each frame: ``(*keys, frame, block, median, n)``; pixels outside the blocks and missing ones don't count."""
    side = size // n
    bx, by = F.floor((F.col(x) - margin) / side), F.floor(F.col(y) / side)
    inside = pixels.filter(bx.between(0, n - 1) & by.between(0, n - 1)).withColumn("block", (by * n + bx).cast("int"))
    return quantile(inside, [*keys, frame, "block"], value)


def reference_frames(medians: DataFrame, keys: Sequence[str], frame: str, value: str = "median", block: str = "block", good: str | None = None, first: int = 5) -> DataFrame:
    """For each key the frame whose blocks all are among their lowest: ``(*keys, frame, score, percentile, index_good)``.

    ``percentile`` is the least whole one from ``first`` up at which some good frame
    has every block's value at or under that block's percentile over all frames;
    among those frames the least sum wins (ties: the earliest frame). Instead of
    raising the percentile step by step, each value is given the least one it lies
    under, a frame the greatest of its blocks', and a key the least of its frames'.
    ``index_good`` counts the good frames before it. Keys without a good frame that
    has all its blocks have no row.
    """
    keys = list(keys)
    steps = list(range(first, 101))
    limits = medians.groupBy(*keys, block).agg(F.percentile(value, F.array(*[F.lit(p / 100) for p in steps])).alias("_l"))
    many = limits.groupBy(*keys).agg(F.count("*").alias("_blocks"))
    # Interpolation between equal values may fall short of them by a rounding.
    under = F.size(F.filter("_l", lambda q: q < F.col(value) - F.abs(F.col(value)) * 1e-12)) + first
    placed = _joined(medians, limits, [*keys, block]).groupBy(*keys, frame).agg(F.max(under).alias("percentile"), F.sum(value).alias("score"), F.count(value).alias("_n"), *([F.bool_and(good).alias("_good")] if good else [F.lit(True).alias("_good")]))
    w = Window.partitionBy(*keys).orderBy(frame)
    counted = placed.withColumn("index_good", F.coalesce(F.count_if("_good").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    fit = _joined(counted, many, keys).filter((F.col("_n") == F.col("_blocks")) & F.coalesce("_good", F.lit(False)))
    best = F.min_by(F.struct(frame, "score", "percentile", "index_good"), F.struct("percentile", "score", frame)).alias("_b")
    return fit.groupBy(*keys).agg(best).select(*keys, "_b.*")
