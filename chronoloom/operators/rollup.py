"""Roll-ups: weighted means, objects from events, pivots, running flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.functions.values import known


def weighted_mean_variance(df: DataFrame, keys: Sequence[str], weight: str, values: Sequence[str], carry: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """Weighted mean and weighted variance (``e_*``, not its root) of each value.

    Missing values and weights drop out of sums one by one; a group of one row
    has that row's value and no variance. ``carry`` takes the first by ``order``.
    """
    w = known(F.col(weight))
    means = [(F.sum(known(F.col(v)) * w) / F.sum(F.when(known(F.col(v)).isNotNull(), w))).alias(v) for v in values]
    first = [F.min_by(F.col(c), F.col(order)).alias(c) for c in carry]
    mean = df.groupBy(*keys).agg(*means, *first, F.count("*").alias("n"))
    back = df.select(*keys, w.alias("_w"), *[known(F.col(v)).alias(f"_{v}") for v in values]).join(mean.select(*keys, *values), list(keys))
    var = back.groupBy(*keys).agg(*[(F.sum(F.col("_w") * F.pow(F.col(f"_{v}") - F.col(v), 2)) / F.sum(F.when(F.col(f"_{v}").isNotNull(), F.col("_w")))).alias(f"e_{v}") for v in values])
    return mean.join(var, list(keys)).select(*keys, *values, *[F.when(F.col("n") > 1, F.col(f"e_{v}")).alias(f"e_{v}") for v in values], *carry, "n")


def objects_from_events(events: DataFrame, key: str, significance: str, order: str, classification: str, start: Column, end: Column, sign: str, rename: dict[str, str] | None = None) -> DataFrame:
    """One row per object: its most significant event (first of equals), most frequent class (least of equals), lengths, count, sum of distinct signs."""
    length = end - start
    best = F.max_by(F.struct(F.col(order).alias("id"), F.col(significance).alias("sig")), F.struct(F.col(significance), -F.col(order)))
    out = events.groupBy(key).agg(best.alias("_b"), F.mode(classification, True).alias("classification"), F.min(length).alias("min_eventlength"), F.max(length).alias("max_eventlength"), F.count("*").alias("n_events"), F.sum_distinct(sign).alias("flux_sign"))
    out = out.select(key, F.col("_b.id").alias("best_event"), F.col("_b.sig").alias("sig_max"), "classification", "min_eventlength", "max_eventlength", "n_events", "flux_sign")
    return out.replace(rename, subset=["classification"]) if rename else out


#: What an object takes from its most significant event, by the names of both.
CARRIED = {
    "sector": "sector", "cam": "camera", "ccd": "ccd", "cut": "cut", "xcentroid": "xcentroid", "ycentroid": "ycentroid", "ra": "ra", "dec": "dec", "gal_l": "gal_l", "gal_b": "gal_b",
    "xcentroid_err": "xcentroid_err", "ycentroid_err": "ycentroid_err", "ra_err": "ra_err", "dec_err": "dec_err", "image_sig_max": "image_sig_max", "lc_sig_max": "lc_sig_max", "flux_maxsig": "flux_max",
    "frame_maxsig": "frame_max", "mjd_maxsig": "mjd_max", "psf_maxsig": "psf_like", "gaia_id": "gaia_id", "frame_bin": "frame_bin",
}


def find_objects(events: DataFrame, key: str = "objid", significance: str = "image_sig_max", order: str = "eventid", more: Sequence[str] = ()) -> DataFrame:
    """One row an object: of its most significant event (first by ``order`` of equals; without significance last) the CARRIED columns that exist, and ``more``.

    classification is the most frequent one (least of equals), RRLyrae written as
    VRRLyr; asteroid_id is that of an object whose only event is an Asteroid, else
    '-'. Shortest and longest durations, the sum of distinct signs and n_events are over all events.
    """
    have = {out: name for out, name in (CARRIED | {c: c for c in more}).items() if name in events.columns}
    packed = F.struct(*[F.col(f"`{name}`").alias(out) for out, name in have.items()], F.col("classification").alias("_class"), *([F.col("asteroid_id").cast("string").alias("_asteroid")] if "asteroid_id" in events.columns else []))
    lengths = [f(c).alias(f"{f.__name__}_eventlength_{unit}") for unit, c in (("frame", "frame_duration"), ("mjd", "mjd_duration")) if c in events.columns for f in (F.min, F.max)]
    rank = F.struct(F.coalesce(significance, F.lit(float("-inf"))), -F.col(order))
    out = events.groupBy(key).agg(F.max_by(packed, rank).alias("_b"), F.mode("classification", True).alias("_mode"), *lengths, F.sum_distinct("flux_sign").cast("long").alias("flux_sign"), F.count("*").alias("n_events"))
    lone = (F.col("n_events") < 2) & (F.col("_b._class") == "Asteroid")
    asteroid = F.when(lone, F.col("_b._asteroid")).otherwise("-") if "asteroid_id" in events.columns else F.lit("-")
    named = F.when(F.col("_mode") == "RRLyrae", "VRRLyr").otherwise(F.col("_mode"))
    return out.select(key, named.alias("classification"), *[F.col(f"_b.`{c}`").alias(c) for c in have], F.coalesce(asteroid, F.lit("-")).alias("asteroid_id"), *[c for c in out.columns if "eventlength" in c], "flux_sign", "n_events")


def with_count(df: DataFrame, keys: Sequence[str], out: str = "n_detections") -> DataFrame:
    """Each row with its group's size: an aggregate and a join, so that a large group isn't gathered."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias(out)), list(keys))


def small_groups(df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Rows of groups with at most ``most`` members."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") <= most).select(*keys), list(keys), "left_semi")


def busy_frames(df: DataFrame, frame: str, sigma: float, passes: int = 5) -> DataFrame:
    """Flag rows in frames that hold more rows than the median frame by ``sigma`` clipped deviations."""
    counts = df.groupBy(frame).agg(F.count("*").alias("n"))
    kept = counts
    for _ in range(passes):
        stat = kept.agg(F.median("n").alias("_m"), F.stddev_pop("n").alias("_s"))
        kept = kept.crossJoin(F.broadcast(stat)).filter((F.abs(F.col("n") - F.col("_m")) <= sigma * F.col("_s"))).select(frame, "n")  # one row of statistics
    stat = kept.agg(F.median("n").alias("_m"), F.stddev_pop("n").alias("_s"))
    marked = counts.crossJoin(F.broadcast(stat)).select(frame, "n", (F.col("n") > F.col("_m") + sigma * F.col("_s")).cast("int").alias("bad_frame_flag"))
    return df.join(marked, frame)


def grid_pivot(df: DataFrame, index: Column, n: int, value: Column, rotate: bool = False) -> DataFrame:
    """Values of cuts laid out as rows and columns of a detector; ``rotate`` turns it by half a turn."""
    k = (n * n - 1 - index) if rotate else index
    placed = df.withColumn("row", F.floor(k / n).cast("int")).withColumn("col", F.pmod(k, F.lit(n)).cast("int"))
    return placed.groupBy("row").pivot("col", list(range(n))).agg(value)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def last_positive(columns: Sequence[str]) -> tuple[Column, Column]:
    """Name and value of the last of several columns that is above zero."""
    name, value = F.lit(None).cast("string"), F.lit(None).cast("double")
    for c in columns:
        name, value = F.when(F.col(c) > 0, F.lit(c)).otherwise(name), F.when(F.col(c) > 0, F.col(c).cast("double")).otherwise(value)
    return name, value
