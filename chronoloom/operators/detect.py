"""Sources in frames: one row holds a frame as a flat array; detection runs frame by frame in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def mexican_hat(sigma: float) -> np.ndarray:
    """A kernel that sums to zero and answers to blobs of a width."""
    r = int(np.ceil(4 * sigma))
    y, x = np.mgrid[-r : r + 1, -r : r + 1]
    q = (x * x + y * y) / (2 * sigma * sigma)
    k = (1 - q) * np.exp(-q)
    k -= k.mean()
    return k / np.sqrt((k * k).sum())


def convolve(image: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Same-size convolution with edges repeated."""
    r = kernel.shape[0] // 2
    padded = np.pad(image, r, mode="edge")
    windows = np.lib.stride_tricks.sliding_window_view(padded, kernel.shape)
    return np.einsum("ijkl,kl->ij", windows, kernel[::-1, ::-1])


def find_sources(image: np.ndarray, sigmas=(1.0, 1.5, 2.5), level: float = 5.0, spacing: float = 1.5) -> list[dict[str, float]]:
    """Peaks of the matched filters above ``level`` noise deviations, brightest first, none close to a brighter one."""
    noise = 1.4826 * np.nanmedian(np.abs(image - np.nanmedian(image))) or 1e-12
    clean = np.nan_to_num(image - np.nanmedian(image))
    best = np.max([convolve(clean, mexican_hat(s)) for s in sigmas], axis=0) / noise
    inner = np.full_like(best, -np.inf)
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            if dy or dx:
                inner = np.maximum(inner, np.roll(np.roll(best, dy, 0), dx, 1))
    # A filter also answers beside a source of the other sign; there the pixel itself stays low.
    ys, xs = np.nonzero((best >= level) & (best >= inner) & (clean >= 3 * noise))
    out: list[dict[str, float]] = []
    for y, x in sorted(zip(ys.tolist(), xs.tolist()), key=lambda p: (-best[p], p)):
        if any((s["xint"] - x) ** 2 + (s["yint"] - y) ** 2 <= spacing**2 for s in out) or not (1 <= y < image.shape[0] - 1 and 1 <= x < image.shape[1] - 1):
            continue
        stamp = np.clip(clean[y - 1 : y + 2, x - 1 : x + 2], 0, None)
        total = stamp.sum() or 1.0
        gy, gx = np.mgrid[-1:2, -1:2]
        out.append({"xint": x, "yint": y, "xcentroid": x + float((stamp * gx).sum() / total), "ycentroid": y + float((stamp * gy).sum() / total), "flux": float(clean[y - 1 : y + 2, x - 1 : x + 2].sum()), "peak": float(clean[y, x]), "snr": float(best[y, x])})
    return out


SOURCE_COLUMNS = "frame long, flux_sign int, xint int, yint int, xcentroid double, ycentroid double, flux double, peak double, snr double"


def detect(frames: DataFrame, level: float = 5.0) -> DataFrame:
    """Sources of both signs in each of ``frames (frame, ny, nx, img)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SOURCE_COLUMNS.split(", ")]
        for b in batches:
            rows = []
            for r in b.itertuples():
                image = np.asarray(r.img, dtype=float).reshape(r.ny, r.nx)
                rows += [{"frame": r.frame, "flux_sign": sign} | s for sign in (1, -1) for s in find_sources(sign * image, level=level)]
            yield pd.DataFrame(rows, columns=names)

    return frames.select("frame", "ny", "nx", "img").mapInPandas(run, SOURCE_COLUMNS)


def pixel(img: Column, x: Column, y: Column, nx: Column) -> Column:
    """Value at (x, y) of a flat image; null outside."""
    return F.try_element_at(img, (y * nx + x + 1).cast("int"))


def box_sum(img: Column, x: int, y: int, nx: int, ny: int, radius: int = 1) -> Column:
    """Sum of the pixels around a place; missing ones count as zero, and places outside the image don't exist."""
    at = [j * nx + i for j in range(max(0, y - radius), min(ny, y + radius + 1)) for i in range(max(0, x - radius), min(nx, x + radius + 1))]
    return sum((F.coalesce(F.nanvl(F.get(img, F.lit(k)).cast("double"), F.lit(None).cast("double")), F.lit(0.0)) for k in at), F.lit(0.0))


def _bound(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, though it is used for each element of an array."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _middle(values: Column) -> Column:
    """Median of an array without nulls, null if it is empty."""
    s, n = F.array_sort(values), F.size(values)
    return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)


def _deviation(values: Column) -> Column:
    """Population deviation of an array without nulls in one pass over it, null if it is empty."""

    def add(a: Column, v: Column) -> Column:
        n = a["n"] + 1
        mean = a["mean"] + (v - a["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (a["ss"] + (v - a["mean"]) * (v - mean)).alias("ss"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("ss"))
    return F.aggregate(values, start, add, lambda a: F.when(a["n"] > 0, F.sqrt(a["ss"] / a["n"])))


def frame_noise(frames: DataFrame) -> DataFrame:
    """1.4826 times the median absolute deviation of each frame's pixels, by sorted arrays within the row."""
    fine = frames.select("frame", F.transform(F.filter("img", lambda v: v.isNotNull() & ~F.isnan(v)), lambda v: v.cast("double")).alias("_v"))
    away = _bound(_middle(F.col("_v")), lambda m: F.transform("_v", lambda v: F.abs(v - m)))
    return fine.select("frame", away.alias("_a")).select("frame", (_middle(F.col("_a")) * 1.4826).alias("noise"))


def clipped_noise(frames: DataFrame, id_col: str = "frame", img: str = "img", sigma: float = 3.0, passes: int = 5) -> DataFrame:
    """Population deviation of each frame's pixels after ``passes`` cuts at ``sigma`` deviations from the median: ``(id, noise)``.

    Each pass is a projection over the row's own array; values at the bound stay.
    """
    out = frames.select(id_col, F.transform(F.filter(img, lambda v: v.isNotNull() & ~F.isnan(v)), lambda v: v.cast("double")).alias("_v"))
    for _ in range(passes):
        kept = _bound(F.struct(_middle(F.col("_v")).alias("m"), _deviation(F.col("_v")).alias("s")), lambda b: F.filter("_v", lambda v: F.abs(v - b["m"]) <= sigma * b["s"]))
        out = out.select(id_col, kept.alias("_v"))
    return out.select(id_col, _deviation(F.col("_v")).alias("noise"))


def deepest_below(img: Column, x: Column, y: Column, nx: int, ny: int, radius: float = 2.0) -> Column:
    """How far the lowest pixel of a disc lies below zero, at least 0; places outside the image count as zero."""
    reach = math.ceil(radius)
    disc = [(i, j) for j in range(-reach, reach + 1) for i in range(-reach, reach + 1) if i * i + j * j <= radius * radius]
    values = [F.when((x + i).between(0, nx - 1) & (y + j).between(0, ny - 1), F.get(img, ((y + j) * nx + x + i).cast("int")).cast("double")).otherwise(0.0) for i, j in disc]
    return F.when(x.isNotNull() & y.isNotNull(), F.greatest(F.lit(0.0), -F.least(*values)))


def annulus_deviation(img: Column, x: Column, y: Column, nx: int, ny: int, outer: int = 11, inner: int = 2) -> Column:
    """Population deviation of the pixels of a square about a place but for an inner disc.

    Places outside the image take the pixel at its edge, each time anew; missing
    pixels don't count.
    """
    side = 2 * outer + 1
    places = F.filter(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda k: F.pow(F.floor(k / side) - outer, 2) + F.pow(k % side - outer, 2) > inner * inner)
    clip = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), c.cast("int")))
    values = F.transform(places, lambda k: F.get(img, clip(y + F.floor(k / side) - outer, ny) * nx + clip(x + k % side - outer, nx)).cast("double"))
    return F.when(x.isNotNull() & y.isNotNull(), _deviation(F.filter(values, lambda v: v.isNotNull() & ~F.isnan(v))))


def bright_mask(img: Column, centre: int, level: float = 5.0, low: float = 3.0, high: float = 2.0, rounds: int = 10) -> Column:
    """Indices of the pixels of a stacked stamp that stand ``level`` deviations over its clipped median.

    The stamp is scaled so that its centre is 255, and capped there; median and
    deviation are those of what lies between ``low`` deviations below and ``high``
    above the median, cut up to ``rounds`` times. Null without a centre other than 0.
    """
    finite = lambda v: v.isNotNull() & ~F.isnan(v)
    middle = F.get(img, F.lit(centre)).cast("double")
    scaled = F.transform(img, lambda v: F.least(F.lit(255.0), v.cast("double") / middle * 255))
    measure = lambda v: F.struct(_middle(v).alias("m"), _deviation(v).alias("s"))
    step = lambda v, _: _bound(measure(v), lambda b: F.filter(v, lambda p: (p >= b["m"] - low * b["s"]) & (p <= b["m"] + high * b["s"])))

    def marked(image: Column) -> Column:
        kept = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.filter(image, finite), step)
        return _bound(measure(kept), lambda b: F.filter(F.sequence(F.lit(0), F.size(image) - 1), lambda k: finite(F.get(image, k)) & (F.get(image, k) > b["m"] + level * b["s"])))

    return F.when(finite(middle) & (middle != 0), _bound(scaled, marked))


def straight_lines(stamps: DataFrame, keys: Sequence[str], mask: str, side: int, votes: int = 10, shortest: int = 8, angles: int = 180) -> DataFrame:
    """Lines through the marked pixels of each stamp: ``(*keys, angle, distance, votes, length)``.

    ``mask`` lists marked pixels of a flat image ``side`` wide. A pixel votes, for
    each of ``angles`` directions of the normal over half a turn, for the line at its
    whole distance from the first pixel. A line counts with at least ``votes`` of them
    and a run without gaps, along the axis that it follows more closely, over at least
    ``shortest`` steps. All lines are tried, none drawn by chance. One grouping, with
    partial counts; what a line gathers is at most one number a column or row.
    """
    turn = F.radians(F.col("angle") * (180.0 / angles))
    x, y = F.col("_p") % side, F.floor(F.col("_p") / side).cast("int")
    # A ten-millionth decides what falls on a half, whatever the last digit of the cosine.
    distance = F.floor(x * F.cos(turn) + y * F.sin(turn) + 0.5 + 1e-7).cast("int")
    along = F.when(F.sin(turn) > F.abs(F.cos(turn)) + 1e-7, x).otherwise(y).cast("int")
    cast = stamps.select(*keys, F.explode(mask).alias("_p")).withColumn("angle", F.explode(F.sequence(F.lit(0), F.lit(angles - 1))))
    lines = cast.select(*keys, "angle", distance.alias("distance"), along.alias("_a")).groupBy(*keys, "angle", "distance").agg(F.count("*").alias("votes"), F.array_sort(F.collect_set("_a")).alias("_at")).filter(F.col("votes") >= votes)
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))
    step = lambda s, a: _bound(F.when(a == s["last"] + 1, s["run"] + 1).otherwise(0), lambda n: F.struct(a.alias("last"), n.alias("run"), F.greatest(s["best"], n).alias("best")))
    return lines.select(*keys, "angle", "distance", "votes", F.aggregate("_at", start, step, lambda s: s["best"]).alias("length")).filter(F.col("length") >= shortest)
