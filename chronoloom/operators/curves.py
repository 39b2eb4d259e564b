"""Light curves and frames around events: windows, times, cut-outs, positions, calibrated units.

Frames of an image series are numbered from 0 at each resolution. Rows of a
series and events meet on their object (or in buckets of frames), never as all
pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions import photometry
from chronoloom.functions.values import known, round_half_up


def window_bounds(start: Column, end: Column, n_frames: Column, buffer: int) -> tuple[Column, Column]:
    """First and last frame of a light curve: ``buffer`` before the event and one more than that behind it, within the series.

    A buffer of -1 takes the whole series. Null where the event's bounds are.
    """
    last = n_frames - 1
    if buffer == -1:
        return F.lit(0).cast("long"), last.cast("long")
    low, high = F.greatest(round_half_up(start) - buffer, F.lit(0).cast("long")), F.least(round_half_up(end) + buffer + 1, last).cast("long")
    both = start.isNotNull() & end.isNotNull()
    return F.when(both, low), F.when(both, high)


def event_light_curves(series: DataFrame, events: DataFrame, keys: Sequence[str], frame: str, n_frames: Column, buffer: int = 10, start: str = "frame_start", end: str = "frame_end", width: int = 64) -> DataFrame:
    """The samples of each event's window: ``events``' columns, ``window_start``, ``window_end`` and those of the series.

    ``n_frames`` is an expression over the event (its resolution's length). Windows
    and samples meet on the keys and in buckets of ``width`` frames, so that a hot
    object's samples spread over many tasks. Windows may overlap.
    """
    low, high = window_bounds(F.col(start), F.col(end), n_frames, buffer)
    windows = events.withColumn("window_start", low).withColumn("window_end", high).filter("window_start <= window_end")
    windows = windows.withColumn("_b", F.explode(F.sequence(F.floor(F.col("window_start") / width).cast("long"), F.floor(F.col("window_end") / width).cast("long"))))
    samples = series.withColumn("_b", F.floor(F.col(frame) / width).cast("long"))
    return samples.join(windows, [*keys, "_b"]).filter(F.col(frame).between(F.col("window_start"), F.col("window_end"))).drop("_b")


def box_error(noise: Column, radius: int = 1) -> Column:
    """Error of a sum over a box of (2 radius + 1)^2 pixels with background noise of ``noise`` each."""
    return float(2 * radius + 1) * noise


def captured(prf: Column, x: Column, y: Column, side: int, radius: int = 1) -> Column:
    """Share of a point source's light that falls into a box of (2 radius + 1)^2 pixels about the pixel nearest to it.

    ``prf`` is the flat image, ``side`` wide (odd), of a source in the middle of its
    central pixel; x and y are where in its pixel the source lies, from -0.5 to 0.5.
    The image is moved there bilinearly and counts for 1 over the stamp. Null
    without an image that adds up to something above zero.
    """
    mid = side // 2

    def share(at: Column, off: Column, reach: int) -> Column:
        """How much of a column (or row) of the image ends up within ``reach`` of the centre."""
        first, part = F.floor(off), off - F.floor(off)
        held = lambda moved: (F.abs(moved - mid) <= reach).cast("int")
        return (1 - part) * held(at + first) + part * held(at + first + 1)

    def moved(reach: int) -> Column:
        light = lambda k: F.coalesce(known(F.get(prf, k)), F.lit(0.0)) * share(k % side, x, reach) * share(F.floor(k / side), y, reach)
        return F.aggregate(F.sequence(F.lit(0), F.lit(side * side - 1)), F.lit(0.0), lambda s, k: s + light(k))

    whole = moved(mid)
    return F.when(F.size(prf) == side * side, moved(radius) / F.when(whole > 0, whole))


def aperture_shares(objects: DataFrame, prfs: DataFrame, keys: Sequence[str], side: int, x: str = "xcentroid", y: str = "ycentroid", radius: int = 1, bucket: int = 100, out: str = "aperture") -> DataFrame:
    """``objects`` with the share of light in their box: their detector's image for the part of it that they lie in.

    ``prfs (*keys, bx, by, prf)`` holds an image for each part of ``bucket`` pixels;
    parts without one leave the share null. Positions are the detector's.
    """
    part = lambda c: F.floor(F.col(c) / bucket).cast("long")
    placed = objects.withColumns({"_bx": part(x), "_by": part(y)})
    own = prfs.groupBy(*keys, F.col("bx").alias("_bx"), F.col("by").alias("_by")).agg(F.min("prf").alias("_prf"))
    sub = lambda c: F.col(c) - round_half_up(F.col(c))
    return placed.join(own, [*keys, "_bx", "_by"], "left").select(*objects.columns, captured(F.col("_prf"), sub(x), sub(y), side, radius).alias(out))


def chosen_events(group: DataFrame, keys: Sequence[str], events: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """Events of a table to draw light curves of: those in ``events (objid, eventid)``, else the best ``n``, else all.

    Best are the least ``delta_bic``, else the greatest ``stability`` (missing ones
    last, ties by the keys), else the first by the keys. Without ``objid``,
    ``eventid`` and the keys the table is refused.
    """
    need = dict.fromkeys([*keys, "objid", "eventid"])
    missing = sorted(set(need) - set(group.columns))
    if missing:
        raise ValueError(f"the table is missing columns: {missing}")
    if events is not None:
        return group.join(events.select("objid", "eventid").distinct(), ["objid", "eventid"], "left_semi")
    if n is None:
        return group
    first = [known(F.col("delta_bic")).asc_nulls_last()] if "delta_bic" in group.columns else [known(F.col("stability")).desc_nulls_last()] if "stability" in group.columns else []
    return group.orderBy(*first, *need).limit(n)


def in_units(curves: DataFrame, zeropoints: DataFrame, keys: Sequence[str], unit: str, flux: str = "flux", error: str = "flux_err", zp: str = "zp_ab", aperture: str | None = None) -> DataFrame:
    """Fluxes in ``unit`` by the zeropoint of their cut; counts where the cut has none. Adds ``units``.

    The first zeropoint of a cut (the least) counts, so a repeated one adds no rows.
    ``aperture`` names a column with the share of the light that was summed (null: all).
    """
    own = zeropoints.groupBy(*keys).agg(F.min(zp).alias("_zp"))
    point = F.col("_zp") if aperture is None else F.col("_zp") + 2.5 * F.log10(F.coalesce(aperture, F.lit(1.0)))
    value, err = photometry.convert_flux(F.col(flux), F.col(error), point, F.lit(unit))
    units = F.when(F.col("_zp").isNull(), "counts").otherwise(F.lit(unit))
    return curves.join(own, list(keys), "left").select(*[c for c in curves.columns if c not in (flux, error)], value.alias(flux), err.alias(error), units.alias("units"))


def cutout_frames(start: Column, end: Column, peak: Column, n_frames: Column, buffer: int = 2, interval: int = 1, frame_bin: Column | None = None, least: int = 5) -> Column:
    """Frames to cut out around an event, in order: every ``interval`` bins from ``buffer`` before to ``buffer`` behind it, and the brightest.

    Fewer than ``least`` are continued at the same step behind the last; frames
    outside the series move to its ends, and each is listed once. Null where a
    bound or the brightest is.
    """
    step = F.lit(interval).cast("long") if frame_bin is None else round_half_up(interval * frame_bin)
    low, high, top = round_half_up(start) - buffer, round_half_up(end) + buffer, round_half_up(peak)
    frames = F.array_sort(F.array_union(F.sequence(low, F.greatest(low, high), step), F.array(top)))
    more = F.transform(F.filter(F.sequence(F.lit(1), F.lit(least)), lambda k: k <= least - F.size(frames)), lambda k: F.element_at(frames, -1) + k * step)
    bounded = F.transform(F.concat(frames, more), lambda f: F.greatest(F.lit(0).cast("long"), F.least(f, (n_frames - 1).cast("long"))))
    return F.when(start.isNotNull() & end.isNotNull() & peak.isNotNull(), F.array_sort(F.array_distinct(bounded)))


def cutout_box(x: Column, y: Column, nx: int, ny: int, size: int = 11) -> tuple[Column, Column, Column, Column]:
    """Inclusive bounds of a cut-out about a position, clipped to the image: least and greatest x, least and greatest y."""
    h = size // 2
    cx, cy = round_half_up(x), round_half_up(y)
    zero = F.lit(0).cast("long")
    bounds = ((cx, F.greatest(cx - h, zero)), (cx, F.least(cx + h, F.lit(nx - 1).cast("long"))), (cy, F.greatest(cy - h, zero)), (cy, F.least(cy + h, F.lit(ny - 1).cast("long"))))
    return tuple(F.when(at.isNotNull(), b) for at, b in bounds)


def frames_of_events(frames: DataFrame, events: DataFrame, wanted: Column, frame: str = "frame") -> DataFrame:
    """The images of each event's frames: the wanted frames are exploded to an equi join."""
    return events.withColumn(frame, F.explode(wanted)).join(frames, frame)


def true_times(events: DataFrame, times: DataFrame, columns: Sequence[str] = ("frame_start", "frame_end", "frame_max"), frame_bin: str = "frame_bin", frame: str = "frame", time: str = "mjd") -> DataFrame:
    """Times of binned frames: ``mjd_*`` for each ``frame_*`` by the frame that begins the bin, at most the last; and ``mjd_duration``."""
    last, out = times.agg(F.max(frame)).scalar(), events
    for c in columns:
        name = "mjd_" + c.removeprefix("frame_")
        own = times.select(F.col(frame).alias("_f"), F.col(time).alias(name))
        begin = round_half_up(F.col(c) * F.col(frame_bin))
        at = F.when(begin.isNotNull(), F.least(begin, last))  # ``least`` alone would pass over a null
        out = out.withColumn("_at", at).join(own, F.col("_at") == F.col("_f"), "left").drop("_at", "_f")
    if {"mjd_start", "mjd_end"} <= set(out.columns):
        out = out.withColumn("mjd_duration", F.col("mjd_end") - F.col("mjd_start"))
    return out


def frame_after(series: DataFrame, peaks: DataFrame, keys: Sequence[str], frame: str, time: str, peak_time: str, wait: float = 1 / 24) -> DataFrame:
    """For each peak the first frame at least ``wait`` behind it, else the last at least ``wait`` before it, else null.

    ``peaks`` has one row for each of ``keys``; both choices are aggregates of one pass over the series.
    """
    t, p = F.col(time), F.col(peak_time)
    met = series.join(peaks.select(*keys, peak_time), list(keys))
    found = met.groupBy(*keys).agg(F.coalesce(F.min(F.when(t - p >= wait, F.col(frame))), F.max(F.when(p - t >= wait, F.col(frame)))).alias("after"))
    return peaks.join(found, list(keys), "left")


def chosen_position(likeness: Column, fitted: tuple[Column, Column], fitted_error: tuple[Column, Column], seen: tuple[Column, Column], least: float = 0.5, seen_error: float = 0.5) -> list[Column]:
    """An event's position, its errors and pixel: the fitted one where the event looks like a point, else that of the detections."""
    good = F.coalesce(likeness > least, F.lit(False))
    x, y = (F.when(good, f).otherwise(s) for f, s in zip(fitted, seen))
    ex, ey = (F.when(good, e).otherwise(F.lit(seen_error)) for e in fitted_error)
    return [x.alias("xcentroid"), y.alias("ycentroid"), ex.alias("xcentroid_err"), ey.alias("ycentroid_err"), round_half_up(x).alias("xint"), round_half_up(y).alias("yint")]


#: Sectors from which on a list of time bins holds.
TIME_BINS = (
    (56, ("200sec", "30min", "1hr", "6hr", "24hr")),
    (27, ("10min", "30min", "1hr", "3hr", "12hr", "24hr")),
    (None, ("30min", "1hr", "2hr", "6hr", "24hr")),
)


def default_time_bins(sector: Column) -> Column:
    """The bins of a sector's cadence."""
    out = F.array(*map(F.lit, TIME_BINS[-1][1]))
    for first, names in reversed(TIME_BINS[:-1]):
        out = F.when(sector >= first, F.array(*map(F.lit, names))).otherwise(out)
    return F.when(sector.isNotNull(), out)


def camera_order(declination: Column) -> Column:
    """Cameras from top to bottom: 4 to 1 in the north, 1 to 4 in the south."""
    return F.when(declination > 0, F.array(*map(F.lit, (4, 3, 2, 1)))).otherwise(F.array(*map(F.lit, (1, 2, 3, 4))))


def curve_name(sector: Column, cam: Column, ccd: Column, cut: Column, objid: Column, eventid: Column | None, method: str, unit: str) -> Column:
    """Name of a light curve's table."""
    event = F.lit("") if eventid is None else F.when(eventid.isNotNull(), F.format_string("E%d", eventid)).otherwise("")
    return F.concat(F.format_string("S%dC%dC%dC%dO%d", sector, cam, ccd, cut, objid), event, F.lit(f"_{method}_{unit}.csv"))
