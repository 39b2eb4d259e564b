"""From detections and light curves to events: sessions, a first measure, extension, a masked second measure, classes.

Tables carry fixed names: detections ``(*keys, frame, time, flux_sign, snr, ...)``,
samples ``(*keys, frame, time, flux)`` (one light curve an object, null flux or a
missing frame where nothing was measured), events ``(*keys, eventid, flux_sign,
frame_start, frame_end, time_start, time_end, ...)``. Samples meet the events of
their object in buckets, so an object with a long history costs what lies near
its events, not its history times its events.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from chronoloom.operators import clusters, rollup, series
from chronoloom.sources.shared import materialize

_STATS = ["_med", "_std", "_slope", "_mean", "_hi", "_lo"]
_EVENT = ["eventid", "flux_sign", "frame_start", "frame_end", "time_start", "time_end"]


def number_events(detections: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Detections with ``eventid``: each sign's frames are split where more than ``gap`` apart.

    Ids run on from 1 through an object's signs, that with the earliest detection
    first (of equals the positive one).
    """
    keys = list(keys)
    own = series.sessions(detections, [*keys, "flux_sign"], "frame", gap, out="_own")
    signs = own.groupBy(*keys, "flux_sign").agg(F.max("_own").alias("_n"), F.min("frame").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_first", F.desc("flux_sign")).rowsBetween(Window.unboundedPreceding, -1)
    signs = signs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n", "_first")
    return own.join(signs, [*keys, "flux_sign"]).withColumn("eventid", (F.col("_own") + F.col("_before")).cast("long")).drop("_own", "_before")


def _meet(samples: DataFrame, events: DataFrame, keys: list[str], at: str, low: Column, high: Column, width: float) -> DataFrame:
    """Rows of both where ``at`` of a sample lies from ``low`` to ``high`` of an event, by buckets of ``width``."""
    bucket = lambda c: F.floor(c / width).cast("long")
    spread = events.withColumn("_b", F.explode(F.sequence(bucket(low), bucket(high))))
    return samples.withColumn("_b", bucket(F.col(at))).join(spread, [*keys, "_b"]).filter(F.col(at).between(low, high)).drop("_b")


def _objects(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows that are in order of their keys, an object at a time."""
    held = []
    whole = lambda: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    for b in batches:
        new = np.zeros(max(b.num_rows - 1, 0), bool)
        for k in keys:
            new |= pc.not_equal(b.column(k)[1:], b.column(k)[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for at, end in zip(edges, edges[1:]):
            if at == end:
                continue
            part = b.slice(at, end - at)
            if held and any(held[-1].column(k)[-1] != part.column(k)[0] for k in keys):
                yield whole()
                held = []
            held.append(part)
    if held:
        yield whole()


def _nearest(t: np.ndarray, f: np.ndarray, to: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The frame of the sample nearest to each of the times among those from place ``low`` to ``high``, none of them empty; of two equally near the earlier."""
    i = np.searchsorted(t, to)
    after, before = np.clip(i, low, high - 1), np.clip(i - 1, low, high - 1)
    before = np.maximum(np.searchsorted(t, t[before]), low)  # of equal times the first frame
    a, b = np.abs(t[after] - to), np.abs(t[before] - to)
    return np.where(a < b, f[after], np.where(b < a, f[before], np.minimum(f[after], f[before])))


def _measured(batches: Iterator[pa.RecordBatch], keys: list[str], buffer: float, far: float, masked: bool) -> Iterator[pa.RecordBatch]:
    """What ``measure`` needs of each event near which there are samples: of objects' samples (``_event`` 0) by time, then their events."""
    for obj in _objects(batches, keys):
        n = int(np.searchsorted(obj.column("_event").to_numpy(), 1))
        if n in (0, obj.num_rows):
            continue
        curve, found = obj.slice(0, n), obj.slice(n)
        t, f = (curve.column(c).to_numpy() for c in ("time", "frame"))
        ok, flux = curve.column("flux").is_valid().to_numpy(zero_copy_only=False), curve.column("flux").to_numpy(zero_copy_only=False)
        ids, start, end, first, last = (found.column(c).to_numpy(zero_copy_only=False) for c in ("eventid", "time", "time_end", "frame", "frame_end"))
        low, high = np.searchsorted(t, start - 2 * far), np.searchsorted(t, end + 2 * far, "right")
        some = np.flatnonzero(low < high)
        found, ids, start, end, first, last, low, high = found.take(pa.array(some)), *(v[some] for v in (ids, start, end, first, last, low, high))
        w0, b0, b1, w1 = (_nearest(t, f, to, low, high) for to in (start - far, start - buffer, end + buffer, end + far))
        if masked:
            covered, cover = np.zeros(n, bool), np.zeros(n, np.int64)
            for e in np.argsort(ids, kind="stable"):
                at = slice(low[e], high[e])
                own = (f[at] >= first[e]) & (f[at] <= last[e])
                covered[at] |= own
                cover[at][own] = ids[e]
        rows = []
        for e in range(len(some)):
            at = slice(low[e], high[e])
            fr, v, good = f[at], flux[at], ok[at]
            ground = (((fr > w0[e]) & (fr < b0[e])) | ((fr < w1[e]) & (fr > b1[e]))) & good
            if masked:
                ground &= ~covered[at] | (cover[at] == ids[e])
            base, seen = np.sort(v[ground]), (fr >= first[e]) & (fr <= last[e]) & good
            k, med, std, slope, mean, hi, lo, hi_f, lo_f = len(base), None, None, None, None, None, None, None, None
            if k:
                med = float((base[(k - 1) // 2] + base[k // 2]) / 2) if base[(k - 1) // 2] != base[k // 2] else float(base[k // 2])
                std = float(base.std()) if base[0] != base[-1] else 0.0
                u = t[at][ground]
                u = u - u.mean()
                if (square := float(u @ u)) > 0:
                    slope = float(u @ (v[ground] - base.mean())) / square
            if seen.any():
                own, frames = v[seen], fr[seen]
                mean, hi, lo = float(own.mean()), float(own.max()), float(np.fmin.reduce(own))  # NaN is the greatest
                hi_f, lo_f = (int(frames[own == x if x == x else np.isnan(own)].min()) for x in (hi, lo))
            rows.append((k, med, std, slope, mean, hi, lo, hi_f, lo_f))
        if rows:
            kinds = [pa.int64(), *[pa.float64()] * 6, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*[found.column(c) for c in [*keys, "eventid"]], *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names=[*keys, "eventid", "n_base", *_STATS, "_hi_frame", "_lo_frame"])


def measure(samples: DataFrame, events: DataFrame, keys: Sequence[str], buffer: float, window: float, masked: bool = False) -> DataFrame:
    """The events with their light curve's baseline and significance.

    Baseline: samples strictly between the sample nearest to ``buffer + window``
    before the event and that nearest to ``buffer`` before it, and likewise
    behind it (of two equally near the earlier); ``masked`` leaves out what other
    events cover (a frame is the last event's by id). base_median and base_std (population) of it; lc_sig_max and
    lc_sig_med compare the event's greatest and mean flux with it, least and
    absolute values if flux_sign is negative. flux_max and frame_max are the peak and
    its first frame. lc_flat: slope a unit of time under two deviations, median
    under one, deviation under five. Fewer than two samples or no deviation: null
    significance, not flat. A sample is shuffled once, to its object, whose history
    is held in one task as columns; pairs with events are not made.
    """
    keys = list(keys)
    far = buffer + window
    up, kind = F.col("flux_sign") >= 0, samples.schema
    parts = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = lambda df, at, frame, **more: df.select(*keys, F.col(at).cast("double").alias("time"), F.col(frame).cast("long").alias("frame"), *[c.alias(n) for n, c in more.items()]).dropna(subset=[*keys, "time", "frame"])
    none = F.lit(None)
    curves = plain(samples, "time", "frame", flux=F.col("flux").cast("double"), eventid=none.cast("long"), time_end=none.cast("double"), frame_end=none.cast("long"))
    spans = plain(events, "time_start", "frame_start", flux=none.cast("double"), eventid=F.col("eventid").cast("long"), time_end=F.col("time_end").cast("double"), frame_end=F.col("frame_end").cast("long"))
    both = curves.withColumn("_event", F.lit(0)).unionByName(spans.withColumn("_event", F.lit(1))).repartition(parts, *keys).sortWithinPartitions(*keys, "_event", "time", "frame")
    out = StructType([*[StructField(k, both.schema[k].dataType) for k in [*keys, "eventid"]], StructField("n_base", LongType()), *[StructField(c, DoubleType()) for c in _STATS], StructField("_hi_frame", LongType()), StructField("_lo_frame", LongType())])
    stat = both.mapInArrow(lambda batches: _measured(batches, keys, buffer, far, masked), out).withColumns({c: F.col(c).cast(kind["flux"].dataType) for c in ("_hi", "_lo")})
    stat = stat.withColumns({f"_{c}": F.struct(F.col(f"_{c}").alias("v"), F.col(f"_{c}_frame").cast(kind["frame"].dataType).alias("f")) for c in ("hi", "lo")})
    stat = stat.withColumn("eventid", F.col("eventid").cast(events.schema["eventid"].dataType)).join(events.select(*keys, "eventid", "flux_sign"), [*keys, "eventid"])
    sigma, med = F.when((F.col("n_base") >= 2) & (F.col("_std") > 0), F.col("_std")), F.when(F.col("n_base") >= 2, F.col("_med"))
    peak = F.when(up, F.col("_hi.v")).otherwise(F.col("_lo.v"))
    signed = lambda v: F.when(up, (v - med) / sigma).otherwise(F.abs((v - med) / sigma))
    flat = (F.abs(F.col("_slope")) / sigma < 2) & (F.abs(med) < sigma) & (sigma < 5)
    stat = stat.select(
        *keys, "eventid", "n_base", med.alias("base_median"), sigma.alias("base_std"), signed(peak).alias("lc_sig_max"), signed(F.col("_mean")).alias("lc_sig_med"), peak.alias("flux_max"),
        F.when(up, F.col("_hi.f")).otherwise(F.col("_lo.f")).alias("frame_max"), F.coalesce(flat, F.lit(False)).cast("int").alias("lc_flat"),
    )
    return events.join(stat, [*keys, "eventid"], "left").withColumn("lc_flat", F.coalesce("lc_flat", F.lit(0)))


def significances(samples: DataFrame, events: DataFrame, keys: Sequence[str], reach: int = 0) -> DataFrame:
    """``(*keys, eventid, frame, time, significance, frame_start, frame_end)`` of the samples up to ``reach`` frames from a measured event, signed as the event."""
    keys = list(keys)
    low, high = F.col("frame_start") - reach, F.col("frame_end") + reach
    rows = _meet(samples.select(*keys, "frame", "time", "flux"), events.select(*keys, "eventid", "flux_sign", "frame_start", "frame_end", "base_median", "base_std"), keys, "frame", low, high, max(64, 2 * reach))
    return rows.select(*keys, "eventid", "frame", "time", ((F.col("flux") - F.col("base_median")) / F.col("base_std") * F.col("flux_sign")).alias("significance"), "frame_start", "frame_end")


def extend(samples: DataFrame, events: DataFrame, triggers: DataFrame, keys: Sequence[str], level: float = 3.0, misses: int = 5, reach: int = 64) -> DataFrame:
    """Measured events lengthened while frames reach ``level``: ``(*keys, eventid, frame_start, frame_end, time_start, time_end, n_detections)``.

    All frames at ``level`` within an event count, and outwards those before the
    ``misses``-th frame in all (not in a row) that isn't; a frame without a sample
    is a miss. ``triggers (*keys, eventid, frame, time)`` count whatever their
    level. The walk looks ``reach`` frames ahead; only events that have not
    ended by then are looked at again, eight times as far.
    """
    keys, event = list(keys), [*keys, "eventid"]
    if reach < misses:
        raise ValueError("reach must hold the misses")
    todo, kept = events.filter("base_std is not null"), []
    frame, start, end = F.col("frame"), F.col("frame_start"), F.col("frame_end")
    right, left = frame > end, frame < start
    while True:
        own = Window.partitionBy(*event)
        hits = significances(samples, todo, keys, reach).filter(F.col("significance") >= level)
        after = F.count(F.when(right, 1)).over(own.orderBy("frame").rowsBetween(Window.unboundedPreceding, 0))
        before = F.count(F.when(left, 1)).over(own.orderBy(F.desc("frame")).rowsBetween(Window.unboundedPreceding, 0))
        missed = F.when(right, frame - end - F.col("_after")).when(left, start - frame - F.col("_before")).otherwise(0)
        hits = hits.withColumns({"_after": after, "_before": before}).withColumn("_missed", missed)
        most = F.greatest(F.count(F.when(right, 1)).over(own), F.count(F.when(left, 1)).over(own))
        hits = materialize(hits.withColumn("_open", reach - most < misses).filter((F.col("_missed") < misses) | F.col("_open")).select(*event, "frame", "time", "_open"), "hits")
        kept.append(hits.filter("not _open").select(*event, "frame", "time"))
        still = hits.filter("_open").select(*event).distinct()
        if still.isEmpty():
            break
        todo, reach = todo.join(still, event, "left_semi"), reach * 8
    frames = triggers.select(*event, "frame", "time")
    for k in kept:
        frames = frames.unionByName(k)
    frames = frames.groupBy(*event, "frame").agg(F.min("time").alias("time"))
    return frames.groupBy(*event).agg(F.min("frame").alias("frame_start"), F.max("frame").alias("frame_end"), F.min_by("time", "frame").alias("time_start"), F.max_by("time", "frame").alias("time_end"), F.count("*").alias("n_detections"))


def assemble_events(detections: DataFrame, samples: DataFrame, keys: Sequence[str], gap: int, buffer: float, window: float, level: float = 3.0, misses: int = 5, carry: Sequence[str] = ("x", "y")) -> DataFrame:
    """Events of detections, as one chain.

    Detections of an object and sign become events by ``gap``; ``carry`` and
    their variances ``e_*`` are weighted by ``snr``; the light curve is measured, the event
    extended by it, measured again without what the object's other events cover,
    and events of the finest resolution (``frame_bin`` 1, the only one if the column is absent) are
    told from particle hits and junk. Objects without samples keep their
    detections' bounds. Empty detections give an empty result.
    """
    keys, event = list(keys), [*keys, "eventid"]
    found = number_events(detections, keys, gap)
    bin_ = F.first("frame_bin") if "frame_bin" in detections.columns else F.lit(1)
    bounds = found.groupBy(*event).agg(
        F.min("flux_sign").alias("flux_sign"), bin_.alias("frame_bin"), F.min("frame").alias("frame_start"), F.max("frame").alias("frame_end"),
        F.min_by("time", "frame").alias("time_start"), F.max_by("time", "frame").alias("time_end"), F.max("snr").alias("image_sig_max"))
    centres = rollup.weighted_mean_variance(found, event, "snr", list(carry)).drop("n")
    first = materialize(measure(samples, bounds, keys, buffer, window).select(*event, *_EVENT[1:], "frame_bin", "image_sig_max", "base_median", "base_std"), "events")
    longer = extend(samples, first, found, keys, level, misses)
    events = materialize(first.select(*event, "flux_sign", "frame_bin", "image_sig_max").join(longer, event).withColumn("frame_duration", F.col("frame_end") - F.col("frame_start") + 1), "events")
    second = materialize(measure(samples, events, keys, buffer, window, masked=True), "events")
    classes = clusters.spike_class(significances(samples, second, keys), second, event, "frame", "significance").select(*event, "classification")
    out = second.drop("n_base", "base_median", "base_std").join(centres, event).join(classes, event)
    return rollup.with_count(out, keys, "total_events")


def recheck_moving(samples: DataFrame, events: DataFrame, keys: Sequence[str], buffer: float, window: float, level: float = 3.0, misses: int = 5, moving: str = "Asteroid") -> DataFrame:
    """Events with the bounds of ``moving`` ones found anew from their light curve, as positive ones without what other events cover.

    n_detections grows by the frames gained, frame_duration is the difference of
    the bounds (without one more). Other events stay as they are.
    """
    keys, event = list(keys), [*keys, "eventid"]
    chosen = F.col("classification") == moving
    plain = events.select(*event, F.lit(1).alias("flux_sign"), *_EVENT[2:], chosen.alias("_chosen"))
    measured = materialize(measure(samples, plain, keys, buffer, window, masked=True).filter("_chosen"), "moving")
    ends = measured.select(*event, F.explode(F.array(F.struct(F.col("frame_start").alias("frame"), F.col("time_start").alias("time")), F.struct(F.col("frame_end").alias("frame"), F.col("time_end").alias("time")))).alias("e")).select(*event, "e.*")
    names = ["frame_start", "frame_end", "time_start", "time_end"]
    longer = extend(samples, measured, ends, keys, level, misses).select(*event, *[F.col(n).alias(f"_{n}") for n in names])
    out = events.join(longer, event, "left")
    gained = (F.col("frame_start") - F.col("_frame_start")) + (F.col("_frame_end") - F.col("frame_end"))
    new = {"n_detections": F.col("n_detections") + F.coalesce(gained, F.lit(0)), "frame_duration": F.coalesce(F.col("_frame_end") - F.col("_frame_start"), F.col("frame_duration"))}
    return out.withColumns(new | {n: F.coalesce(f"_{n}", n) for n in names}).select(*events.columns)
