"""Queries over light curves and frames: an hour of the stream is a frame, a user an object, a session an event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.operators import curves, detect, robust
from chronoloom.plans.catalogue import EVENTS, event_table
from chronoloom.plans.registry import query, r, table
from chronoloom.plans.series import FRAMES, frames, sessions

#: Hours of the thirty days that the stream covers.
LAST = 719

HOURS = FRAMES + """, hr as (select user_id, frame // 60 as hour, sum(value) as flux from ev group by all),
mid as (select hour, median(flux) as m from hr group by 1), noise as (select hour, 1.4826 * median(abs(flux - m)) as noise from hr join mid using (hour) group by 1),
es as (select user_id, cast(eventid as bigint) as eventid, min(frame) // 60 as hs, max(frame) // 60 as he, arg_max(frame, (value, -event_id)) // 60 as pk from ses group by user_id, eventid)
"""


def _hours(spark: SparkSession, d: str) -> DataFrame:
    """Flux and noise of each user's hours."""
    hr = frames(spark, d).groupBy("user_id", F.expr("div(frame, 60)").alias("hour")).agg(F.sum("value").alias("flux"))
    mid = hr.groupBy("hour").agg(F.median("flux").alias("m"))
    noise = hr.join(mid, "hour").groupBy("hour").agg((F.median(F.abs(F.col("flux") - F.col("m"))) * 1.4826).alias("noise"))
    return hr.join(noise, "hour")


def _events(spark: SparkSession, d: str) -> DataFrame:
    best = F.max_by("frame", F.struct("value", -F.col("event_id")))
    ev = sessions(spark, d).groupBy("user_id", F.col("eventid").cast("long").alias("eventid")).agg(F.min("frame").alias("s"), F.max("frame").alias("e"), best.alias("p"))
    return ev.select("user_id", "eventid", F.expr("div(s, 60)").alias("frame_start"), F.expr("div(e, 60)").alias("frame_end"), F.expr("div(p, 60)").alias("frame_max"))


@query(HOURS + """, w as (select *, greatest(hs - 10, 0) as a, least(he + 11, 719) as b from es), z as (select user_id, case when user_id % 4 > 0 then 20.03 + user_id % 7 / 10.0 end as zp from (select distinct user_id from ev))
select user_id, eventid, hour, round(case when zp is null then flux else flux * 3631000 / pow(10, 0.4 * zp) end, 6) as flux, round(3 * noise * case when zp is null then 1 else 3631000 / pow(10, 0.4 * zp) end, 6) as flux_err,
  case when zp is null then 'counts' else 'mJy' end as units
from hr join w using (user_id) join noise using (hour) join z using (user_id) where hour between a and b""")
def event_light_curve(spark: SparkSession, d: str) -> DataFrame:
    """Ten frames around each event in millijansky, in counts for a quarter of the users, who have no zeropoint."""
    lc = curves.event_light_curves(_hours(spark, d), _events(spark, d), ["user_id"], "hour", F.lit(LAST + 1))
    lc = lc.select("user_id", "eventid", "hour", "flux", curves.box_error(F.col("noise")).alias("flux_err"))
    zp = table(spark, d, "events").select("user_id").distinct().filter("user_id % 4 > 0").withColumn("zp_ab", 20.03 + F.col("user_id") % 7 / 10.0)
    return curves.in_units(lc, zp, ["user_id"], "mJy").withColumns({"flux": r("flux"), "flux_err": r("flux_err")})


@query(HOURS + "select user_id, hour, round(flux, 6) as flux, round(3 * noise, 6) as flux_err from hr join noise using (hour)")
def object_light_curve(spark: SparkSession, d: str) -> DataFrame:
    objects = _events(spark, d).groupBy("user_id").agg(F.min("frame_start").alias("frame_start"), F.max("frame_end").alias("frame_end"))
    lc = curves.event_light_curves(_hours(spark, d), objects, ["user_id"], "hour", F.lit(LAST + 1), buffer=-1)
    return lc.select("user_id", "hour", r("flux").alias("flux"), r(curves.box_error(F.col("noise"))).alias("flux_err"))


@query(HOURS + """, f as (select *, list_sort(list_distinct(list_concat(range(hs - 2, he + 3, 2), [pk]))) as fr from es),
g as (select *, list_concat(fr, [fr[-1] + k * 2 for k in range(1, greatest(1, 6 - len(fr)))]) as more from f),
h as (select *, list_sort(list_distinct([least(719, greatest(0, x)) for x in more])) as wanted from g)
select user_id, eventid, array_to_string(wanted, ',') as wanted from h""")
def event_frame_lists(spark: SparkSession, d: str) -> DataFrame:
    wanted = curves.cutout_frames(F.col("frame_start"), F.col("frame_end"), F.col("frame_max"), F.lit(LAST + 1), interval=2)
    return _events(spark, d).select("user_id", "eventid", F.array_join(wanted.cast("array<string>"), ",").alias("wanted"))


@query(HOURS + """, f as (select *, list_distinct(list_concat(range(hs - 2, he + 3), [pk])) as fr from es), g as (select user_id, eventid, unnest(fr) as hour from f),
i as (select hour, count(*) as n, sum(flux) as total from hr group by 1)
select user_id, eventid, hour, n, round(total, 6) as total from g join i using (hour) where hour between 0 and 719""")
def event_frames(spark: SparkSession, d: str) -> DataFrame:
    """Each event's frames joined with what the frame holds (here: all users' flux of the hour)."""
    images = _hours(spark, d).groupBy("hour").agg(F.count("*").alias("n"), F.sum("flux").alias("total"))
    wanted = curves.cutout_frames(F.col("frame_start"), F.col("frame_end"), F.col("frame_max"), F.lit(LAST + 1), least=0)
    inside = F.filter(wanted, lambda f: f.between(F.greatest(F.lit(0), F.col("frame_start") - 2), F.col("frame_end") + 2) | (f == F.col("frame_max")))
    return curves.frames_of_events(images, _events(spark, d), inside, "hour").select("user_id", "eventid", "hour", "n", r("total").alias("total"))


@query("""select vec_id, greatest(vec_id % 9 - 5, 0) as x0, least(vec_id % 9 + 5, 15) as x1, greatest(vec_id % 16 - 5, 0) as y0, least(vec_id % 16 + 5, 15) as y1 from embeddings""")
def cutout_boxes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("vec_id")
    box = curves.cutout_box(k % 9, k % 16, 16, 16)
    return table(spark, d, "embeddings").select("vec_id", *[c.cast("long").alias(n) for c, n in zip(box, ("x0", "x1", "y0", "y1"))])


@query(HOURS + """, p as (select user_id, arg_max(hour, (flux, -hour)) as peak from hr group by 1)
select user_id, any_value(peak) as peak, coalesce(min(hour) filter (where hour - peak >= 12), max(hour) filter (where peak - hour >= 12)) as after from hr join p using (user_id) group by 1""")
def frame_after_peak(spark: SparkSession, d: str) -> DataFrame:
    hr = _hours(spark, d)
    peaks = hr.groupBy("user_id").agg(F.max_by("hour", F.struct("flux", -F.col("hour"))).alias("peak"))
    return curves.frame_after(hr.withColumn("t", F.col("hour")), peaks, ["user_id"], "hour", "t", "peak", 12).select("user_id", "peak", "after")


@query(HOURS + """, t as (select distinct hour as f, 60310 + hour / 24.0 as mjd from hr), e as (select user_id, eventid, hs, he, [1, 4, 24][eventid % 3 + 1] as bin from es),
b as (select user_id, eventid, bin, hs // bin as s, he // bin + eventid % 4 as e, (select max(f) from t) as last from e)
select user_id, eventid, round(a.mjd, 6) as mjd_start, round(z.mjd, 6) as mjd_end, round(z.mjd - a.mjd, 6) as mjd_duration from b left join t a on a.f = least(s * bin, last) left join t z on z.f = least(e * bin, last)""")
def event_times(spark: SparkSession, d: str) -> DataFrame:
    """Times of events at three resolutions; bins that would begin behind the last frame take its time."""
    times = _hours(spark, d).select(F.col("hour").alias("frame"), (60310 + F.col("hour") / 24.0).alias("mjd")).distinct()
    b = F.element_at(F.array(F.lit(1), F.lit(4), F.lit(24)), (F.col("eventid") % 3 + 1).cast("int"))
    ev = _events(spark, d).withColumn("frame_bin", b)
    ev = ev.select("user_id", "eventid", "frame_bin", F.floor(F.col("frame_start") / F.col("frame_bin")).alias("frame_start"), (F.floor(F.col("frame_end") / F.col("frame_bin")) + F.col("eventid") % 4).alias("frame_end"))
    out = curves.true_times(ev, times, ("frame_start", "frame_end"))
    return out.select("user_id", "eventid", *[r(c).alias(c) for c in ("mjd_start", "mjd_end", "mjd_duration")])


@query(EVENTS + """select eventid, case when psf_like > 0.5 then xccd + 0.2 else xccd end as xcentroid, case when psf_like > 0.5 then yccd - 0.3 else yccd end as ycentroid, case when psf_like > 0.5 then xcentroid_err else 0.5 end as xcentroid_err,
  case when psf_like > 0.5 then ycentroid_err else 0.5 end as ycentroid_err, cast(floor(case when psf_like > 0.5 then xccd + 0.25 else xccd + 0.05 end + 0.45) as bigint) as xint, cast(floor(case when psf_like > 0.5 then yccd - 0.25 else yccd + 0.05 end + 0.45) as bigint) as yint from et""")
def event_positions(spark: SparkSession, d: str) -> DataFrame:
    ev = event_table(spark, d)
    x, y = F.col("xccd"), F.col("yccd")
    return ev.select("eventid", *curves.chosen_position(F.col("psf_like"), (x + 0.2, y - 0.3), (F.col("xcentroid_err"), F.col("ycentroid_err")), (x, y)))


@query("""with u as (select distinct user_id, user_id % 70 as sector, user_id % 180 - 90 as dec from events)
select user_id, case when sector < 27 then '30min 1hr 2hr 6hr 24hr' when sector < 56 then '10min 30min 1hr 3hr 12hr 24hr' else '200sec 30min 1hr 6hr 24hr' end as bins, case when dec > 0 then '4 3 2 1' else '1 2 3 4' end as cameras from u""")
def sector_defaults(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "events").select("user_id").distinct()
    cameras = curves.camera_order(F.col("user_id") % 180 - 90).cast("array<string>")
    return u.select("user_id", F.array_join(curves.default_time_bins(F.col("user_id") % 70), " ").alias("bins"), F.array_join(cameras, " ").alias("cameras"))


@query("""with e as (select event_id, 'S' || event_id % 70 || 'C' || event_id % 4 || 'C' || event_id % 3 || 'C' || event_id % 16 || 'O' || user_id as stem, event_id % 5 as k from events)
select event_id, stem || case when k > 0 then 'E' || k else '' end || '_aperture_mJy.csv' as name from e""")
def curve_names(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, d, "events").select("event_id", curves.curve_name(k % 70, k % 4, k % 3, k % 16, F.col("user_id"), F.when(k % 5 > 0, k % 5), "aperture", "mJy").alias("name"))


ZEROPOINTS = """with v as (select l_linenumber % 2 as cam, l_suppkey % 3 as ccd, l_partkey % 5 as sector, 20 + l_discount * 10 + l_tax as z from lineitem)"""


@query(ZEROPOINTS + """, m as (select 'detector' as kind, cam, ccd, sector, 2.5 * log10(median(pow(10, 0.4 * z))) as zp, median(z) as m, count(*) as n from v group by cam, ccd, sector
  union all select 'sector', null, null, sector, 2.5 * log10(median(pow(10, 0.4 * z))), median(z), count(*) from v group by sector)
select m.kind, m.cam, m.ccd, m.sector, round(any_value(zp), 6) as zp, round(1.4826 * median(abs(z - m)), 6) as scatter, any_value(n) as n from m join v on v.sector = m.sector and (m.kind = 'sector' or (v.cam = m.cam and v.ccd = m.ccd)) group by 1, 2, 3, 4""")
def zeropoint_series(spark: SparkSession, d: str) -> DataFrame:
    """Per detector and sector, and per sector."""
    v = table(spark, d, "lineitem").select((F.col("l_linenumber") % 2).alias("cam"), (F.col("l_suppkey") % 3).alias("ccd"), (F.col("l_partkey") % 5).alias("sector"), (20 + F.col("l_discount") * 10 + F.col("l_tax")).alias("z"))
    own = robust.zeropoint_series(v, ["cam", "ccd", "sector"], "z").withColumn("kind", F.lit("detector"))
    both = own.unionByName(robust.zeropoint_series(v, ["sector"], "z").withColumn("kind", F.lit("sector")), allowMissingColumns=True)
    return both.select("kind", "cam", "ccd", "sector", r("zp").alias("zp"), r("scatter").alias("scatter"), "n")


@query("""with o as (select i, j from range(-11, 12) a(i), range(-11, 12) b(j) where i * i + j * j > 4),
p as (select vec_id, embedding[greatest(0, least(7, vec_id % 8 + j)) * 8 + greatest(0, least(7, vec_id % 5 + i)) + 1]::double as v from embeddings, o)
select vec_id, round(stddev_pop(v), 6) as bkg_std from p group by 1""")
def annulus_deviation(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", r(detect.annulus_deviation(F.col("embedding"), F.col("vec_id") % 5, F.col("vec_id") % 8, 8, 8)).alias("bkg_std"))


def _clip_sql(passes: int) -> str:
    steps = ["c0 as (select vec_id, v from p)"]
    for k in range(passes):
        steps.append(f"s{k} as (select vec_id, median(v) as m, stddev_pop(v) as s from c{k} group by 1)")
        steps.append(f"c{k + 1} as (select vec_id, v from c{k} join s{k} using (vec_id) where abs(v - m) <= 3 * s)")
    return ", ".join(steps)


@query(f"""with e as (select vec_id, embedding, vec_id % 8 as x, vec_id % 5 + 2 as y from embeddings), p as (select vec_id, unnest(embedding)::double as v from e), {_clip_sql(5)},
n as (select vec_id, stddev_pop(v) as noise from c5 group by 1), o as (select i, j from range(-2, 3) a(i), range(-2, 3) b(j) where i * i + j * j <= 4),
q as (select vec_id, case when x + i between 0 and 7 and y + j between 0 and 7 then embedding[(y + j) * 8 + x + i + 1]::double else 0 end as v from e, o)
select vec_id, round(greatest(0, -min(v)) / any_value(noise), 6) as neg_extent, round(any_value(noise), 6) as noise from q join n using (vec_id) group by 1""")
def negative_extent(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    low = e.select("vec_id", detect.deepest_below(F.col("embedding"), F.col("vec_id") % 8, F.col("vec_id") % 5 + 2, 8, 8).alias("low"))
    return low.join(detect.clipped_noise(e, "vec_id", "embedding"), "vec_id").select("vec_id", r(F.col("low") / F.col("noise")).alias("neg_extent"), r("noise").alias("noise"))
