"""Queries from detections and light curves to events: eight users of the stream are an object, an hour a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.operators import assembly, series
from chronoloom.plans.registry import query, r
from chronoloom.plans.series import FRAMES, frames

#: Frames between sessions, frames left out around an event, and frames of baseline beyond; for events found again.
GAP, BUFFER, WINDOW, AGAIN = 4, 6, 120, 48

TABLES = FRAMES + """, raw as (select user_id // 8 as objid, frame // 60 as frame, event_id, value, case when event_id % 10 < 7 then 1 else -1 end as flux_sign, weight as snr,
  event_id * 7919 % 10007 / 10.0 as x, event_id * 104729 % 10009 / 10.0 as y from ev),
lc as (select objid, frame, frame * 1.0 as time, round(sum(value), 4) as flux from raw group by all),
det as (select *, frame * 1.0 as time from raw where value >= 110 or (flux_sign < 0 and value < 2))"""


def _tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    raw = frames(spark, d).select(
        F.expr("div(user_id, 8)").alias("objid"), F.expr("div(frame, 60)").alias("frame"), "event_id", "value", F.when(F.col("event_id") % 10 < 7, 1).otherwise(-1).alias("flux_sign"), F.col("weight").alias("snr"),
        (F.col("event_id") * 7919 % 10007 / 10.0).alias("x"), (F.col("event_id") * 104729 % 10009 / 10.0).alias("y"))
    lc = raw.groupBy("objid", "frame").agg(F.round(F.sum("value"), 4).alias("flux")).withColumn("time", F.col("frame").cast("double"))
    return raw.filter("value >= 110 or (flux_sign < 0 and value < 2)").withColumn("time", F.col("frame").cast("double")), lc


def _measure(events: str, out: str, window: int, masked: bool, sign: str = "e.flux_sign") -> str:
    """CTEs that end in ``out``: the events with baseline and significance, and in ``{out}_rows`` all their samples."""
    far = BUFFER + window
    cover = f"{out}_cover as (select l.objid, l.frame, max(eventid) as cover from lc l join {events} e on l.objid = e.objid and l.frame between fs and fe group by all)," if masked else ""
    free = "coalesce(cover = eventid, true)" if masked else "true"
    return f""", {cover}
{out}_all as (select e.objid, e.eventid, {sign} as sg, e.fs, e.fe, e.ts, e.te, l.frame, l.time, l.flux from {events} e join lc l on e.objid = l.objid),
{out}_near as (select objid, eventid, arg_min(frame, (abs(time - (ts - {far})), frame)) as w0, arg_min(frame, (abs(time - (ts - {BUFFER})), frame)) as b0,
  arg_min(frame, (abs(time - (te + {BUFFER})), frame)) as b1, arg_min(frame, (abs(time - (te + {far})), frame)) as w1 from {out}_all group by all),
{out}_rows as (select a.*, ((a.frame > w0 and a.frame < b0) or (a.frame < w1 and a.frame > b1)) and {free} as base, a.frame between fs and fe as inside
  from {out}_all a join {out}_near using (objid, eventid) {f"left join {out}_cover using (objid, frame)" if masked else ""}),
{out}_stat as (select objid, eventid, any_value(sg) as sg, count(flux) filter (where base) as n, median(flux) filter (where base) as med, stddev_pop(flux) filter (where base) as sd, regr_slope(flux, time) filter (where base) as slope,
  avg(flux) filter (where inside) as mean, max(flux) filter (where inside) as hi, min(flux) filter (where inside) as lo, arg_min(frame, (-flux, frame)) filter (where inside) as fhi, arg_min(frame, (flux, frame)) filter (where inside) as flo
  from {out}_rows group by 1, 2),
{out} as (select objid, eventid, case when n >= 2 then med end as med, case when n >= 2 and sd > 0 then sd end as sd, case when sg >= 0 then hi else lo end as flux_max, case when sg >= 0 then fhi else flo end as frame_max,
  case when n >= 2 and sd > 0 then case when sg >= 0 then (hi - med) / sd else abs((lo - med) / sd) end end as lc_sig_max, case when n >= 2 and sd > 0 then case when sg >= 0 then (mean - med) / sd else abs((mean - med) / sd) end end as lc_sig_med,
  coalesce(cast(n >= 2 and sd > 0 and abs(slope) / sd < 2 and abs(med) < sd and sd < 5 as int), 0) as lc_flat from {out}_stat)"""


def _extend(measured: str, triggers: str, out: str) -> str:
    """CTEs that end in ``out``: the events' bounds after the walk outwards."""
    return f""", {out}_hits as (select a.objid, a.eventid, a.frame, a.time, a.fs, a.fe from {measured}_rows a join {measured} m using (objid, eventid) where (a.flux - m.med) / m.sd * a.sg >= 3),
{out}_walk as (select *, count(*) filter (where frame > fe) over (partition by objid, eventid order by frame) as r, count(*) filter (where frame < fs) over (partition by objid, eventid order by frame desc) as l from {out}_hits),
{out}_kept as (select objid, eventid, frame, time from {out}_walk where frame between fs and fe or (frame > fe and frame - fe - r < 5) or (frame < fs and fs - frame - l < 5) union select objid, eventid, frame, time from {triggers}),
{out} as (select objid, eventid, min(frame) as fs, max(frame) as fe, min(time) as ts, max(time) as te, count(*) as n_detections from {out}_kept group by 1, 2)"""


CHAIN = TABLES + """, marks as (select *, case when frame - lag(frame) over (partition by objid, flux_sign order by frame) > 4 then 1 else 0 end as fresh from det),
own as (select *, 1 + sum(fresh) over (partition by objid, flux_sign order by frame range unbounded preceding) as own from marks),
signs as (select objid, flux_sign, max(own) as n, min(frame) as first from own group by 1, 2),
offs as (select *, coalesce(sum(n) over (partition by objid order by first, flux_sign desc rows between unbounded preceding and 1 preceding), 0) as before from signs),
found as (select o.*, cast(own + before as bigint) as eventid from own o join offs using (objid, flux_sign)),
e1 as (select objid, eventid, min(flux_sign) as flux_sign, min(frame) as fs, max(frame) as fe, min(time) as ts, max(time) as te, max(snr) as image_sig_max, sum(x * snr) / sum(snr) as x, sum(y * snr) / sum(snr) as y, count(*) as nd from found group by 1, 2),
ex as (select objid, eventid, case when count(*) > 1 then sum(snr * (f.x - e.x) ** 2) / sum(snr) end as e_x, case when count(*) > 1 then sum(snr * (f.y - e.y) ** 2) / sum(snr) end as e_y from found f join e1 e using (objid, eventid) group by 1, 2)""" + _measure("e1", "m1", WINDOW, False) + _extend("m1", "found", "b") + """,
e2 as (select b.*, e1.flux_sign, e1.image_sig_max, fe_ - fs_ + 1 as frame_duration, e1.x, e1.y from (select *, fs as fs_, fe as fe_ from b) b join e1 using (objid, eventid))""".replace("e1.flux_sign, e1.image_sig_max", "e1.flux_sign, e1.image_sig_max") + _measure("e2", "m2", WINDOW, True) + """,
sig as (select a.objid, a.eventid, a.frame, (a.flux - m.med) / m.sd * a.sg as s from m2_rows a join m2 m using (objid, eventid) where a.inside),
top as (select objid, eventid, count(*) filter (where s >= 5) as five, count(*) filter (where s >= 3) as three, list(frame order by s desc nulls last, frame desc) as fr from sig group by 1, 2),
done as (select e.objid, e.eventid, e.flux_sign, e.fs as frame_start, e.fe as frame_end, e.ts as time_start, e.te as time_end, e.frame_duration, e.n_detections, e.image_sig_max, e.x, e.y, ex.e_x, ex.e_y, m.frame_max, m.flux_max, m.lc_sig_max, m.lc_sig_med, m.lc_flat,
  case when e.flux_sign <> 1 then '-' when e.frame_duration = 1 then case when coalesce(five, 0) = 1 then 'CosmicRay' else 'Junk' end
    when e.n_detections = 2 then case when coalesce(five, 0) = 1 and coalesce(three, 0) = 1 then 'CosmicRay' when e.frame_duration > 2 and abs(fr[1] - fr[2]) > 1 then case when five > 0 then 'CosmicRay' else 'Junk' end else '-' end
    else '-' end as classification, count(*) over (partition by e.objid) as total_events
  from e2 e left join m2 m using (objid, eventid) left join top using (objid, eventid) join ex using (objid, eventid))"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r(c) for c in ("x", "y", "e_x", "e_y", "lc_sig_max", "lc_sig_med")}).drop("frame_bin")


ROUNDED = "* replace (round(x, 6) as x, round(y, 6) as y, round(e_x, 6) as e_x, round(e_y, 6) as e_y, round(lc_sig_max, 6) as lc_sig_max, round(lc_sig_med, 6) as lc_sig_med)"


def _events(spark: SparkSession, d: str) -> DataFrame:
    det, lc = _tables(spark, d)
    return assembly.assemble_events(det, lc, ["objid"], GAP, BUFFER, WINDOW)


@query(CHAIN + f" select {ROUNDED} from done")
def event_assembly(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain from detections to classified events."""
    return _rounded(_events(spark, d))


@query(CHAIN + """, e3 as (select objid, eventid, frame_start as fs, frame_end as fe, time_start as ts, time_end as te, 1 as flux_sign from done)""" + _measure("e3", "m3", AGAIN, True)
       + ", ends as (select objid, eventid, fs as frame, ts as time from e3 union all select objid, eventid, fe, te from e3)" + _extend("m3", "ends", "g")
       + f""", again as (select d.* replace (case when moves then g.fs else frame_start end as frame_start, case when moves then g.fe else frame_end end as frame_end, case when moves then g.ts else time_start end as time_start,
  case when moves then g.te else time_end end as time_end, case when moves then g.fe - g.fs else frame_duration end as frame_duration, case when moves then d.n_detections + (frame_start - g.fs) + (g.fe - frame_end) else d.n_detections end as n_detections,
  case when moves then 'Asteroid' else classification end as classification) from (select *, classification = '-' and eventid % 2 = 0 as moves from done) d join g using (objid, eventid))
select {ROUNDED.replace("* replace", "* exclude (moves) replace")} from again""")
def moving_recheck(spark: SparkSession, d: str) -> DataFrame:
    """Every second event that is neither hit nor junk taken as a moving one, its bounds found again."""
    _, lc = _tables(spark, d)
    events = _events(spark, d).withColumn("classification", F.when((F.col("classification") == "-") & (F.col("eventid") % 2 == 0), "Asteroid").otherwise(F.col("classification")))
    return _rounded(assembly.recheck_moving(lc, events, ["objid"], BUFFER, AGAIN))


@query(FRAMES + """, hr as (select user_id, frame // 60 as hour, sum(value) as flux from ev group by all),
top as (select user_id, arg_min(hour, (flux, hour)) as low, arg_max(hour, (flux, -hour)) as high, user_id % 2 * 2 - 1 as sign from hr group by 1),
obs as (select hr.*, sign, case when sign > 0 then high else low end - 2 as s, case when sign > 0 then high else low end + 2 as e from hr join top using (user_id)),
b as (select *, hour > s - 120 and hour < e + 120 and (hour < s - 4 or hour > e + 4) as base, hour between s and e as inside from obs),
a as (select user_id, any_value(sign) as sign, count(flux) filter (where base) as n_base, median(flux) filter (where base) as med, stddev_pop(flux) filter (where base) as sd, regr_slope(flux, hour) filter (where base) as slope,
  case when any_value(sign) > 0 then max(flux) filter (where inside) else min(flux) filter (where inside) end as peak, avg(flux) filter (where inside) as mean,
  case when any_value(sign) > 0 then arg_max(hour, (flux, -hour)) filter (where inside) else arg_min(hour, (flux, hour)) filter (where inside) end as peak_time from b group by 1)
select user_id, n_base, round(peak, 6) as peak, peak_time, case when n_base >= 2 and sd > 0 then round(case when sign > 0 then (peak - med) / sd else abs((peak - med) / sd) end, 6) end as sig_max,
  case when n_base >= 2 and sd > 0 then round(case when sign > 0 then (mean - med) / sd else abs((mean - med) / sd) end, 6) end as sig_mean,
  coalesce(cast(n_base >= 2 and sd > 0 and abs(slope) / sd < 2 and abs(med) < sd and sd < 5 as int), 0) as lc_flat from a""")
def signed_significance(spark: SparkSession, d: str) -> DataFrame:
    """Users' dips (even ids) and peaks (odd ids) against their surroundings."""
    hr = frames(spark, d).groupBy("user_id", F.expr("div(frame, 60)").alias("hour")).agg(F.sum("value").alias("flux"))
    top = hr.groupBy("user_id").agg(F.max_by("hour", F.struct("flux", -F.col("hour"))).alias("high"), F.min_by("hour", F.struct("flux", "hour")).alias("low")).withColumn("sign", F.col("user_id") % 2 * 2 - 1)
    at = F.when(F.col("sign") > 0, F.col("high")).otherwise(F.col("low"))
    rows = hr.join(top, "user_id").withColumns({"s": at - 2, "e": at + 2})
    out = series.significance(rows, ["user_id"], "hour", "flux", "s", "e", 4, 120, sign="sign")
    return out.withColumns({c: r(c) for c in ("peak", "sig_max", "sig_mean")})
