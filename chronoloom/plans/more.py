"""Further queries: density clusters, tracks, matches, injected light and event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chronoloom.functions import photometry, sky
from chronoloom.operators import clusters, filters, fit, inject, resolve, robust, spatial
from chronoloom.plans.points import POINTS, SKY, detections, positions, stars
from chronoloom.plans.registry import query, r, table
from chronoloom.plans.series import FRAMES, frames, hours

DENSE = POINTS.replace("with pts", "with recursive pts") + """, e as (select a.id as u, b.id as v from pts a, pts b where sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 20),
core as (select u from e group by 1 having count(*) >= 3), ce as (select u, v from e where u <> v and u in (select u from core) and v in (select u from core)),
reach(u, v) as (select u, v from ce union select q.u, ce.v from reach q join ce on ce.u = q.v), lab as (select core.u, least(core.u, coalesce(min(v), core.u)) as c from core left join reach on reach.u = core.u group by core.u),
bd as (select e.u, min(c) as near from e join lab on lab.u = e.v group by 1), named as (select bd.u, coalesce(lab.c, near) as c from bd left join lab on lab.u = bd.u)
"""


@query(DENSE + "select id, c as cluster from pts left join named on u = id")
def density_clusters(spark: SparkSession, d: str) -> DataFrame:
    return clusters.density_clusters(detections(spark, d), 20.0, 3, "id").select("id", "cluster")


@query(DENSE + "select id from pts join named on u = id where c = (select c from named where u = (select min(u) from core))")
def template_cluster(spark: SparkSession, d: str) -> DataFrame:
    got = clusters.density_clusters(detections(spark, d), 20.0, 3, "id")
    first = got.agg(F.min("cluster")).first()[0]
    return clusters.like_template(got, "id", "cluster", first if first is not None else -1).select("id")


@query("""with runs as (select c_custkey as id, r.run, case when c_custkey % (r.run + 3) < 2 then c_custkey % (r.run + 3) end as label from customer, (values (0), (1), (2), (3)) r(run)),
t as (select run, label as t from runs where id = 12 and label is not null)
select id, round(avg(case when label = t then 1.0 else 0.0 end), 6) as stability from runs join t using (run) group by 1""")
def cluster_stability(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    runs = table(spark, d, "customer").withColumn("run", F.explode(F.array(*[F.lit(i) for i in range(4)]))).select(k.alias("id"), "run", F.when(k % (F.col("run") + 3) < 2, k % (F.col("run") + 3)).alias("label"))
    return clusters.stability(runs, "id", "run", "label", 12).withColumn("stability", r("stability"))


@query(POINTS + """, p as (select id, x, y, id % 60 as t from pts), tr as (select id as track, 30.0 as t_ref, x as x0, (id % 7 - 3) / 2.0 as vx, y as y0, (id % 5 - 2) / 2.0 as vy, id % 20 as t_min, id % 20 + 25 as t_max from stars),
j as (select p.id, track, sqrt(pow(p.x - (x0 + vx * (t - t_ref)), 2) + pow(p.y - (y0 + vy * (t - t_ref)), 2)) as distance from p join tr on t between t_min and t_max),
k as (select *, row_number() over (partition by id order by distance, track) as k from j where distance < 60)
select p.id, k.track, round(k.distance, 6) as distance from p left join k on k.id = p.id and k.k = 1""")
def link_to_tracks(spark: SparkSession, d: str) -> DataFrame:
    p = detections(spark, d).select("id", "x", "y", (F.col("id") % 60).alias("t"))
    return clusters.link_to_tracks(p, _tracks(spark, d), 60.0, "id").select("id", "track", r("distance").alias("distance"))


@query(POINTS + """, p as (select id, x, y, id % 60 as t, case when id % 3 = 0 then id % 10 + 1 end as track from pts), tr as (select id as track, 30.0 as t_ref, x as x0, (id % 7 - 3) / 2.0 as vx, y as y0, (id % 5 - 2) / 2.0 as vy from stars)
select p.id, coalesce(p.track, (select min(tr.track) from tr where sqrt(pow(p.x - (x0 + vx * (p.t - t_ref)), 2) + pow(p.y - (y0 + vy * (p.t - t_ref)), 2)) < 60)) as track from p""")
def grow_tracks(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("id")
    p = detections(spark, d).select("id", "x", "y", (k % 60).alias("t"), F.when(k % 3 == 0, k % 10 + 1).alias("track"))
    return clusters.grow_tracks(p, _tracks(spark, d), 60.0, "id").select("id", "track")


def _tracks(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("id")
    return stars(spark, d).select(k.alias("track"), F.lit(30.0).alias("t_ref"), F.col("x").alias("x0"), ((k % 7 - 3) / 2.0).alias("vx"), F.col("y").alias("y0"), ((k % 5 - 2) / 2.0).alias("vy"), (k % 20).alias("t_min"), (k % 20 + 25).alias("t_max"))


@query(POINTS + """, tr as (select id as track, 30.0 as t_ref, x as x0, (id % 7 - 3) / 2.0 as vx, y as y0, (id % 5 - 2) / 2.0 as vy, id % 20 as t_min, id % 20 + 25 as t_max from stars),
p as (select a.track as a_track, b.track as b_track, greatest(a.t_min, b.t_min) as lo, least(a.t_max, b.t_max) as hi, a.vx - b.vx as dvx, a.vy - b.vy as dvy,
 (a.x0 + a.vx * (greatest(a.t_min, b.t_min) - a.t_ref)) - (b.x0 + b.vx * (greatest(a.t_min, b.t_min) - b.t_ref)) as dx, (a.y0 + a.vy * (greatest(a.t_min, b.t_min) - a.t_ref)) - (b.y0 + b.vy * (greatest(a.t_min, b.t_min) - b.t_ref)) as dy from tr a join tr b on a.track < b.track),
w as (select *, case when dvx * dvx + dvy * dvy > 0 then greatest(0, least(hi - lo, -(dx * dvx + dy * dvy) / (dvx * dvx + dvy * dvy))) else 0 end as t from p where lo <= hi),
z as (select a_track, b_track, sqrt(pow(dx + dvx * t, 2) + pow(dy + dvy * t, 2)) as distance from w)
select a_track, b_track, round(distance, 6) as distance from z where distance < 80""")
def track_crossings(spark: SparkSession, d: str) -> DataFrame:
    return clusters.closest_approach(_tracks(spark, d), 80.0).withColumn("distance", r("distance"))


@query("""with o as (select o_custkey as track, o_orderkey % 50 as t, o_totalprice / 1000 as x, o_orderkey % 97 as y from orders)
select track, count(*) as n_points, round(avg(t), 6) as t_ref, round(avg(x), 6) as x0, round(coalesce(regr_slope(x, t), 0), 6) as vx, round(avg(y), 6) as y0, round(coalesce(regr_slope(y, t), 0), 6) as vy, min(t) as t_min, max(t) as t_max from o group by 1 having count(*) >= 5""")
def track_fit(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("track"), (F.col("o_orderkey") % 50).alias("t"), (F.col("o_totalprice") / 1000).alias("x"), (F.col("o_orderkey") % 97).alias("y"))
    out = clusters.fit_tracks(o, "track", 5)
    return out.select("track", "n_points", *[r(c).alias(c) for c in ("t_ref", "x0", "vx", "y0", "vy")], "t_min", "t_max")


@query("""with p as (select l_suppkey as k, l_linenumber as frame, l_orderkey % 9 as x, l_orderkey % 11 as y, l_quantity as f from lineitem),
c as (select k, frame, sum(f * x) / sum(f) as cx, sum(f * y) / sum(f) as cy, sum(f) as f from p group by 1, 2), b as (select c.*, max(f) over (partition by k) as top from c), h as (select * from b where f >= top / 2),
e as (select k, arg_min(cx, frame) as ax, arg_min(cy, frame) as ay, arg_max(cx, frame) as bx, arg_max(cy, frame) as by_ from h group by 1)
select k, round(sqrt(pow(bx - ax, 2) + pow(by_ - ay, 2)), 6) as com_motion from e""")
def centre_motion(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("frame"), (F.col("l_orderkey") % 9).alias("x"), (F.col("l_orderkey") % 11).alias("y"), F.col("l_quantity").alias("f"))
    return clusters.motion(p, ["k"], "frame", "x", "y", "f").withColumn("com_motion", r("com_motion"))


@query("""with s as (select l_orderkey as k, l_linenumber as frame, l_quantity / 8 as sig, row_number() over (partition by l_orderkey order by l_quantity desc, l_linenumber desc) as b from lineitem),
a as (select k, max(frame) - min(frame) + 1 as dur, count(*) filter (where sig >= 5) as n5, count(*) filter (where sig >= 3) as n3, max(frame) filter (where b = 1) as f1, max(frame) filter (where b = 2) as f2 from s group by 1),
e as (select *, case when k % 8 = 0 then 2 else 1 end as bin, case when k % 9 = 0 then -1 else 1 end as sign, 1 + k % 3 as det from a)
select k, n5 as n_five, n3 as n_three, case when bin <> 1 or sign <> 1 then '-' when dur = 1 then case when n5 = 1 then 'CosmicRay' else 'Junk' end
 when det = 2 and n5 = 1 and n3 = 1 then 'CosmicRay' when det = 2 and dur > 2 and abs(f1 - f2) > 1 then case when n5 > 0 then 'CosmicRay' else 'Junk' end else '-' end as classification from e""")
def spike_class(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("frame"), (F.col("l_quantity") / 8).alias("sig"))
    k = F.col("k")
    events = li.groupBy("k").agg((F.max("frame") - F.min("frame") + 1).alias("frame_duration"))
    events = events.select("k", "frame_duration", F.when(k % 8 == 0, 2).otherwise(1).alias("frame_bin"), F.when(k % 9 == 0, -1).otherwise(1).alias("flux_sign"), (1 + k % 3).alias("n_detections"))
    return clusters.spike_class(li, events, ["k"], "frame", "sig")


@query(POINTS + "select p.id, coalesce(string_agg(cast(q.id as varchar), ',' order by q.id), '') as near from pts p left join pts q on p.id <> q.id and sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2)) <= 25 group by 1")
def neighbour_lists(spark: SparkSession, d: str) -> DataFrame:
    return clusters.neighbours(detections(spark, d), 25.0, "id", joined=",").select("id", "near")


@query(POINTS.replace("with pts", "with recursive pts") + """, b as (select id * 2 as n, x, y, 0 as side from pts union all select id * 2 + 1, x, y, 1 from stars), e as (select p.n as u, q.n as v from b p, b q where p.n <> q.n and sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2)) <= 15),
reach(u, v) as (select u, v from e union select w.u, e.v from reach w join e on e.u = w.v), lab as (select b.*, least(n, (select min(v) from reach where u = n)) as c from b where n in (select u from e)),
lead as (select c, min(n) as n from lab where side = 0 group by 1), l2 as (select lead.c, lab.n, lab.x, lab.y from lead join lab using (n)),
k as (select l2.n as an, s.n as bn, sqrt(pow(s.x - l2.x, 2) + pow(s.y - l2.y, 2)) as distance, row_number() over (partition by l2.c order by pow(s.x - l2.x, 2) + pow(s.y - l2.y, 2), s.n) as k from l2 join lab s on s.c = l2.c and s.side = 1)
select cast(an // 2 as bigint) as first_id, cast((bn - 1) // 2 as bigint) as second_id, round(distance, 6) as distance from k where k = 1""")
def cluster_match(spark: SparkSession, d: str) -> DataFrame:
    return clusters.in_cluster_match(detections(spark, d), stars(spark, d), 15.0, "id").withColumn("distance", r("distance"))


@query(POINTS + "select p.id as l_id, s.id as r_id, round(sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)), 6) as distance from pts p, stars s where sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) <= 60 order by sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)), p.id, s.id limit 1")
def closest_pair(spark: SparkSession, d: str) -> DataFrame:
    return spatial.closest(detections(spark, d), stars(spark, d), 60.0, "id").select("l_id", "r_id", r("distance").alias("distance"))


@query(POINTS + "select p.id, coalesce(cast(max(s.id) as varchar), 'none') as label from pts p left join stars s on sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) <= 30 group by 1")
def last_match_wins(spark: SparkSession, d: str) -> DataFrame:
    p = detections(spark, d)
    hit = spatial.best_in_range(p, stars(spark, d), 30.0, "id", [-F.col("r_id")]).select(F.col("l_id").alias("id"), F.col("r_id").cast("string").alias("label"))
    return p.join(hit, "id", "left").select("id", F.coalesce("label", F.lit("none")).alias("label"))


@query(POINTS + "select id from pts where x > 298 and x < 512 and y > 98 and y < 312 and mag >= 2 and mag <= 8")
def box_cut(spark: SparkSession, d: str) -> DataFrame:
    p = [filters.in_range(F.col(c), lo, hi, True, True) for c, lo, hi in (("x", 298, 512), ("y", 98, 312))]
    return detections(spark, d).filter(filters.all_of([*p, filters.in_range(F.col("mag"), 2, 8)])).select("id")


@query(POINTS + "select id, true as star from stars where gmag < 4 union all select id, false from stars where mag between 4 and 9 and (gmag >= 4 or gmag is null)")
def disjoint_union(spark: SparkSession, d: str) -> DataFrame:
    s = stars(spark, d)
    a = s.filter("gmag < 4").select("id", F.lit(True).alias("star"))
    return a.unionByName(s.filter("mag between 4 and 9 and (gmag >= 4 or gmag is null)").select("id", F.lit(False).alias("star")))


@query(FRAMES + "select user_id, eventid from bursts where frame_start > 5000 and frame_start < 30000 and frame_end - frame_start < 1500")
def event_window(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.plans.series import bursts

    b = bursts(spark, d)
    return b.filter(filters.all_of([filters.in_range(F.col("frame_start"), 5000, 30000, True, True), F.col("frame_end") - F.col("frame_start") < 1500])).select("user_id", "eventid")


@query("""with i as (select o_orderkey as injid, case o_orderkey % 3 when 0 then 'flare' when 1 then 'negative' else 'sinusoid' end as kind, o_orderkey % 20 as s, o_totalprice / 1000 as h, o_orderkey % 6 + 2.0 as c from orders),
x as (select injid, f as frame, case kind when 'sinusoid' then h * sin(2 * pi() * (f - s) / c) else case when f >= s then h * exp(-(f - s) / c) else 0 end * case when kind = 'negative' then -1 else 1 end end as flux from i, range(30) t(f))
select injid, round(sum(flux), 5) as total, round(max(flux), 5) as peak, round(min(flux), 5) as trough, count(*) as n from x group by 1""")
def injected_curves(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    kind = F.element_at(F.array(F.lit("flare"), F.lit("negative"), F.lit("sinusoid")), (k % 3 + 1).cast("int"))
    i = table(spark, d, "orders").select(k.alias("injid"), kind.alias("event_type"), (k % 20).alias("start"), (F.col("o_totalprice") / 1000).alias("height"), (k % 6 + 2.0).alias("scale"))
    x = inject.light_curves(i, 30)
    return x.groupBy("injid").agg(r(F.sum("flux"), 5).alias("total"), r(F.max("flux"), 5).alias("peak"), r(F.min("flux"), 5).alias("trough"), F.count("*").alias("n"))


@query(FRAMES + """select user_id, count(*) as n, count(distinct event_type) as kinds, cast(sum(case when value > 10 then 1 else 0 end) as bigint) as high from ev group by 1 having count(*) >= 5""")
def having_counts(spark: SparkSession, d: str) -> DataFrame:
    e = frames(spark, d)
    return e.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("event_type").alias("kinds"), F.sum(F.when(F.col("value") > 10, 1).otherwise(0)).alias("high")).filter("n >= 5")


@query("""with k as (select *, row_number() over (partition by event_type, user_id, date_trunc('hour', ts) order by event_id) as k from events) select event_id, event_type, user_id from k where k = 1""")
def dedup_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type", "user_id", F.date_trunc("hour", "ts").alias("h"))
    return resolve.first_per_key(e, ["event_type", "user_id", "h"], ["event_id"]).select("event_id", "event_type", "user_id")


@query("""with v as (select user_id, event_id, value, avg(value) over w as m, stddev_pop(value) over w as s, min(value) over w as lo, max(value) over w as hi, count(value) over w as n from events window w as (partition by user_id)),
k as (select *, row_number() over (partition by user_id order by value) as k from v where lo < hi and value is not null),
q as (select user_id, max(value) filter (where k = (n - 1) * 25 // 1000 + 1) as c0, max(value) filter (where k = ((n - 1) * 975 + 999) // 1000 + 1) as c1 from k group by 1)
select event_id, round((value - m) / s, 6) as z from k join q using (user_id) where value > c0 and value < c1""")
def trimmed_scores(spark: SparkSession, d: str) -> DataFrame:
    """Standard scores strictly inside the central 95 per cent of their series.

    A value is above a quantile if it is above the lower of the two ranks that it lies
    between, and below one if below the upper: compared by the values themselves,
    as scores and interpolated cuts are only equal up to rounding. Series of one value have no scores.
    """
    e = table(spark, d, "events").select("event_id", "user_id", "value").filter("value is not null")
    stat = e.groupBy("user_id").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    ranked = e.join(stat, "user_id").withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy("value")))
    at = {"c0": F.expr("div((n - 1) * 25, 1000)"), "c1": F.expr("div((n - 1) * 975 + 999, 1000)")}
    cut = ranked.groupBy("user_id").agg(*[F.max(F.when(F.col("k") == rank + 1, F.col("value"))).alias(c) for c, rank in at.items()])
    return ranked.join(cut, "user_id").filter("value > c0 and value < c1").select("event_id", r((F.col("value") - F.col("m")) / F.col("s")).alias("z"))


@query("""with v as (select l_suppkey as k, l_extendedprice as x, 1 + l_quantity as e from lineitem), m as (select k, median(x) as m from v group by 1), d as (select k, (x - m) / e as d from v join m using (k))
select k, count(*) as n, round(sum(abs(d)) / sqrt(sum(d * d)) / sqrt(count(*)), 6) as stetson_k from d group by 1""")
def stetson_k(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_extendedprice").alias("x"), (1 + F.col("l_quantity")).alias("e"))
    return robust.stetson_k(li, ["k"], "x", "e").withColumn("stetson_k", r("stetson_k"))


@query("""select o_custkey % 64 as cut, round(median(o_totalprice / 1000 - 150), 6) as off_x, round(median(o_orderkey % 301 - 150.0), 6) as off_y, count(*) as n from orders
where abs(o_totalprice / 1000 - 150) < 100 and abs(o_orderkey % 301 - 150.0) < 100 group by 1""")
def median_offsets(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select((F.col("o_custkey") % 64).alias("cut"), (F.col("o_totalprice") / 1000 - 150).alias("dx"), (F.col("o_orderkey") % 301 - 150.0).alias("dy"))
    return robust.median_offset(o, ["cut"], "dx", "dy", 100.0).withColumn("off_x", r("off_x")).withColumn("off_y", r("off_y"))


@query(POINTS + "select id, round(x / 100, 5) as x, round(y / 100, 5) as y from pts")
def newton_inversion(spark: SparkSession, d: str) -> DataFrame:
    """Points distorted by a polynomial and brought back."""
    cx, cy = {(1, 0): 1.0, (2, 0): 1e-3, (1, 1): 2e-3}, {(0, 1): 1.0, (0, 2): -1e-3, (2, 0): 5e-4}
    p = detections(spark, d).select("id", (F.col("x") / 100).alias("a"), (F.col("y") / 100).alias("b"))
    bent = p.select("id", sky.polynomial(F.col("a"), F.col("b"), cx).alias("u"), sky.polynomial(F.col("a"), F.col("b"), cy).alias("v"))
    return fit.invert_surface(bent, "u", "v", cx, cy).select("id", r("x", 5).alias("x"), r("y", 5).alias("y"))


@query(SKY + "select id, i, round(ra + 0.5 * cos(2 * pi() * i / 12) / cos(radians(dec)), 6) as vra, round(dec + 0.5 * sin(2 * pi() * i / 12), 6) as vdec from s, range(12) t(i) where abs(dec) < 80")
def error_circles(spark: SparkSession, d: str) -> DataFrame:
    p = positions(spark, d).filter("abs(dec) < 80").select("id", F.posexplode(sky.circle(F.col("ra"), F.col("dec"), 0.5, 12)).alias("i", "v"))
    return p.select("id", F.col("i").cast("long").alias("i"), r("v.ra").alias("vra"), r("v.dec").alias("vdec"))


@query(POINTS + """, c as (select i as cut, i % 8 * 125.0 as x0, i // 8 * 125.0 as y0 from range(64) t(i)), v as (select s.id, s.x + 70 * cos(2 * pi() * k / 36) as vx, s.y + 70 * sin(2 * pi() * k / 36) as vy, s.x, s.y from stars s, range(36) t(k))
select distinct v.id, c.cut from v, c where (vx >= x0 and vx < x0 + 125 and vy >= y0 and vy < y0 + 125) or (sqrt(pow(x0 + 62.5 - v.x, 2) + pow(y0 + 62.5 - v.y, 2)) <= 70)""")
def impacted_cuts(spark: SparkSession, d: str) -> DataFrame:
    """Cuts that an error region touches: those its edge passes, and those whose centre it holds."""
    s = stars(spark, d).select("id", "x", "y")
    a = 2 * F.pi() * F.col("k") / 36
    edge = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(35)))).select("id", (F.col("x") + 70 * F.cos(a)).alias("vx"), (F.col("y") + 70 * F.sin(a)).alias("vy"))
    cx, cy = F.floor(F.col("vx") / 125), F.floor(F.col("vy") / 125)
    passed = edge.filter(cx.between(0, 7) & cy.between(0, 7)).select("id", (cy * 8 + cx).cast("long").alias("cut"))
    grid = spark.range(64).select(F.col("id").alias("cut"), (F.col("id") % 8 * 125 + 62.5).alias("x"), (F.floor(F.col("id") / 8) * 125 + 62.5).alias("y"))
    held = spatial.within(s, grid.withColumnRenamed("cut", "id"), 70.0).select(F.col("l_id").alias("id"), F.col("r_id").alias("cut"))
    return passed.union(held).distinct()


@query("""with p as (select vec_id, unnest(embedding)::double as x from embeddings), m as (select vec_id, median(x) as m from p group by 1), n as (select vec_id, median(abs(x - m)) * 1.4826 as s from p join m using (vec_id) group by 1)
select vec_id % 8 as bin_index, round(median(s), 6) as sigma_bg, round(20 - 2.5 * log10(3 * median(s) * 1.5), 6) as mag_lim_3, round(20 - 2.5 * log10(5 * median(s) * 1.5), 6) as mag_lim_5, round(20 - 2.5 * log10(10 * median(s) * 1.5), 6) as mag_lim_10 from n group by 1""")
def detection_limits(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.operators.detect import frame_noise

    noise = frame_noise(table(spark, d, "embeddings").select(F.col("vec_id").alias("frame"), F.col("embedding").alias("img")))
    s = noise.groupBy((F.col("frame") % 8).alias("bin_index")).agg(F.median("noise").alias("s"))
    limits = [r(photometry.detection_limit(F.lit(20.0), F.col("s"), float(n), F.lit(1.5))).alias(f"mag_lim_{n}") for n in (3, 5, 10)]
    return s.select("bin_index", r("s").alias("sigma_bg"), *limits)
