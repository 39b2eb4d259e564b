"""Queries of plate solutions: customers are stars on four detectors, suppliers cuts; places by integer arithmetic on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.functions import sky
from chronoloom.operators import astrometry, curves, robust, spatial
from chronoloom.plans.points import SEPARATION, SKY, positions
from chronoloom.plans.registry import query, r, table


def _loop_sql(passes: int = 10, sigma: int = 3) -> str:
    """The clipping loop pass by pass; a group that is done keeps its line."""
    c4 = "case n when 2 then 0.7978845608 when 3 then 0.8862269255 when 4 then 0.9213177319 when 5 then 0.9399856030 else 1.0 - 1.0 / (4 * (n - 1.0)) + 1.0 / (32 * (n - 1.0) * (n - 1.0)) + 5.0 / (128 * (n - 1.0) * (n - 1.0) * (n - 1.0)) end"
    sql = f"""with r as (select o_custkey % 400 as k, pow(o_totalprice / 100000, 3)::double as v from orders), a as (select k, median(v) as c, count(*) as total from r group by 1),
d as (select k, v, c, total, abs(v - c) as d from r join a using (k)), l as (select k, quantile_cont(d, 0.8) as l from d group by 1),
u as (select k, any_value(c) as c, any_value(total) as total, any_value(l) as l, count(*) filter (d < l) as under, list_sort(list(d))[3] as third from d join l using (k) group by 1),
s as (select k, c, total, total > 3 and under >= 3 as strict, case when total <= 3 then 'inf'::double when under < 3 then third else l end as reach from u),
g as (select k, v from d join s using (k, c, total) where d < reach or (d = reach and not strict)),
f as (select k, median(v) as m, count(*) as n from g group by 1), ss as (select k, sum(pow(v - m, 2)) as ss from g join f using (k) group by 1),
p0 as (select k, m, case when n > 1 then sqrt(ss / (n - 1)) / ({c4}) end as s, n, total, coalesce(case when n > 1 then sqrt(ss / (n - 1)) > 0 end, false) is false as done from f join ss using (k) join s using (k))"""
    for i in range(1, passes):
        sql += f""",
q{i} as (select k, avg(v) as m2, stddev_samp(v) as s2, count(*) as n2 from r join p{i - 1} using (k) where not done and abs(v - m) <= {sigma} * s group by 1),
p{i} as (select k, case when n2 >= 2 then m2 else m end as m, case when n2 >= 2 then s2 else s end as s, case when n2 >= 2 then n2 else n end as n, total, done or coalesce(n2, 0) < 2 or coalesce(n2 = n or s2 = 0, false) as done from p{i - 1} left join q{i} using (k))"""
    return sql + f"\nselect k, round(m, 6) as mean, round(s, 6) as stdev, n as n_kept, total - n as n_cut from p{passes - 1}"


@query(_loop_sql())
def sigma_cut_loop(spark: SparkSession, d: str) -> DataFrame:
    """Means of skewed values after cuts that go on until they settle."""
    o = table(spark, d, "orders").select((F.col("o_custkey") % 400).alias("k"), F.pow(F.col("o_totalprice") / 100000, 3).alias("v"))
    return robust.sigma_cut_loop(o, ["k"], "v").select("k", r("mean").alias("mean"), r("stdev").alias("stdev"), "n_kept", "n_cut")


def _errors_sql(passes: int = 10, sigma: int = 3) -> str:
    sql = """with r as (select o_custkey % 400 as k, o_totalprice / 1000 as v, 5.0 + o_orderkey % 37 * 4 as e from orders),
p0 as (select k, median(v) as m, null::double as b, count(*) as n, null::double as me, null::double as s, null::double as x, count(*) as total, false as done from r group by 1)"""
    for i in range(1, passes):
        sql += f""",
q{i} as (select k, abs(v - m) <= {sigma} * e as good, coalesce(abs(v - b) <= {sigma} * e, true) as was, v, e from r join p{i - 1} using (k) where not done),
g{i} as (select k, sum(v / e ** 2) filter (good) / sum(1 / e ** 2) filter (good) as m2, sqrt(1 / sum(1 / e ** 2) filter (good)) as me2, case when count(*) filter (good) > 1 then stddev_samp(v) filter (good) end as s2, count(*) filter (good) as n2, count(*) filter (good <> was) as changed from q{i} group by 1),
x{i} as (select k, sum(((v - m2) / e) ** 2) filter (good) / (case when any_value(n2) > 1 then any_value(n2) - 1 end) as x2 from q{i} join g{i} using (k) group by 1),
p{i} as (select k, case when done then m else m2 end as m, case when done then b else m end as b, case when done then n else n2 end as n, case when done then me else me2 end as me, case when done then s else s2 end as s, case when done then x else x2 end as x, total, done or n2 = 0 or changed = 0 as done from p{i - 1} left join g{i} using (k) left join x{i} using (k))"""
    return sql + f"\nselect k, round(m, 6) as mean, round(me, 6) as mean_err, round(s, 6) as stdev, round(x, 6) as chi2_norm, n as n_kept, total - n as n_cut from p{passes - 1}"


@query(_errors_sql())
def error_cut_loop(spark: SparkSession, d: str) -> DataFrame:
    """Weighted means after cuts by each value's own error."""
    o = table(spark, d, "orders").select((F.col("o_custkey") % 400).alias("k"), (F.col("o_totalprice") / 1000).alias("v"), (5.0 + F.col("o_orderkey") % 37 * 4).alias("e"))
    out = robust.error_cut_loop(o, ["k"], "v", "e")
    return out.withColumns({c: r(c) for c in ("mean", "mean_err", "stdev", "chi2_norm")})


#: The percentiles from 5 to 100 as SQL.
SHARES = ", ".join(str(p / 100) for p in range(5, 101))


@query(f"""with p as (select l_suppkey % 2 as camera, l_partkey % 200 as frame, l_orderkey * 31 % 200 as x, l_orderkey * 17 % 180 as y, l_extendedprice as v from lineitem),
b as (select camera, frame, (y // 90 * 2 + (x - 10) // 90)::int as block, median(v) as m from p where x >= 10 and x < 190 and y < 180 group by all),
u as (select camera, block, quantile_cont(m, [{SHARES}]) as q from b group by 1, 2),
f as (select camera, frame, max(len(list_filter(q, lambda z: z < m - abs(m) * 1e-12)) + 5)::int as percentile, sum(m) as score, count(*) as n, bool_and(frame % 9 <> 4) as good from b join u using (camera, block) group by 1, 2),
g as (select *, coalesce(count(*) filter (good) over (partition by camera order by frame rows between unbounded preceding and 1 preceding), 0) as index_good from f),
c as (select camera, count(distinct block) as blocks from b group by 1), k as (select *, row_number() over (partition by camera order by percentile, score, frame) as rank from g join c using (camera) where good and n = blocks)
select camera, frame, round(score, 4) as score, percentile, index_good from k where rank = 1""")
def reference_frames(spark: SparkSession, d: str) -> DataFrame:
    """Each camera's darkest good frame by the medians of four blocks."""
    k = F.col("l_orderkey")
    px = table(spark, d, "lineitem").select((F.col("l_suppkey") % 2).alias("camera"), (F.col("l_partkey") % 200).alias("frame"), (k * 31 % 200).alias("x"), (k * 17 % 180).alias("y"), "l_extendedprice")
    medians = robust.block_medians(px, ["camera"], "frame", "l_extendedprice", 2, margin=10, size=180).withColumn("good", F.col("frame") % 9 != 4)
    return robust.reference_frames(medians, ["camera"], "frame", good="good").withColumn("score", r("score", 4))


@query(SKY + f"select a.id, round(3600 * min({SEPARATION.format(d0='b.dec', r0='b.ra').replace('(dec', '(a.dec').replace('(ra ', '(a.ra ')}), 4) as min_dist_arcsec from s a join s b on a.id <> b.id group by 1")
def sky_self_nearest(spark: SparkSession, d: str) -> DataFrame:
    """How far each star's nearest other one is, on the sphere."""
    return spatial.sky_self_nearest(positions(spark, d), 1.0, "id").select("id", r("min_dist_arcsec", 4).alias("min_dist_arcsec"))


@query("""with p as (select vec_id, embedding[1:49] as e from embeddings where vec_id % 2 = 0), k as (select vec_id, unnest(range(49)) as k, greatest(unnest(e), 0)::double as v from p),
i as (select c_custkey as id, c_custkey % 4 as detector, (c_custkey * 7919 % 20480) / 100.0 as xc, (c_custkey * 104729 % 20390) / 100.0 as yc from customer),
o as (select *, xc - floor(xc + 0.5) as sx, yc - floor(yc + 0.5) as sy, ((detector * 3 + floor(xc / 100)) * 3 + floor(yc / 100))::bigint * 2 as prf from i),
w as (select id, v, k % 7 + floor(sx) as gx, k // 7 + floor(sy) as gy, sx - floor(sx) as fx, sy - floor(sy) as fy from o join k on vec_id = prf),
m as (select id, v * ((1 - fx) * (abs(gx - 3) <= 1)::int + fx * (abs(gx - 2) <= 1)::int) * ((1 - fy) * (abs(gy - 3) <= 1)::int + fy * (abs(gy - 2) <= 1)::int) as held, v * ((1 - fx) * (abs(gx - 3) <= 3)::int + fx * (abs(gx - 2) <= 3)::int) * ((1 - fy) * (abs(gy - 3) <= 3)::int + fy * (abs(gy - 2) <= 3)::int) as whole from w),
a as (select id, sum(held) / case when sum(whole) > 0 then sum(whole) end as share from m group by 1)
select o.id, round(share, 6) as aperture, round(20.03 + detector / 10.0 + 2.5 * log10(coalesce(share, 1)), 6) as zp from o left join a using (id)""")
def aperture_shares(spark: SparkSession, d: str) -> DataFrame:
    """Share of each star's light in a box of 3 x 3 pixels by the image of its part of the detector, and the zeropoint with it."""
    e = table(spark, d, "embeddings").filter("vec_id % 2 = 0")
    n = F.expr("div(vec_id, 2)")
    prfs = e.filter(n < 36).select(F.expr("div(div(vec_id, 2), 9)").cast("long").alias("detector"), (F.expr("div(div(vec_id, 2), 3)") % 3).cast("long").alias("bx"), (n % 3).cast("long").alias("by"), F.transform(F.slice("embedding", 1, 49), lambda v: F.greatest(v, F.lit(0)).cast("double")).alias("prf"))
    k = F.col("c_custkey")
    objects = table(spark, d, "customer").select(k.alias("id"), (k % 4).cast("long").alias("detector"), (k * 7919 % 20480 / 100.0).alias("xcentroid"), (k * 104729 % 20390 / 100.0).alias("ycentroid"))
    out = curves.aperture_shares(objects, prfs, ["detector"], 7)
    return out.select("id", r("aperture").alias("aperture"), r(20.03 + F.col("detector") / 10 + 2.5 * F.log10(F.coalesce("aperture", F.lit(1.0)))).alias("zp"))


def plate(spark: SparkSession, d: str) -> DataFrame:
    """Stars at (x, y) about the reference pixel, and where they would fall without distortion; some are wrong by pixels."""
    k = F.col("c_custkey")
    p = table(spark, d, "customer").select(k.alias("id"), (k % 4).alias("detector"), (k * 7919 % 2048 - 1024.0).alias("x"), (k * 104729 % 2039 - 1019.0).alias("y"), (k * 31 % 100 / 1000.0 - 0.05).alias("e"), F.when(k % 53 == 0, k % 7 + 2.0).otherwise(0.0).alias("wrong"))
    x, y = F.col("x"), F.col("y")
    u = x + 0.3 + 0.0004 * y + 2e-6 * (F.col("detector") + 1) * x * x - 1e-9 * x * y * y + F.col("e") + F.col("wrong")
    v = y - 0.2 - 0.0003 * x + 1.5e-6 * x * y + 2e-9 * y * y * y - F.col("e")
    return p.select("id", "detector", "x", "y", u.alias("u"), v.alias("v"))


@query("""with p as (select c_custkey % 4 as detector, c_custkey * 7919 % 2048 - 1024.0::double as x, c_custkey * 104729 % 2039 - 1019.0::double as y, c_custkey * 31 % 100 / 1000.0 - 0.05::double as e, case when c_custkey % 53 = 0 then c_custkey % 7 + 2.0 else 0.0 end::double as wrong from customer),
w as (select *, x + 0.3 + 0.0004 * y + 2e-6 * (detector + 1) * x * x - 1e-9 * x * y * y + e + wrong as u, y - 0.2 - 0.0003 * x + 1.5e-6 * x * y + 2e-9 * y * y * y - e as v from p),
s as (select detector, count(*) as n, sum(x * x) as xx, sum(x * y) as xy, sum(y * y) as yy, sum(u * x) as ux, sum(u * y) as uy, sum(v * x) as vx, sum(v * y) as vy from w group by 1)
select detector, n, round((ux * yy - uy * xy) / (xx * yy - xy * xy), 8) as u_x, round((uy * xx - ux * xy) / (xx * yy - xy * xy), 8) as u_y, round((vx * yy - vy * xy) / (xx * yy - xy * xy), 8) as v_x, round((vy * xx - vx * xy) / (xx * yy - xy * xy), 8) as v_y from s""")
def plate_linear(spark: SparkSession, d: str) -> DataFrame:
    """Turn and scale of each detector, the constant held at 0."""
    fits = astrometry.fit_surfaces(plate(spark, d), ["detector"], "x", "y", {"u": "constant", "v": "constant"}, 1)
    return fits.select("detector", "n", *[r(F.get(c, F.lit(k)), 8).alias(f"{c}_{n}") for c in "uv" for k, n in ((1, "x"), (2, "y"))])


@query()
def plate_solution(spark: SparkSession, d: str) -> DataFrame:
    """Each detector's coefficients after clipping, forward and back, a row a term; tested against a plain loop."""
    fits, _ = astrometry.plate_solution(plate(spark, d), ["detector"], "id", "x", "y", "u", "v", 3)
    heads = table(spark, d, "customer").select((F.col("c_custkey") % 4).alias("detector")).distinct().select("detector", F.lit(2048).alias("naxis1"), F.lit(2048).alias("naxis2"), F.lit(1025.0).alias("crpix1"), F.lit(1025.0).alias("crpix2"))
    return astrometry.coefficient_rows(fits, astrometry.inverse_surfaces(fits, heads, ["detector"], 3), ["detector"], 3)


CORNERS = """select cut, cast(floor(44 + (cut - 1) % n * (2048.0 / n)) as bigint) - case when (cut - 1) % n = n - 1 then 10 when (cut - 1) % n = 0 then 0 else 5 end as corner_x, cast(floor((cut - 1) // n * (2048.0 / n)) as bigint) - case when (cut - 1) // n = n - 1 then 10 when (cut - 1) // n = 0 then 0 else 5 end as corner_y, ceil(ceil(2048.0 / n) / 2) + 5 as half from (select cast(s_suppkey % (n * n) + 1 as bigint) as cut, n from supplier, (select 3 as n))"""


@query(f"with c as ({CORNERS}) select distinct cut, corner_x, corner_y, (corner_x + half)::double as centre_x, (corner_y + half)::double as centre_y, half::double as half from c")
def cut_corners(spark: SparkSession, d: str) -> DataFrame:
    cuts = table(spark, d, "supplier").select((F.col("s_suppkey") % 9 + 1).cast("long").alias("cut")).distinct()
    return astrometry.cut_corners(cuts, 3, 10)


HEAD = {"crval1": 359.5, "crval2": 30.0, "crpix1": 1025.0, "crpix2": 1030.0, "cd11": -0.0056, "cd12": 0.0004, "cd21": 0.0003, "cd22": 0.0055}


@query(f"""with s as (select c_custkey as id, ((359.5 + (c_custkey * 7919 % 1200) / 100.0 - 6) % 360)::double as ra, (30 + (c_custkey * 104729 % 1000) / 100.0 - 5)::double as dec from customer),
t as (select *, sin(radians(30)) * sin(radians(dec)) + cos(radians(30)) * cos(radians(dec)) * cos(radians(ra - 359.5)) as c from s),
g as (select id, degrees(cos(radians(dec)) * sin(radians(ra - 359.5)) / c) as xi, degrees((cos(radians(30)) * sin(radians(dec)) - sin(radians(30)) * cos(radians(dec)) * cos(radians(ra - 359.5))) / c) as eta from t),
p as (select id, (0.0055 * xi - 0.0004 * eta) / (-0.0056 * 0.0055 - 0.0004 * 0.0003) + 1024 as x, (-0.0056 * eta - 0.0003 * xi) / (-0.0056 * 0.0055 - 0.0004 * 0.0003) + 1029 as y from g),
q as (select *, x + (id % 7 - 3) / 10.0 + 0.25 as sx, y + (id % 5 - 2) / 10.0 - 0.125 as sy from p), c as (select distinct * from ({CORNERS})),
m as (select cut, median(sx - x) as dx, median(sy - y) as dy from q, c where sx > corner_x and sx < corner_x + 2048 / 3.0 and sy > corner_y and sy < corner_y + 2048 / 3.0 group by 1)
select id, cut, round(x - corner_x + coalesce(dx, 0), 5) as cut_x, round(y - corner_y + coalesce(dy, 0), 5) as cut_y from q, c left join m using (cut) where sx > corner_x and sx < corner_x + 2048 / 3.0 and sy > corner_y and sy < corner_y + 2048 / 3.0""")
def cut_positions(spark: SparkSession, d: str) -> DataFrame:
    """Stars in the cuts that hold them, each cut moved by the median shift of its stars."""
    k = F.col("c_custkey")
    head = F.struct(*[F.lit(v).alias(n) for n, v in HEAD.items()])
    stars = table(spark, d, "customer").select(k.alias("id"), F.pmod(359.5 + k * 7919 % 1200 / 100.0 - 6, F.lit(360.0)).alias("ra"), (30 + k * 104729 % 1000 / 100.0 - 5).alias("dec"), F.lit(0).alias("detector"))
    x, y = sky.sky_to_pixel(F.col("ra"), F.col("dec"), head)
    stars = stars.withColumns({"x": x, "y": y}).withColumns({"x_seen": F.col("x") + (F.col("id") % 7 - 3) / 10 + 0.25, "y_seen": F.col("y") + (F.col("id") % 5 - 2) / 10 - 0.125})
    cuts = cut_corners(spark, d).withColumn("detector", F.lit(0))
    width = 2048 / 3
    shifts = astrometry.cut_shifts(stars, cuts, ["detector"], width)
    placed = cuts.join(shifts, ["detector", "cut"]).select("cut", F.struct("corner_x", "corner_y", "dx", "dy").alias("place"))
    cells = placed.select("*", F.explode(F.array(*[F.struct((F.floor(F.col("place.corner_x") / width) + i).alias("i"), (F.floor(F.col("place.corner_y") / width) + j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("cell")).select("cut", "place", "cell.i", "cell.j")
    near = stars.withColumns({"i": F.floor(F.col("x_seen") / width), "j": F.floor(F.col("y_seen") / width)}).join(cells, ["i", "j"])
    sx, sy = F.col("x_seen") - F.col("place.corner_x"), F.col("y_seen") - F.col("place.corner_y")
    cx, cy = astrometry.sky_to_cut(F.col("ra"), F.col("dec"), head, F.col("place"))
    return near.filter((sx > 0) & (sx < width) & (sy > 0) & (sy < width)).select("id", "cut", r(cx, 5).alias("cut_x"), r(cy, 5).alias("cut_y"))

