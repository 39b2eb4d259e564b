"""Queries over points: customers are detections, suppliers stars; positions by integer arithmetic on the key."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.functions import photometry, sky
from chronoloom.operators import filters, spatial
from chronoloom.plans.registry import query, r, table

POINTS = """
with pts as (select c_custkey as id, (c_custkey * 7919 % 10007) / 10.0 as x, (c_custkey * 104729 % 10009) / 10.0 as y, (c_custkey * 31 % 100) / 10.0 as mag from customer),
stars as (select s_suppkey as id, (s_suppkey * 6133 % 10007) / 10.0 as x, (s_suppkey * 99991 % 10009) / 10.0 as y, case when s_suppkey % 5 > 0 then (s_suppkey * 17 % 90) / 10.0 end as mag, case when s_suppkey % 7 > 0 then (s_suppkey * 13 % 80) / 10.0 end as gmag from supplier)
"""


def detections(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), (k * 7919 % 10007 / 10.0).alias("x"), (k * 104729 % 10009 / 10.0).alias("y"), (k * 31 % 100 / 10.0).alias("mag"))


def stars(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("id"), (k * 6133 % 10007 / 10.0).alias("x"), (k * 99991 % 10009 / 10.0).alias("y"), F.when(k % 5 > 0, k * 17 % 90 / 10.0).alias("mag"), F.when(k % 7 > 0, k * 13 % 80 / 10.0).alias("gmag"))


@query(POINTS + "select p.id as l_id, s.id as r_id, round(sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)), 6) as distance from pts p, stars s where sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) <= 40")
def range_join(spark: SparkSession, d: str) -> DataFrame:
    return spatial.within(detections(spark, d), stars(spark, d), 40.0).select("l_id", "r_id", r("distance").alias("distance"))


@query(POINTS + """, j as (select p.id as l_id, s.id as r_id, sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) as distance from pts p, stars s), k as (select *, row_number() over (partition by l_id order by distance, r_id) as k from j where distance < 60)
select l_id, r_id, round(distance, 6) as distance from k where k = 1""")
def nearest_match(spark: SparkSession, d: str) -> DataFrame:
    return spatial.nearest(detections(spark, d), stars(spark, d), 60.0, "id", ["id"]).select("l_id", "r_id", r("distance").alias("distance"))


@query(POINTS + """, j as (select p.id as l_id, s.id as r_id, s.mag, s.gmag from pts p, stars s where sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) <= 60),
k as (select *, row_number() over (partition by l_id order by mag asc nulls last, gmag asc nulls last, r_id) as k from j)
select p.id, coalesce(cast(k.r_id as varchar), '-') as gaia_id from pts p left join k on k.l_id = p.id and k.k = 1""")
def star_crossmatch(spark: SparkSession, d: str) -> DataFrame:
    p = detections(spark, d)
    order = [F.coalesce("r_mag", F.lit(math.inf)), F.coalesce("r_gmag", F.lit(math.inf)), F.col("r_id")]
    best = spatial.best_in_range(p, stars(spark, d), 60.0, "id", order).select(F.col("l_id").alias("id"), F.col("r_id").cast("string").alias("gaia_id"))
    return p.join(best, "id", "left").select("id", F.coalesce("gaia_id", F.lit("-")).alias("gaia_id"))


@query(POINTS + "select id, x, y from pts union all select id, x, y from stars s where not exists (select 1 from pts p where sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) <= 8)")
def anti_union(spark: SparkSession, d: str) -> DataFrame:
    return spatial.anti_union(detections(spark, d).select("id", "x", "y"), stars(spark, d).select("id", "x", "y"), 8.0, "id")


@query(POINTS + "select id from pts p where not exists (select 1 from pts q where sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2)) < 25 and sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2)) > 1 and q.mag < p.mag + 1)")
def isolation(spark: SparkSession, d: str) -> DataFrame:
    return spatial.isolated(detections(spark, d), 25.0, "id", "mag", 1.0, 1.0).select("id")


@query(POINTS + "select p.id, round(min(sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2))), 6) as min_dist from pts p left join pts q on p.id <> q.id and sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2)) <= 20 group by 1")
def self_nn(spark: SparkSession, d: str) -> DataFrame:
    return spatial.self_nearest(detections(spark, d), 20.0, "id").select("id", r("min_dist").alias("min_dist"))


@query(POINTS.replace("with pts", "with recursive pts") + """, e as (select a.id as u, b.id as v from pts a, pts b where a.id <> b.id and sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 9),
reach(u, v) as (select u, v from e union select r.u, e.v from reach r join e on e.u = r.v), m as (select u, min(v) as v from reach group by 1)
select id, least(id, coalesce(v, id)) as "group" from pts left join m on u = id""")
def components_eps(spark: SparkSession, d: str) -> DataFrame:
    return spatial.groups(detections(spark, d), 9.0, "id").select("id", "group")


@query(POINTS + "select id, cast(exists (select 1 from pts q where q.id <> p.id and sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2)) <= 9) as int) as grouped from pts p")
def isolated_detections(spark: SparkSession, d: str) -> DataFrame:
    return spatial.groups(detections(spark, d), 9.0, "id", least=2).select("id", F.col("group").isNotNull().cast("int").alias("grouped"))


SKY = "with s as (select c_custkey as id, (c_custkey * 7919 % 36000) / 100.0 as ra, (c_custkey * 104729 % 17900) / 100.0 - 89.5 as dec from customer)\n"


def positions(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), (k * 7919 % 36000 / 100.0).alias("ra"), (k * 104729 % 17900 / 100.0 - 89.5).alias("dec"))


SEPARATION = "degrees(2 * asin(sqrt(least(1, pow(sin(radians(dec - ({d0})) / 2), 2) + cos(radians(dec)) * cos(radians({d0})) * pow(sin(radians(ra - ({r0})) / 2), 2)))))"


@query(SKY + f"select id, round({SEPARATION.format(r0=359.5, d0=10)}, 6) as separation from s where {SEPARATION.format(r0=359.5, d0=10)} < 12")
def cone_match(spark: SparkSession, d: str) -> DataFrame:
    return spatial.cone(positions(spark, d), 359.5, 10.0, 12.0).select("id", r("separation").alias("separation"))


@query(SKY + f"select id, round({SEPARATION.format(r0=100, d0=-88)}, 6) as separation from s where {SEPARATION.format(r0=100, d0=-88)} < 5")
def cone_at_pole(spark: SparkSession, d: str) -> DataFrame:
    return spatial.cone(positions(spark, d), 100.0, -88.0, 5.0).select("id", r("separation").alias("separation"))


@query(SKY + f"select id, round({SEPARATION.format(r0=10, d0=-20)}, 6) as sep from s")
def haversine(spark: SparkSession, d: str) -> DataFrame:
    return positions(spark, d).select("id", r(sky.separation(F.col("ra"), F.col("dec"), F.lit(10.0), F.lit(-20.0))).alias("sep"))


@query(SKY + """, t as (select *, sin(radians(30)) * sin(radians(dec)) + cos(radians(30)) * cos(radians(dec)) * cos(radians(ra - 80)) as c from s)
select id, case when c > 0 then round(degrees(cos(radians(dec)) * sin(radians(ra - 80)) / c), 6) end as px, case when c > 0 then round(degrees((cos(radians(30)) * sin(radians(dec)) - sin(radians(30)) * cos(radians(dec)) * cos(radians(ra - 80))) / c), 6) end as py from t where c > 0.05""")
def tan_project(spark: SparkSession, d: str) -> DataFrame:
    x, y = sky.tangent_plane(F.col("ra"), F.col("dec"), F.lit(80.0), F.lit(30.0))
    c = F.sin(F.radians(F.lit(30.0))) * F.sin(F.radians("dec")) + F.cos(F.radians(F.lit(30.0))) * F.cos(F.radians("dec")) * F.cos(F.radians(F.col("ra") - 80))
    return positions(spark, d).filter(c > 0.05).select("id", r(x).alias("px"), r(y).alias("py"))


@query(SKY + f"select id, round(ra, 6) as ra2, round(dec, 6) as dec2 from s where {SEPARATION.format(r0=80, d0=30)} < 60")
def tan_round_trip(spark: SparkSession, d: str) -> DataFrame:
    p = spatial.cone(positions(spark, d), 80.0, 30.0, 60.0)
    x, y = sky.tangent_plane(F.col("ra"), F.col("dec"), F.lit(80.0), F.lit(30.0))
    ra, dec = sky.from_tangent_plane(x, y, F.lit(80.0), F.lit(30.0))
    return p.select("id", F.pmod(r(ra), F.lit(360.0)).alias("ra2"), r(dec).alias("dec2"))


@query(POINTS + "select id, round(1.5 + 0.01 * x - 0.002 * y + 1e-5 * x * y + 2e-6 * x * x, 6) as u from pts")
def sip_polynomial(spark: SparkSession, d: str) -> DataFrame:
    c = {(0, 0): 1.5, (1, 0): 0.01, (0, 1): -0.002, (1, 1): 1e-5, (2, 0): 2e-6}
    return detections(spark, d).select("id", r(sky.polynomial(F.col("x"), F.col("y"), c)).alias("u"))


@query(SKY + """, t as (select id, dec, cast(floor(ra / 15 * 3600 * 100 + 0.5) as bigint) % 8640000 as h, cast(floor(abs(dec) * 3600 * 100 + 0.5) as bigint) as a from s)
select id, format('{:02d}:{:02d}:{:02d}.{:02d}', h // 360000, h // 6000 % 60, h // 100 % 60, h % 100) as ra_text,
 case when dec < 0 then '-' else '+' end || format('{:02d}:{:02d}:{:02d}.{:02d}', a // 360000, a // 6000 % 60, a // 100 % 60, a % 100) as dec_text from t""")
def sexagesimal(spark: SparkSession, d: str) -> DataFrame:
    return positions(spark, d).select("id", sky.sexagesimal(F.col("ra"), True).alias("ra_text"), sky.sexagesimal(F.col("dec"), False).alias("dec_text"))


@query(SKY + "select id, round(ra, 3) as ra, round(dec, 3) as dec from s")
def sexagesimal_round_trip(spark: SparkSession, d: str) -> DataFrame:
    p = positions(spark, d)
    ra = sky.degrees_of(sky.sexagesimal(F.col("ra"), True, 4), True)
    dec = sky.degrees_of(sky.sexagesimal(F.col("dec"), False, 4), False)
    return p.select("id", r(ra, 3).alias("ra"), r(dec, 3).alias("dec"))


@query(SKY + """, t as (select id, dec, cast(floor(ra / 15 * 3600 * 100 + 0.5) as bigint) % 8640000 as h, cast(floor(abs(dec) * 3600 * 100 + 0.5) as bigint) as a from s)
select id, 'EVT ' || format('{:02d}{:02d}{:02d}.{:02d}', h // 360000, h // 6000 % 60, h // 100 % 60, h % 100) || case when dec < 0 then '-' else '+' end
 || format('{:02d}{:02d}{:02d}.{:02d}', a // 360000, a // 6000 % 60, a // 100 % 60, a % 100) || 'T' || (58000 + id) as name from t""")
def catalogue_names(spark: SparkSession, d: str) -> DataFrame:
    return positions(spark, d).select("id", sky.catalogue_name(F.col("ra"), F.col("dec"), F.col("id") + 58000).alias("name"))


@query(SKY + """, v as (select id, cos(radians(dec)) * cos(radians(ra)) as a, cos(radians(dec)) * sin(radians(ra)) as b, sin(radians(dec)) as c from s),
g as (select id, -0.0548755604162154 * a - 0.8734370902348850 * b - 0.4838350155487132 * c as x, 0.4941094278755837 * a - 0.4448296299600112 * b + 0.7469822444972189 * c as y, -0.8676661490190047 * a - 0.1980763734312015 * b + 0.4559837761750669 * c as z from v)
select id, round((degrees(atan2(y, x)) % 360 + 360) % 360, 6) as gal_l, round(degrees(asin(greatest(-1, least(1, z)))), 6) as gal_b from g""")
def galactic(spark: SparkSession, d: str) -> DataFrame:
    lon, lat = sky.galactic(F.col("ra"), F.col("dec"))
    return positions(spark, d).select("id", r(lon).alias("gal_l"), r(lat).alias("gal_b"))


@query("with t as (select c_custkey as id, c_custkey % 721 - 360.5 as d from customer) select id, round(((d + 180) % 360 + 360) % 360 - 180, 6) as wrapped from t")
def wrap_delta(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.functions.values import wrap_degrees

    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), r(wrap_degrees(F.col("c_custkey") % 721 - 360.5)).alias("wrapped"))


@query(POINTS + "select id, cast((y >= 100) <> (y >= 800) as int) * cast(x < 700 as int) as inside from pts")
def point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    square = [(-1.0, 100.0), (700.0, 100.0), (700.0, 800.0), (-1.0, 800.0)]
    return detections(spark, d).select("id", spatial.in_polygon(F.col("x"), F.col("y"), square).cast("int").alias("inside"))


@query("with c as (select c_custkey + 1 as cut, cast(ceil(sqrt(count(*) over ())) as bigint) as n from customer) select cast(cut as bigint) as cut, cast((cut - 1) % n * 256 as int) as corner_x, cast((cut - 1) // n * 256 as int) as corner_y, (cut - 1) % n * 256 + 128.0::double as centre_x, (cut - 1) // n * 256 + 128.0::double as centre_y, 128.0::double as half from c")
def cut_grid(spark: SparkSession, d: str) -> DataFrame:
    cuts = table(spark, d, "customer").select((F.col("c_custkey") + 1).cast("long").alias("cut"))
    n = math.ceil(math.sqrt(cuts.count()))
    return spatial.cut_grid(cuts, n, 256 * n)


@query(POINTS + """, g as (select i as site, i % 20 * 50 + 25.0 as x, i // 20 * 50 + 25.0 as y from range(400) t(i))
select site, x::double as x, y::double as y from g where not exists (select 1 from stars s where sqrt(pow(g.x - s.x, 2) + pow(g.y - s.y, 2)) < 60)""")
def free_sites(spark: SparkSession, d: str) -> DataFrame:
    return spatial.free_sites(stars(spark, d), 1000, 1000, 50, 60.0).select("site", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))


@query()
def brightest_first(spark: SparkSession, d: str) -> DataFrame:
    p = detections(spark, d).withColumn("frame", F.col("id") % 16)
    return spatial.brightest_first(p, ["frame"], 30.0, "mag", "id").select("frame", "id", "x", "y", "mag")


@query(POINTS + "select id, x from stars where mag is not null and gmag is not null")
def present_magnitudes(spark: SparkSession, d: str) -> DataFrame:
    """Stars with both magnitudes."""
    return stars(spark, d).filter(filters.present(["mag", "gmag"])).select("id", "x")


@query(POINTS + "select id, case when gmag is null then 'none' else 'faint' end as kind from stars where gmag is null or gmag = 2.6")
def equal_or_missing(spark: SparkSession, d: str) -> DataFrame:
    """Stars whose second magnitude is missing, or a given one."""
    s = stars(spark, d)
    none = s.filter(filters.equals(F.col("gmag"), None)).select("id", F.lit("none").alias("kind"))
    return none.union(s.filter(filters.equals(F.col("gmag"), 2.6)).select("id", F.lit("faint").alias("kind")))


@query(POINTS + "select mag, id, x, y, gmag from stars")
def fixed_order(spark: SparkSession, d: str) -> DataFrame:
    """Columns in a fixed order, those that are absent passed over."""
    return filters.ordered_columns(stars(spark, d), ["mag", "absent", "id"])


@query("""select c_custkey, case ['counts', 'mag', 'mJy', 'cgs'][c_custkey % 4 + 1] when 'counts' then 'Counts (e/s)' when 'mag' then 'AB magnitude' else 'Flux (' || ['counts', 'mag', 'mJy', 'cgs'][c_custkey % 4 + 1] || ')' end as label from customer""")
def unit_labels(spark: SparkSession, d: str) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ("counts", "mag", "mJy", "cgs"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", photometry.unit_label(unit).alias("label"))
