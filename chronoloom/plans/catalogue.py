"""Queries that select from tables of events, objects and detections; such tables are derived from `events` and `customer`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.operators import crossmatch, filters, rollup, spatial
from chronoloom.plans.registry import query, r, table

CLASSES = ("VCR", "vrrlyr", "VEB", "VLPV", "Junk", "VAGN", "CosmicRay", "VMSO", "RRLyrae", "Asteroid", "-")
CLASS_SQL = "[" + ", ".join(f"'{c}'" for c in CLASSES) + "]"

EVENTS = f"""
with et as (
  select user_id as objid, event_id as eventid, [1, 4, 24][event_id % 3 + 1] as frame_bin, {CLASS_SQL}[event_id % 11 + 1] as classification,
    case when event_id % 4 < 3 then '-' else 'star' end as gaia_id, event_id % 6 as source_mask, event_id % 5 as n_cross, cast(event_id % 7 = 0 as int) as bad_frame_flag,
    event_id % 2 as lc_flat, event_id * 37 % 181 - 90.0 as gal_b, event_id * 13 % 97 as frame_duration, value as lc_sig_max, event_id * 11 % 50 / 50.0 as psf_like,
    count(*) over (partition by user_id) as total_events, case when event_id % 10 < 7 then 1 else -1 end as flux_sign,
    event_id * 17 % 40 / 40.0 as xcentroid_err, event_id * 23 % 40 / 40.0 as ycentroid_err,
    (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // 60000000 / 1440.0 as mjd_start, event_id % 300 / 1440.0 as mjd_duration,
    event_id * 7919 % 10007 / 10.0 as xccd, event_id * 104729 % 10009 / 10.0 as yccd, event_id % 16 + 1 as cut
  from events),
ot as (
  select objid, case when objid % 3 = 0 then '-' else 'star' end as gaia_id, count(*) as n_events, objid * 137 % 3600 / 10.0 as ra, objid * 71 % 1781 / 10.0 - 89 as dec,
    objid * 37 % 181 - 90.0 as gal_b, {CLASS_SQL}[objid % 11 + 1] as classification, [1, 4, 24][objid % 3 + 1] as frame_bin, case when objid % 2 = 0 then 1 else -1 end as flux_sign,
    max(lc_sig_max) as lc_sig_max, max(psf_like) as psf_maxsig, min(frame_duration) as min_eventlength_frame, max(frame_duration) as max_eventlength_frame,
    max(mjd_duration) as max_eventlength_mjd, objid * 17 % 40 / 40.0 as xcentroid_err, objid * 23 % 40 / 40.0 as ycentroid_err
  from et group by objid)
"""


def _pick(key: str, values) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))


def event_table(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    ev = table(spark, d, "events")
    minute = F.expr("div(timestampdiff(microsecond, timestamp_ntz'2024-01-01 00:00:00', ts), 60000000)")
    out = ev.select(
        F.col("user_id").alias("objid"), k.alias("eventid"), _pick("event_id", (1, 4, 24)).alias("frame_bin"), _pick("event_id", CLASSES).alias("classification"),
        F.when(k % 4 < 3, "-").otherwise("star").alias("gaia_id"), (k % 6).alias("source_mask"), F.when(k % 5 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k % 5)).alias("crossbin_ids"),
        (k % 7 == 0).cast("int").alias("bad_frame_flag"), (k % 2).alias("lc_flat"), (k * 37 % 181 - 90.0).alias("gal_b"), (k * 13 % 97).alias("frame_duration"),
        F.col("value").alias("lc_sig_max"), (k * 11 % 50 / 50.0).alias("psf_like"), F.when(k % 10 < 7, 1).otherwise(-1).alias("flux_sign"),
        (k * 17 % 40 / 40.0).alias("xcentroid_err"), (k * 23 % 40 / 40.0).alias("ycentroid_err"), (minute / 1440.0).alias("mjd_start"), (k % 300 / 1440.0).alias("mjd_duration"),
        (k * 7919 % 10007 / 10.0).alias("xccd"), (k * 104729 % 10009 / 10.0).alias("yccd"), (k % 16 + 1).alias("cut"),
    )
    return out.join(ev.groupBy(F.col("user_id").alias("objid")).agg(F.count("*").alias("total_events")), "objid")


def object_table(spark: SparkSession, d: str) -> DataFrame:
    o = F.col("objid")
    own = event_table(spark, d).groupBy("objid").agg(
        F.count("*").alias("n_events"), F.max("lc_sig_max").alias("lc_sig_max"), F.max("psf_like").alias("psf_maxsig"), F.min("frame_duration").alias("min_eventlength_frame"),
        F.max("frame_duration").alias("max_eventlength_frame"), F.max("mjd_duration").alias("max_eventlength_mjd"))
    return own.withColumns({
        "gaia_id": F.when(o % 3 == 0, "-").otherwise("star"), "ra": o * 137 % 3600 / 10.0, "dec": o * 71 % 1781 / 10.0 - 89, "gal_b": o * 37 % 181 - 90.0, "classification": _pick("objid", CLASSES),
        "frame_bin": _pick("objid", (1, 4, 24)), "flux_sign": F.when(o % 2 == 0, 1).otherwise(-1), "xcentroid_err": o * 17 % 40 / 40.0, "ycentroid_err": o * 23 % 40 / 40.0})


def _labelled(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        df = df.select(F.lit(name).alias("rule"), "objid", "eventid")
        out = df if out is None else out.union(df)
    return out


def _labelled_sql(parts: dict[str, str]) -> str:
    return EVENTS + " union all ".join(f"select '{k}' as rule, objid, eventid from et where {w}" for k, w in parts.items())


@query(_labelled_sql({"free": "classification <> 'Junk' and gaia_id = '-'", "hard": "classification <> 'Junk' and gaia_id = '-' and objid in (select objid from ot where gaia_id = '-')", "starred": "classification <> 'Junk' and gaia_id <> '-'"}))
def event_filter_stars(spark: SparkSession, d: str) -> DataFrame:
    ev = event_table(spark, d)
    return _labelled({"free": filters.filter_events(ev, star_free=True), "hard": filters.filter_events(ev, object_table(spark, d), star_free="hard"), "starred": filters.filter_events(ev, star_free=False)})


@query(_labelled_sql({
    "mask": "classification not in ('Junk', 'Asteroid', 'CosmicRay') and source_mask < 4 and frame_bin = 4", "alone": "classification <> 'Junk' and n_cross = 0 and bad_frame_flag = 0",
    "flat": "classification <> 'Junk' and lc_flat = 1", "steep": "lc_flat = 0"}))
def event_filter_flags(spark: SparkSession, d: str) -> DataFrame:
    ev = event_table(spark, d)
    return _labelled({
        "mask": filters.filter_events(ev, exclude=("Junk", "Asteroid", "CosmicRay"), source_mask_below=4, frame_bin=4), "alone": filters.filter_events(ev, crossbins=False, bad_frames=False),
        "flat": filters.filter_events(ev, flat=True), "steep": filters.filter_events(ev, exclude=(), flat=False)})


@query(_labelled_sql({
    "high": "classification <> 'Junk' and abs(gal_b) >= 60 and total_events between 60 and 75", "belt": "classification <> 'Junk' and abs(gal_b) between 10 and 30 and flux_sign = -1",
    "short": "classification <> 'Junk' and frame_duration >= 4.0 / frame_bin and frame_duration <= 200.0 / frame_bin",
    "clear": "classification <> 'Junk' and lc_sig_max >= 20 and psf_like >= 0.5 and xcentroid_err * xcentroid_err + ycentroid_err * ycentroid_err <= 2 * 0.25"}))
def event_filter_ranges(spark: SparkSession, d: str) -> DataFrame:
    ev = event_table(spark, d)
    return _labelled({
        "high": filters.filter_events(ev, galactic_latitude=60.0, total_events=(60, 75)), "belt": filters.filter_events(ev, galactic_latitude=[30, -10], flux_sign=-1),
        "short": filters.filter_events(ev, frame_duration=(4.0, 200.0)), "clear": filters.filter_events(ev, at_least={"lc_sig_max": 20, "psf_like": 0.5}, centroid_error=0.5)})


@query(_labelled_sql({
    "variable": "lower(classification) in ('vcr', 'vrrlyr', 'veb', 'vlpv', 'vagn', 'vmso', 'rrlyrae')", "steady": "classification in ('CosmicRay', 'Asteroid', '-')", "one": "classification = 'vrrlyr'"}))
def event_filter_classes(spark: SparkSession, d: str) -> DataFrame:
    ev = event_table(spark, d)
    return _labelled({"variable": filters.filter_events(ev, classification="var"), "steady": filters.filter_events(ev, classification="~Variable"), "one": filters.filter_events(ev, classification="VRRLyr")})


SEPARATION = "degrees(2 * asin(sqrt(least(1.0, pow(sin(radians({d2} - {d1}) / 2), 2) + cos(radians({d1})) * cos(radians({d2})) * pow(sin(radians({r2} - {r1}) / 2), 2)))))"


@query(EVENTS + f""", s as (select *, {SEPARATION.format(r1="ra", d1="dec", r2="10.0", d2="60.0")} as away from ot)
select 'cone' as rule, objid from s where away < 25 union all
select 'counts', objid from ot where n_events between 55 and 70 and abs(gal_b) between 5 and 50 union all
select 'class', objid from ot where classification in ('VCR', 'vrrlyr', 'VEB', 'VLPV', 'VAGN', 'VMSO') and frame_bin = 4 union all
select 'rest', objid from ot where classification not in ('VCR', 'vrrlyr', 'VEB', 'VLPV', 'VAGN', 'VMSO') and flux_sign = 1 union all
select 'limits', objid from ot where lc_sig_max >= 50 and psf_maxsig >= 0.9 and min_eventlength_frame >= 1 and max_eventlength_mjd <= 0.207 and xcentroid_err * xcentroid_err + ycentroid_err * ycentroid_err <= 1.28""")
def object_filters(spark: SparkSession, d: str) -> DataFrame:
    o = object_table(spark, d)
    parts = {
        "cone": filters.filter_objects(o, centre=(10.0, 60.0), distance=90000.0), "counts": filters.filter_objects(o, n_events=(55, 70), galactic_latitude=[5, 50]),
        "class": filters.filter_objects(o, classification="variable", frame_bin=4), "rest": filters.filter_objects(o, classification="!var", flux_sign=1),
        "limits": filters.filter_objects(o, centroid_error=0.8, at_least={"lc_sig_max": 50, "psf_maxsig": 0.9, "min_eventlength_frame": 1}, at_most={"max_eventlength_mjd": 0.207}),
    }
    return _labelled({k: v.withColumn("eventid", F.lit(0)) for k, v in parts.items()}).select("rule", "objid")


@query("""with s as (select c_custkey as id, c_custkey % 61 / 10.0 as snr, c_custkey % 45 / 10.0 as neg_extent, c_custkey % 100 / 100.0 as ellipticity, c_custkey * 7919 % 101 as xint, c_custkey * 104729 % 97 as yint from customer)
select id, xint, yint from s where snr >= 3 and neg_extent < 3 and ellipticity < 0.75 and xint > 3 and xint < 97 and yint > 3 and yint < 93""")
def detection_cuts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    s = table(spark, d, "customer").select(k.alias("id"), (k % 61 / 10.0).alias("snr"), (k % 45 / 10.0).alias("neg_extent"), (k % 100 / 100.0).alias("ellipticity"), (k * 7919 % 101).alias("xint"), (k * 104729 % 97).alias("yint"))
    return s.filter(filters.good_detection() & filters.inside_edges(F.col("xint"), F.col("yint"), 100, 96)).select("id", "xint", "yint")


@query(EVENTS + """, c as (select *, eventid * 29 % 120 / 100.0 as motion, eventid * 31 % 101 / 100.0 as likeness from et
  where frame_duration between 2 and 50 and lc_sig_max >= 5 and flux_sign = 1 and frame_bin = (select min(frame_bin) from et) and classification not in ('CosmicRay', 'Junk'))
select eventid, case when motion >= 1 or (motion >= 0.75 and likeness >= 0.7) or (motion >= 0.5 and likeness >= 0.9) then 'Asteroid' else classification end as classification from c""")
def moving_events(spark: SparkSession, d: str) -> DataFrame:
    found = filters.moving_candidates(event_table(spark, d))
    k = F.col("eventid")
    return found.select("eventid", filters.moving_class(k * 29 % 120 / 100.0, k * 31 % 101 / 100.0, F.col("classification")).alias("classification"))


@query(EVENTS + "select eventid, objid from et where classification = 'Asteroid' and frame_duration between 3 and 60 and lc_sig_max between 4 and 90 and psf_like <= 0.8")
def recovered_filter(spark: SparkSession, d: str) -> DataFrame:
    out = filters.filter_recovered(event_table(spark, d), {"classification": "Asteroid"}, {"frame_duration": 3, "lc_sig_max": 4}, {"frame_duration": 60, "lc_sig_max": 90, "psf_like": 0.8})
    return out.select("eventid", "objid")


REGION = ((200.03, 100.07), (800.03, 200.07), (900.03, 700.07), (500.03, 950.07), (150.03, 600.07))
LEFT_OF_EDGES = " and ".join(f"({x2 - x1!r}) * (yccd - {y1}) - ({y2 - y1!r}) * (xccd - {x1}) > 0" for (x1, y1), (x2, y2) in zip(REGION, [*REGION[1:], REGION[0]]))


@query(EVENTS + f"select eventid, cut, round(mjd_start, 6) as mjd_start from et where mjd_start > 2 and mjd_start < 20 and mjd_duration < 0.1 and lc_sig_max > 1.5 and (cut in (6, 7) or (cut in (2, 3, 5, 8, 10, 11) and {LEFT_OF_EDGES}))")
def candidate_events(spark: SparkSession, d: str) -> DataFrame:
    out = filters.candidates_in_region(event_table(spark, d), REGION, 2.0, 20.0, 0.1, 1.5, (6, 7), (2, 3, 5, 8, 10, 11))
    return out.select("eventid", "cut", r("mjd_start").alias("mjd_start")).orderBy("mjd_start", "eventid")


SKY = """
with cat as (select c_custkey as id, c_custkey * 7919 % 36000 / 100.0 as ra, c_custkey * 104729 % 18001 / 100.0 - 90 as dec from customer),
cen as (select s_suppkey as id, s_suppkey * 6133 % 36000 / 100.0 as ra, s_suppkey * 99991 % 18001 / 100.0 - 90 as dec from supplier),
""" + f"j as (select cen.id as centre, cat.id, {SEPARATION.format(r1='cen.ra', d1='cen.dec', r2='cat.ra', d2='cat.dec')} as separation from cen, cat)"


def _sky(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    cat = table(spark, d, "customer").select(c.alias("id"), (c * 7919 % 36000 / 100.0).alias("ra"), (c * 104729 % 18001 / 100.0 - 90).alias("dec"))
    return table(spark, d, "supplier").select(s.alias("id"), (s * 6133 % 36000 / 100.0).alias("ra"), (s * 99991 % 18001 / 100.0 - 90).alias("dec")), cat


@query(SKY + "select centre, id, round(separation, 6) as separation from j where separation <= 4")
def many_cones(spark: SparkSession, d: str) -> DataFrame:
    centres, cat = _sky(spark, d)
    return spatial.sky_within(cat, centres, 4.0).select(F.col("r_id").alias("centre"), F.col("l_id").alias("id"), r("separation").alias("separation"))


@query(SKY + ", k as (select *, row_number() over (partition by id order by separation, centre) as k from j where separation <= 7) select id, centre, round(separation, 6) as separation from k where k = 1")
def sky_nearest(spark: SparkSession, d: str) -> DataFrame:
    centres, cat = _sky(spark, d)
    return spatial.sky_nearest(cat, centres, 7.0, "id", ["id"]).select(F.col("l_id").alias("id"), F.col("r_id").alias("centre"), r("separation").alias("separation"))


MATCH = """with e as (select c_custkey as id, c_custkey * 7919 % 36000 / 100.0 as ra, c_custkey * 104729 % 16001 / 100.0 - 80 as dec, (c_custkey % 7 + 1) * (c_custkey % 3 + 1) / 6.0 as ra_err, (c_custkey % 5 + 1) / 4.0 as dec_err, """ + f"{CLASS_SQL}[c_custkey % 11 + 1]" + """ as classification from customer),
c as (select s_suppkey as ordinal, 'S' || s_suppkey as source, s_suppkey * 6133 % 36000 / 100.0 as ra, s_suppkey * 99991 % 16001 / 100.0 - 80 as dec, case when s_suppkey % 3 > 0 then s_suppkey * 17 % 90 / 10.0 end as rpmag, case when s_suppkey % 4 > 0 then s_suppkey * 13 % 80 / 10.0 end as gmag, 'V' || s_suppkey % 5 as type from supplier),
"""


def _matches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    e = table(spark, d, "customer").select(k.alias("id"), (k * 7919 % 36000 / 100.0).alias("ra"), (k * 104729 % 16001 / 100.0 - 80).alias("dec"), ((k % 7 + 1) * (k % 3 + 1) / 6.0).alias("ra_err"), ((k % 5 + 1) / 4.0).alias("dec_err"), _pick("c_custkey", CLASSES).alias("classification"))
    c = table(spark, d, "supplier").select(
        s.alias("ordinal"), F.concat(F.lit("S"), s).alias("source"), (s * 6133 % 36000 / 100.0).alias("ra"), (s * 99991 % 16001 / 100.0 - 80).alias("dec"), F.when(s % 3 > 0, s * 17 % 90 / 10.0).alias("rpmag"), F.when(s % 4 > 0, s * 13 % 80 / 10.0).alias("gmag"),
        F.concat(F.lit("V"), s % 5).alias("type"))
    return e, c


@query(MATCH + """j as (select e.id, c.*, ((c.ra - e.ra + 180) % 360 + 360) % 360 - 180 as dra, c.dec - e.dec as ddec, e.dec as lat, ra_err, dec_err from e, c where e.classification not in ('Asteroid', 'CosmicRay', 'Junk')),
k as (select *, dra * cos(radians(lat)) / ra_err as a, ddec / dec_err as b from j), i as (select * from k where abs(a) < 3 and abs(b) < 3 and sqrt(a * a + b * b) <= 3),
n as (select id, source, row_number() over (partition by id order by rpmag asc nulls last, case when rpmag is null then gmag end asc nulls last, ordinal) as n from i)
select e.id, coalesce(n.source, '-') as gaia_id from e left join n on e.id = n.id and n.n = 1""")
def star_ellipses(spark: SparkSession, d: str) -> DataFrame:
    """The brightest star in each event's own error ellipse."""
    return crossmatch.match_stars(*_matches(spark, d), "id").select("id", "gaia_id")


@query(MATCH + """n as (select e.id, c.type, row_number() over (partition by e.id order by ordinal) as n from e, c where classification not in ('Asteroid', 'CosmicRay', 'Junk') and abs(c.ra - e.ra) < 3 * ra_err and abs(c.dec - e.dec) < 3 * dec_err)
select e.id, coalesce(n.type, e.classification) as classification from e left join n on e.id = n.id and n.n = 1""")
def variable_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Classes overwritten by the first variable in each event's box."""
    return crossmatch.match_variables(*_matches(spark, d), "id").select("id", "classification")


@query(MATCH + """t as (select ordinal % 4 as cat, ordinal as id, ra, dec, type from c union all select 4 + id % 4, id, ra, dec, null from e),
s(id1, cat1, near, other) as (select x.id, x.cat, y.cat, y.id from t x, t y where y.cat < x.cat and degrees(2 * asin(sqrt(least(1.0, power(sin(radians(y.dec - x.dec) / 2), 2) + cos(radians(x.dec)) * cos(radians(y.dec)) * power(sin(radians(y.ra - x.ra) / 2), 2))))) <= 1.5),
k0 as (select cat, id from t where cat = 0),
""" + ", ".join(f"k{i} as (select * from k{i - 1} union all select cat, id from t where cat = {i} and not exists (select 1 from s join k{i - 1} k on s.near = k.cat and s.other = k.id where s.cat1 = {i} and s.id1 = t.id))" for i in range(1, 8)) + """
select k.cat, k.id, t.type from k7 k join t on k.cat = t.cat and k.id = t.id""")
def folded_catalogues(spark: SparkSession, d: str) -> DataFrame:
    """Eight catalogues, each without what is in those before."""
    e, c = _matches(spark, d)
    parts = [c.filter(F.col("ordinal") % 4 == i).select(F.lit(i).alias("cat"), F.col("ordinal").alias("id"), "ra", "dec", "type") for i in range(4)]
    parts += [e.filter(F.col("id") % 4 == i).select(F.lit(4 + i).alias("cat"), "id", "ra", "dec") for i in range(4)]
    return crossmatch.fold_catalogues([*parts[:2], None, *parts[2:]], 1.5).select("cat", "id", "type")


@query(EVENTS + """, m as (select *, case when eventid % 19 > 0 then eventid * 53 % 211 / 7.0 end as image_sig_max, eventid * 3 as asteroid_id from et where objid % 3 > 0 or eventid % 71 = 0),
b as (select *, row_number() over (partition by objid order by image_sig_max desc nulls last, eventid) as k, count(*) over (partition by objid) as n from m),
c as (select objid, classification, row_number() over (partition by objid order by count(*) desc, classification) as k from m group by 1, 2),
a as (select objid, min(frame_duration) as min_eventlength_frame, max(frame_duration) as max_eventlength_frame, min(mjd_duration) as min_eventlength_mjd, max(mjd_duration) as max_eventlength_mjd, cast(sum(distinct flux_sign) as bigint) as flux_sign from m group by 1)
select b.objid, case when c.classification = 'RRLyrae' then 'VRRLyr' else c.classification end as classification, b.cut, b.gal_b, b.xcentroid_err, b.ycentroid_err, round(b.image_sig_max, 6) as image_sig_max, b.lc_sig_max, b.psf_like as psf_maxsig, b.gaia_id, b.frame_bin,
  case when n < 2 and b.classification = 'Asteroid' then cast(b.asteroid_id as varchar) else '-' end as asteroid_id, a.* exclude (objid), n as n_events
from b join c on b.objid = c.objid and c.k = 1 join a on a.objid = b.objid where b.k = 1""")
def found_objects(spark: SparkSession, d: str) -> DataFrame:
    """Objects of events, a third of them with few."""
    e = event_table(spark, d).filter("objid % 3 > 0 or eventid % 71 = 0").withColumns({"image_sig_max": F.when(F.col("eventid") % 19 > 0, F.col("eventid") * 53 % 211 / 7.0), "asteroid_id": F.col("eventid") * 3})
    return rollup.find_objects(e).withColumn("image_sig_max", r("image_sig_max"))


@query(EVENTS + """, f as (select eventid, frame_bin, cast(floor(mjd_start * 1440) as bigint) // (60 * frame_bin) as frame_start, cast(floor(mjd_start * 1440) as bigint) // (60 * frame_bin) + eventid % 4 as frame_end, classification from et),
g as (select unnest([1, 4, 24]) as size, unnest([[0, 360, 361, 719], [0, 90, 91, 179], [0, 15, 16, 29]]) as frames), h as (select size, unnest(frames) as edge from g)
select eventid from f where classification <> 'Junk' and not exists (select 1 from h where size = frame_bin and frame_start <= edge + 50 // size and frame_end >= edge - 50 // size)""")
def event_filter_boundary(spark: SparkSession, d: str) -> DataFrame:
    """Events away from the ends and the break of the observations, in each bin's own frames."""
    start = F.expr("div(cast(floor(mjd_start * 1440) as bigint), 60 * frame_bin)")
    e = event_table(spark, d).withColumn("frame_start", start).withColumn("frame_end", F.col("frame_start") + F.col("eventid") % 4)
    return filters.filter_events(e, boundary_buffer=50, boundaries={1: (0, 360, 361, 719), 4: (0, 90, 91, 179), 24: (0, 15, 16, 29)}).select("eventid")
