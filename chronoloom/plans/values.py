"""Queries that apply column functions to line items and other wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.functions import photometry as ph, sky, values as v
from chronoloom.plans.registry import query, r, table

ITEMS = "with li as (select l_orderkey as k, l_linenumber as n, l_extendedprice as flux, l_quantity * 100 as err, 20 + l_discount * 10 as zp, l_tax as tax, l_quantity as q, l_discount as disc from lineitem)\n"


def items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("flux"), (F.col("l_quantity") * 100).alias("err"), (20 + F.col("l_discount") * 10).alias("zp"), F.col("l_tax").alias("tax"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("disc"))


@query(ITEMS + """, u as (select *, case k % 5 when 0 then 'counts' when 1 then 'Jy' when 2 then 'mJy' when 3 then 'muJy' else 'mag' end as unit from li)
select k, n, unit, round(case unit when 'counts' then flux when 'mag' then zp - 2.5 * log10(case when flux > err then flux else err end)
  else flux * 3631 / pow(10, 0.4 * zp) * case unit when 'Jy' then 1 when 'mJy' then 1e3 else 1e6 end end, 6) as value,
 round(case unit when 'counts' then err when 'mag' then case when flux > err then 2.5 / ln(10) * err / flux end
  else err * 3631 / pow(10, 0.4 * zp) * case unit when 'Jy' then 1 when 'mJy' then 1e3 else 1e6 end end, 6) as error from u""")
def unit_convert(spark: SparkSession, d: str) -> DataFrame:
    unit = F.element_at(F.array(*[F.lit(u) for u in ("counts", "Jy", "mJy", "muJy", "mag")]), (F.col("k") % 5 + 1).cast("int"))
    li = items(spark, d).withColumn("unit", unit)
    value, error = ph.convert_flux(F.col("flux"), F.col("err"), F.col("zp"), F.col("unit"))
    return li.select("k", "n", "unit", r(value).alias("value"), r(error).alias("error"))


@query(ITEMS + "select k, n, round(case when flux / err >= 10 then zp - 2.5 * log10(flux) else zp - 2.5 * log10(10 * err) end, 6) as mag, round(case when flux / err >= 10 then 2.5 / ln(10) * err / flux end, 6) as mag_err from li")
def flux2mag(spark: SparkSession, d: str) -> DataFrame:
    mag, err = ph.flux_to_mag(F.col("flux"), F.col("err"), F.col("zp"), 10.0)
    return items(spark, d).select("k", "n", r(mag).alias("mag"), r(err).alias("mag_err"))


@query(ITEMS + "select k, n, round(flux - err, 6) as colour, case when n <> 3 then round(sqrt(q * q + disc * disc), 6) end as colour_err from li")
def colour(spark: SparkSession, d: str) -> DataFrame:
    c, e = ph.colour(F.col("flux"), F.when(F.col("n") != 3, F.col("q")), F.col("err"), F.col("disc"))
    return items(spark, d).select("k", "n", r(c).alias("colour"), r(e).alias("colour_err"))


@query(ITEMS + "select k, n, round(pow(10, 0.4 * disc), 6) as scale, round(2.5 * log10(q), 6) as zp_of, round(zp + 2.5 * log10((tax + 0.02)), 6) as zp_ap, round(zp - 2.5 * log10(3 * q * 1.2), 6) as limit3 from li")
def zeropoints(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).select("k", "n", r(ph.scale_of_zeropoint(F.col("disc"))).alias("scale"), r(ph.zeropoint_of_scale(F.col("q"))).alias("zp_of"), r(ph.aperture_zeropoint(F.col("zp"), F.col("tax") + 0.02)).alias("zp_ap"), r(ph.detection_limit(F.col("zp"), F.col("q"), 3.0, F.lit(1.2))).alias("limit3"))


BAZIN = "(5 * exp(greatest(-50, least(50, -({t} - 4) / (2 + disc)))) / (1 + exp(greatest(-50, least(50, -({t} - 4) / (0.5 + tax))))) + 1)"


@query(ITEMS + f"select k, n, round({BAZIN.format(t='q')}, 6) as f, round(({' + '.join(BAZIN.format(t=f'(q + {i / 6 - 0.5!r})') for i in range(7))}) / 7, 6) as f_exposed from li")
def bazin_expr(spark: SparkSession, d: str) -> DataFrame:
    args = (F.lit(5.0), F.lit(4.0), 0.5 + F.col("tax"), 2 + F.col("disc"), F.lit(1.0))
    return items(spark, d).select("k", "n", r(ph.bazin(F.col("q"), *args)).alias("f"), r(ph.bazin_exposed(F.col("q"), F.lit(1.0), *args)).alias("f_exposed"))


@query(ITEMS + "select k, n, round(3 * exp(-0.5 * pow((q - 25) / 6, 2)) + 1, 6) as g, round(2 * sin(2 * pi() * q / 7 + 0.3), 6) as s from li")
def profiles(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("q")
    return items(spark, d).select("k", "n", r(ph.gaussian(q, F.lit(3.0), F.lit(25.0), F.lit(6.0), F.lit(1.0))).alias("g"), r(ph.sinusoid(q, F.lit(2.0), F.lit(7.0), F.lit(0.3))).alias("s"))


@query(ITEMS + """select k, n, round(sqrt(pow(1.3 * pow(q, -0.9), 2) + 0.0025), 6) as loc_err, round((q * q / 2.5 + sqrt(pow(q * q / 2.5, 2) + 4 * q * q * 9 * 4)) / 2, 6) as flux_of_snr,
 round(case when n = 2 then 0.5 else sqrt(q * q + tax * tax) * 1.136 end, 6) as cen_err, round(1 - (q / 2) / q, 6) as ellipticity, round(2 * sqrt(2 * ln(2)) * sqrt(q * (q / 2)), 6) as fwhm from li""")
def errors_and_shapes(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("q")
    e, w = ph.shape(q, q / 2)
    return items(spark, d).select("k", "n", r(ph.localisation_error(q, 1.3, 0.9, 0.05)).alias("loc_err"), r(ph.flux_of_snr(q, F.lit(2.0), F.lit(9.0), F.lit(2.5))).alias("flux_of_snr"), r(ph.centroid_error(q, F.when(F.col("n") != 2, F.col("tax")))).alias("cen_err"), r(e).alias("ellipticity"), r(w).alias("fwhm"))


@query(ITEMS + "select k, n, case when disc < 0.05 then 1 when disc < 0.1 then 2 else 0 end as cls, case when q / 50 > 0.9 then 0 when q / 50 < 0.7 then 2 else 1 end as prob_cls from li")
def star_classes(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).select("k", "n", ph.star_class(F.col("disc")).alias("cls"), ph.star_class_by_probability(F.col("q") / 50).alias("prob_cls"))


@query("""with f as (select c_custkey as id, c_custkey % 5 as g, case when c_custkey % 3 > 0 then c_custkey % 4 end as r, c_custkey % 2 * 2 as i, case when c_custkey % 7 > 0 then c_custkey % 6 end as z, case when c_custkey % 11 > 0 then c_custkey % 101 / 100.0 end as score from customer)
select id, (case when coalesce(g = 3, false) or coalesce(r = 3, false) or coalesce(i = 3, false) or coalesce(z = 3, false) then 0 when coalesce(g = 1, false) or coalesce(r = 1, false) or coalesce(i = 1, false) or coalesce(z = 1, false) then 1 else 2 end)::int as by_flags,
 (case when score >= 0.9 then 1 when score <= 0.7 or score is null then 0 else 2 end)::int as by_score from f""")
def star_flags(spark: SparkSession, d: str) -> DataFrame:
    """Stars and galaxies by a flag a band, and by a score."""
    k = F.col("c_custkey").cast("int")
    flags = [k % 5, F.when(k % 3 > 0, k % 4), k % 2 * 2, F.when(k % 7 > 0, k % 6)]
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), ph.star_class_by_flags(*flags).alias("by_flags"), ph.star_class_by_score(F.when(k % 11 > 0, k % 101 / 100.0)).alias("by_score"))


@query("select c_custkey as id, cast(floor(c_acctbal + 0.5) as bigint) as near, cast(floor(c_custkey / 2.0 - 10 + 0.5) as bigint) as half_up, cast(round_even(c_custkey / 2.0 - 10, 0) as bigint) as half_even from customer")
def rounding(spark: SparkSession, d: str) -> DataFrame:
    half = F.col("c_custkey") / 2.0 - 10
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), v.round_half_up(F.col("c_acctbal")).alias("near"), v.round_half_up(half).alias("half_up"), F.bround(half).cast("long").alias("half_even"))


@query("select c_custkey as id, cast(c_custkey % 65536 as bigint) as n from customer")
def hex_columns(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("0x"), F.lower(F.hex(F.col("c_custkey") % 65536)))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), v.hex_to_int(text).alias("n"))


@query("""select o_orderkey as id, round(epoch_us(date_trunc('day', o_orderdate)) / 86400e6 + 40587 + (o_orderkey % 86400) / 86400.0, 6) as mjd from orders""")
def stamp_to_mjd(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("o_orderkey") % 86400
    text = F.concat(F.date_format("o_orderdate", "yyyyDDD"), F.format_string("%02d%02d%02d", F.expr("div(o_orderkey % 86400, 3600)"), F.expr("div(o_orderkey % 86400, 60) % 60"), s % 60))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), r(v.mjd_of_stamp(text)).alias("mjd"))


@query("""with t as (select o_orderkey as id, o_orderkey % 40 + 1 as m, o_orderkey % 4 as u from orders)
select id, case u when 0 then m || 'sec' when 1 then m || 'min' when 2 then m || 'hr' else m || 'days' end as bin, m * [1.0, 60.0, 3600.0, 86400.0][u + 1] as seconds,
 cast(floor(m * [1.0, 60.0, 3600.0, 86400.0][u + 1] / 1800 + 0.5) as int) as frames, cast(greatest(1, round_even(m * [1.0, 60.0, 3600.0, 86400.0][u + 1] / 1800, 0)) as int) as frames_least_one from t""")
def time_bins(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    unit = F.element_at(F.array(*[F.lit(u) for u in ("sec", "min", "hr", "days")]), (k % 4 + 1).cast("int"))
    t = table(spark, d, "orders").select(k.alias("id"), F.concat((k % 40 + 1).cast("string"), unit).alias("bin"))
    s = v.bin_seconds(F.col("bin"))
    return t.select("id", "bin", s.alias("seconds"), v.frames_in_bin(s, F.lit(1800.0), False).alias("frames"), v.frames_in_bin(s, F.lit(1800.0), True).alias("frames_least_one"))


@query("select s_suppkey as id, case when s_acctbal / 100 > -28 then 'PS1' else 'SkyMapper' end as survey, coalesce(nullif(cast(s_suppkey % 100 as double), 99.0), -1.0) as cleaned from supplier")
def survey_choice(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), sky.survey(F.col("s_acctbal") / 100).alias("survey"), F.coalesce(F.nullif((F.col("s_suppkey") % 100).cast("double"), F.lit(99.0)), F.lit(-1.0)).alias("cleaned"))


@query("""select page_id, cast(nullif(regexp_extract(url, '/(\\d+)', 1), '') as int) as number, regexp_extract(url, '//([^/]+)', 1) as host, cast(regexp_matches(url, '^https') as int) as secure,
 cast(nullif(regexp_extract('Sector12/Cam3/Ccd' || page_id % 4 || '/Cut' || page_id % 64 || 'of64', 'Ccd(\\d+)', 1), '') as int) as ccd, cast(page_id % 64 as int) as cut from pages""")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.sources.files import path_parts as parts

    p = table(spark, d, "pages")
    path = F.format_string("Sector12/Cam3/Ccd%d/Cut%dof64", F.col("page_id") % 4, F.col("page_id") % 64)
    got = p.select("page_id", "url", *parts(path))
    return got.select("page_id", F.regexp_extract("url", r"/(\d+)", 1).try_cast("int").alias("number"), F.regexp_extract("url", "//([^/]+)", 1).alias("host"), F.col("url").rlike("^https").cast("int").alias("secure"), "ccd", "cut")


@query("select vec_id, round(list_sum(list_transform(embedding, lambda x, i: cast(x as double) * (i % 5 - 2))), 5) as dot, list_position(embedding, list_max(embedding)) - 1 as peak, round(cast(list_max(embedding) as double), 6) as top from embeddings")
def dot_weights(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.operators.fit import dot

    e = table(spark, d, "embeddings")
    weights = [(i + 1) % 5 - 2 for i in range(64)]
    return e.select("vec_id", r(dot(F.col("embedding"), weights), 5).alias("dot"), (F.array_position("embedding", F.array_max("embedding")).cast("int") - 1).alias("peak"), r(F.array_max("embedding").cast("double")).alias("top"))


@query("select vec_id, round(list_avg(e), 6) as mean, round(list_stddev_pop(e), 6) as std, round(list_median(e), 6) as med from (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings)")
def array_stats(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    return e.groupBy("vec_id").agg(r(F.avg("x")).alias("mean"), r(F.stddev_pop("x")).alias("std"), r(F.median("x")).alias("med"))


@query("""with p as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as i from embeddings)
select vec_id, round(sum(x), 5) as box from p where i // 8 between 2 and 4 and i % 8 between 3 and 5 group by 1""")
def box_sums(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.operators.detect import box_sum

    return table(spark, d, "embeddings").select("vec_id", r(box_sum(F.col("embedding"), 4, 3, 8, 8), 5).alias("box"))


@query("""with p as (select vec_id, unnest(embedding)::double as x from embeddings), m as (select vec_id, median(x) as m from p group by 1)
select vec_id as frame, round(median(abs(x - m)) * 1.4826, 6) as noise from p join m using (vec_id) group by 1""")
def frame_noise(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.operators.detect import frame_noise as noise

    return noise(table(spark, d, "embeddings").select(F.col("vec_id").alias("frame"), F.col("embedding").alias("img"))).withColumn("noise", r("noise"))


@query("select vec_id, cast(embedding[vec_id % 8 * 8 + vec_id % 5 + 1] as double) as at, cast(embedding[28] as double) as fixed from embeddings")
def pixel_gather(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.operators.detect import pixel

    e = table(spark, d, "embeddings")
    return e.select("vec_id", pixel(F.col("embedding"), F.col("vec_id") % 5, F.col("vec_id") % 8, F.lit(8)).cast("double").alias("at"), pixel(F.col("embedding"), F.lit(3), F.lit(3), F.lit(8)).cast("double").alias("fixed"))


@query("select event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '.000' as iso from events")
def mjd_to_iso(spark: SparkSession, d: str) -> DataFrame:
    """Whole seconds to days and back."""
    ev = table(spark, d, "events").select("event_id", v.mjd(F.date_trunc("second", "ts")).alias("m"))
    return ev.select("event_id", v.iso_of_mjd(F.col("m")).alias("iso"))
