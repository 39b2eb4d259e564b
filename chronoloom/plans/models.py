"""Queries of models and periods; where SQL can't express them they are tested against numpy and planted truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.operators import detect, fit, periods
from chronoloom.plans.registry import query, r, table


@query()
def bazin_fit(spark: SparkSession, d: str) -> DataFrame:
    """A rise and fall fitted to each user's daily totals."""
    day = F.expr("div(timestampdiff(microsecond, timestamp_ntz'2024-01-01 00:00:00', ts), 86400000000)").cast("double")
    daily = table(spark, d, "events").groupBy("user_id", day.alias("day")).agg(F.sum("value").alias("flux"))
    return fit.fit_bazin(daily, ["user_id"], "day", "flux")


@query()
def gauss_r2(spark: SparkSession, d: str) -> DataFrame:
    day = F.expr("div(timestampdiff(microsecond, timestamp_ntz'2024-01-01 00:00:00', ts), 86400000000)").cast("double")
    daily = table(spark, d, "events").groupBy("user_id", day.alias("day")).agg(F.sum("value").alias("flux"))
    return fit.gaussian_score(daily, ["user_id"], "day", "flux")


def _hours(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("hour", F.expr("timestampdiff(microsecond, timestamp_ntz'2024-01-01 00:00:00', ts)") / 3600e6)


@query()
def fourier_period(spark: SparkSession, d: str) -> DataFrame:
    return periods.fourier_period(_hours(spark, d), ["user_id"], "hour", "value")


@query("""with ev as (select user_id, (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 3600e6 as hour, value from events),
s as (select user_id, count(*) as n, min(hour) as t0, max(hour) - min(hour) as span, avg(value) as mean, var_pop(value) as var from ev group by 1 having count(*) >= 9 and max(hour) > min(hour) and var_pop(value) > 0),
f as (select user_id, unnest(range(cast(floor((n / 2.0 - 1) * 2) as bigint) + 1)) as k from s),
p as (select user_id, k, n, var, 1 / span + k / (span * 2) as frequency, 2 * pi() * (1 / span + k / (span * 2)) * (hour - t0) as x, value - mean as u from ev join s using (user_id) join f using (user_id)),
q as (select user_id, k, any_value(n) as n, any_value(var) as var, any_value(frequency) as frequency, sum(u * cos(x)) as uc, sum(u * sin(x)) as us, sum(cos(x) ** 2) as cc, sum(sin(x) ** 2) as ss, sum(sin(x) * cos(x)) as cs from p group by 1, 2)
select user_id, k, round(frequency, 6) as frequency, round((uc * uc * ss + us * us * cc - 2 * uc * us * cs) / (cc * ss - cs * cs) / (n * var), 6) as power from q""")
def periodogram(spark: SparkSession, d: str) -> DataFrame:
    out = periods.periodogram(_hours(spark, d), ["user_id"], "hour", "value", oversample=2)
    return out.withColumns({"frequency": r("frequency"), "power": r("power")})


@query()
def periodogram_peaks(spark: SparkSession, d: str) -> DataFrame:
    """Peaks of each user's periodogram, in signals and harmonics."""
    return periods.peaks(periods.periodogram(_hours(spark, d), ["user_id"], "hour", "value"), ["user_id"])


@query()
def detect_sources(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as 8 x 8 frames."""
    frames = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame"), F.lit(8).alias("ny"), F.lit(8).alias("nx"), F.col("embedding").alias("img"))
    return detect.detect(frames, level=3.0)


@query()
def rf_classify(spark: SparkSession, d: str) -> DataFrame:
    """Order priorities predicted from simple columns by a random forest."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), (F.col("o_custkey") % 97).cast("double").alias("c"), (F.col("o_orderstatus") == "O").cast("double").alias("label"), F.dayofyear("o_orderdate").cast("double").alias("day"), F.year("o_orderdate").cast("double").alias("year"))
    held = F.pmod(F.xxhash64("o_orderkey"), F.lit(100)) < 15
    return fit.forest(o.filter(~held), o.filter(held), ["price", "c", "day", "year"], "label", trees=20).select("o_orderkey", "label", "prediction", "confidence")


@query()
def whitened_features(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return fit.whitened(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).select("l_orderkey", "l_linenumber", F.size("whitened").alias("n_axes"), F.round(F.get("whitened", F.lit(0)), 6).alias("first_axis"))
