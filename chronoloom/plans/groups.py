"""Queries of groups, robust statistics, sets and pivots over the trade tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.operators import resolve, robust, rollup
from chronoloom.plans.registry import query, r, table


@query("""with m as (select l_returnflag, l_linestatus, median(l_extendedprice) as med from lineitem group by 1, 2)
select l_returnflag, l_linestatus, round(max(med), 6) as median, round(median(abs(l_extendedprice - med)) * 1.4826, 6) as sigma, count(l_extendedprice) as n from lineitem join m using (l_returnflag, l_linestatus) group by 1, 2""")
def mad_by_group(spark: SparkSession, d: str) -> DataFrame:
    out = robust.mad_by_group(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return out.select("l_returnflag", "l_linestatus", r("median").alias("median"), r("sigma").alias("sigma"), "n")


@query("select l_returnflag, round(2.5 * log10(median(pow(10, 0.4 * (20 + l_discount)))), 6) as zp, count(*) as n from lineitem group by 1")
def linear_median(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(r(robust.linear_median(20 + F.col("l_discount"))).alias("zp"), F.count("*").alias("n"))


CLIP = "k{i} as (select t.* from k{j} t join (select l_returnflag, median(p) as m, stddev_pop(p) as s from k{j} group by 1) u using (l_returnflag) where abs(p - m) < 1.5 * s)"


@query("with k0 as (select l_orderkey, l_linenumber, l_returnflag, l_extendedprice as p from lineitem), " + ", ".join(CLIP.format(i=i, j=i - 1) for i in (1, 2, 3)) + " select l_returnflag, count(*) as n, round(avg(p), 4) as mean, round(stddev_pop(p), 4) as std from k3 group by 1")
def sigma_clip_k3(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("p"))
    kept = robust.sigma_clip(li, ["l_returnflag"], "p", 1.5, 3).filter("kept")
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("n"), r(F.avg("p"), 4).alias("mean"), r(F.stddev_pop("p"), 4).alias("std"))


@query("""with m as (select l_returnflag, median(l_quantity) as med from lineitem where l_quantity > 0 group by 1)
select l_orderkey, l_linenumber from lineitem join m using (l_returnflag) where l_quantity > 0 and l_quantity <= 1.2 * med and l_quantity <= 29""")
def err_mask(spark: SparkSession, d: str) -> DataFrame:
    return robust.error_mask(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", 1.2, 29.0).select("l_orderkey", "l_linenumber")


INVVAR = """with v as (select l_orderkey as k, l_extendedprice as x, 1 + l_quantity as e from lineitem),
m as (select k, sum(x / (e * e)) / sum(1 / (e * e)) as mean, sqrt(1 / sum(1 / (e * e))) as mean_err, count(*) as n, stddev_samp(x) as s from v group by 1),
c as (select m.k, sum(pow((x - mean) / e, 2)) as x2 from v join m using (k) group by 1),
f as (select *, case n when 2 then 0.7978845608 when 3 then 0.8862269255 when 4 then 0.9213177319 when 5 then 0.9399856030 else case when n >= 6 then 1 - 1 / (4 * (n - 1.0)) + 1 / (32 * pow(n - 1.0, 2)) + 5 / (128 * pow(n - 1.0, 3)) end end as c4 from m)
select k, round(mean, 4) as mean, round(mean_err, 6) as mean_err, n, round(s / c4, 4) as stdev, round(s / c4 / sqrt(n), 4) as stderr, round(case when n > 1 then x2 / (n - 1) end, 3) as chi2_norm from f join c using (k)"""


@query(INVVAR)
def invvar_mean(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("x"), (1 + F.col("l_quantity")).alias("e"))
    out = robust.inverse_variance_mean(li, ["k"], "x", "e")
    return out.select("k", r("mean", 4).alias("mean"), r("mean_err").alias("mean_err"), "n", r("stdev", 4).alias("stdev"), r("stderr", 4).alias("stderr"), r("chi2_norm", 3).alias("chi2_norm"))


SIGCUT = """with v as (select o_custkey as k, o_totalprice as x from orders), c as (select k, median(x) as c from v group by 1), r as (select v.*, abs(x - c) as r from v join c using (k)),
l as (select k, quantile_cont(r, 0.8) as l, count(*) as n from r group by 1), k0 as (select r.k, x, r <= l or n < 3 as keep from r join l using (k))"""
PASS = ", s{i} as (select k, avg(x) filter (where keep) as m, stddev_samp(x) filter (where keep) as s, count(*) filter (where keep) as n from k{j} group by 1), k{i} as (select k{j}.k, x, case when n >= 3 then coalesce(abs(x - m) <= 2 * s, keep) else keep end as keep from k{j} join s{i} using (k))"


@query(SIGCUT + PASS.format(i=1, j=0) + PASS.format(i=2, j=1) + " select k, round(avg(x) filter (where keep), 6) as mean, round(stddev_samp(x) filter (where keep), 4) as stdev, count(*) filter (where keep) as n_kept, count(*) filter (where not keep) as n_cut from k2 group by 1")
def sigma_cut_mean(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("x"))
    out = robust.sigma_cut_mean(o, ["k"], "x", 2.0, passes=2)
    return out.select("k", r("mean", 6).alias("mean"), r("stdev", 4).alias("stdev"), "n_kept", "n_cut")


BINS = """with v as (select l_returnflag as g, l_quantity / 5 as m, 20 + l_discount * 10 + l_tax as z from lineitem), b as (select *, cast(floor(m / 0.5) as bigint) as bin from v),
q as (select g, bin, 2.5 * log10(median(pow(10, 0.4 * z))) as zp, count(*) as n, stddev_pop(z) as s from b group by 1, 2),
d as (select g, bin, median(abs(z - zp)) * 1.4826 as mad from b join q using (g, bin) group by 1, 2),
z as (select g, bin, zp, n, case when mad > 0 then mad else s end as scatter from q join d using (g, bin) where n >= 5)"""


@query(BINS + " select g, bin, round(zp, 6) as zp, n, round(scatter, 6) as scatter from z")
def binned_robust(spark: SparkSession, d: str) -> DataFrame:
    return _zeropoints(spark, d)[0].select("g", "bin", r("zp").alias("zp"), "n", r("scatter").alias("scatter"))


@query(BINS + """ , j as (select g, sum(n / (scatter * scatter) * zp) / sum(n / (scatter * scatter)) as zp, sqrt(1 / sum(n / (scatter * scatter))) as e_zp, count(*) as n_bins from z group by 1)
select g, round(zp, 6) as zp, round(e_zp, 6) as e_zp, n_bins, (select count(*) from v where v.g = j.g) as n_stars from j""")
def combined_zeropoint(spark: SparkSession, d: str) -> DataFrame:
    return _zeropoints(spark, d)[1].select("g", r("zp").alias("zp"), r("e_zp").alias("e_zp"), "n_bins", "n_stars")


def _zeropoints(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("g"), (F.col("l_quantity") / 5).alias("m"), (20 + F.col("l_discount") * 10 + F.col("l_tax")).alias("z"))
    return robust.binned_zeropoint(li, ["g"], "m", "z", 0.5)


@query("select l_partkey, count(*) as n, round(quantile_cont(l_extendedprice, 0.68), 4) as p68, round(quantile_cont(l_extendedprice, 0.05), 4) as p05 from lineitem group by 1")
def percentiles(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    large = robust.has_large(li, ["l_partkey"], "l_extendedprice")
    high, low = (robust.quantile(li, ["l_partkey"], "l_extendedprice", p, out=out, large=large) for p, out in ((0.68, "p68"), (0.05, "p05")))
    return high.join(low.drop("n"), "l_partkey").select("l_partkey", "n", r("p68", 4).alias("p68"), r("p05", 4).alias("p05"))


@query("""with s as (select l_suppkey, floor(4 * log10(l_extendedprice)) as b, abs(l_discount - 0.05) as r from lineitem)
select cast(b as bigint) as b, count(*) as n, round(quantile_cont(r, 0.68), 6) as spread from s group by 1""")
def log_binned_spread(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.floor(4 * F.log10("l_extendedprice")).cast("long").alias("b"), F.abs(F.col("l_discount") - 0.05).alias("r"))
    return robust.quantile(li, ["b"], "r", 0.68, out="spread").select("b", "n", r("spread").alias("spread"))


@query("""with f as (select l_linenumber as frame, l_returnflag || l_linestatus as block, median(l_quantity) as m from lineitem group by 1, 2), p as (select block, quantile_cont(m, 0.5) as lim from f group by 1),
s as (select frame, sum(m) as score, bool_and(m <= lim) as ok from f join p using (block) group by 1)
select frame, score, ok, cast(row_number() over (order by ok desc, score, frame) as int) as k from s""")
def best_frames(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    li = table(spark, d, "lineitem").select(F.col("l_linenumber").alias("frame"), F.concat("l_returnflag", "l_linestatus").alias("block"), "l_quantity")
    f = robust.quantile(li, ["frame", "block"], "l_quantity", out="m").drop("n")
    p = f.groupBy("block").agg(F.percentile("m", F.lit(0.5)).alias("lim"))
    s = f.join(p, "block").groupBy("frame").agg(F.sum("m").alias("score"), F.bool_and(F.col("m") <= F.col("lim")).alias("ok"))
    return s.withColumn("k", F.row_number().over(Window.orderBy(F.desc("ok"), "score", "frame")))  # one row for each frame number


@query("""with k as (select *, row_number() over (partition by l_suppkey, l_returnflag order by l_orderkey, l_linenumber, l_quantity) as rn from lineitem)
select l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_quantity from k where rn = 1""")
def first_match_dedup(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return resolve.first_per_key(li, ["l_suppkey", "l_returnflag"], ["l_orderkey", "l_linenumber", "l_quantity"])


@query("""with f as (select l_returnflag, l_linestatus, l_linenumber, min((l_orderkey, l_linenumber)) as f from lineitem group by all), c as (select *, cast(row_number() over (order by f, l_returnflag, l_linestatus, l_linenumber) as int) as code from f)
select l_orderkey, l.l_linenumber, code from lineitem l join c using (l_returnflag, l_linestatus, l_linenumber)""")
def factorise_key(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").withColumn("n", F.col("l_linenumber"))
    return resolve.factorise(li, ["l_returnflag", "l_linestatus", "n"], ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "code")


@query("""select 'union' as op, k from (select c_custkey as k from customer union select o_custkey from orders) union all
select 'intersect', k from (select c_custkey as k from customer intersect select o_custkey from orders) union all
select 'except', k from (select c_custkey as k from customer except select o_custkey from orders)""")
def set_ops(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sets(spark, d)
    named = lambda n, df: df.select(F.lit(n).alias("op"), "k")
    return named("union", a.union(b).distinct()).union(named("intersect", a.intersect(b))).union(named("except", a.subtract(b)))


@query("""with a as (select distinct c_custkey as k from customer), b as (select distinct o_custkey as k from orders)
select k from a where k not in (select k from b) union all select k from b where k not in (select k from a)""")
def sym_diff(spark: SparkSession, d: str) -> DataFrame:
    return resolve.symmetric_difference(*_sets(spark, d))


def _sets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k"))


@query("select o_orderpriority, min(o_orderkey) as first from orders group by 1")
def unique_in_order(spark: SparkSession, d: str) -> DataFrame:
    return resolve.unique_in_order(table(spark, d, "orders"), "o_orderpriority", "o_orderkey")


@query("""with t as (select (c_nationkey % 16) // 4 as row, (c_nationkey % 16) % 4 as col, c_acctbal from customer)
select row, round(median(c_acctbal) filter (where col = 0), 4) as "0", round(median(c_acctbal) filter (where col = 1), 4) as "1", round(median(c_acctbal) filter (where col = 2), 4) as "2", round(median(c_acctbal) filter (where col = 3), 4) as "3" from t group by 1""")
def pivot_grid(spark: SparkSession, d: str) -> DataFrame:
    return rollup.grid_pivot(table(spark, d, "customer"), F.col("c_nationkey") % 16, 4, r(F.median("c_acctbal"), 4))


@query("""with t as (select (15 - s_nationkey % 16) // 4 as row, (15 - s_nationkey % 16) % 4 as col from supplier)
select row, nullif(count(*) filter (where col = 0), 0) as "0", nullif(count(*) filter (where col = 1), 0) as "1", nullif(count(*) filter (where col = 2), 0) as "2", nullif(count(*) filter (where col = 3), 0) as "3" from t group by 1""")
def pivot_rotated(spark: SparkSession, d: str) -> DataFrame:
    return rollup.grid_pivot(table(spark, d, "supplier"), F.col("s_nationkey") % 16, 4, F.count(F.lit(1)), rotate=True)


@query("""select l_orderkey, l_linenumber, case when l_tax > 0 then 'tax' when l_discount > 0 then 'discount' when l_quantity - 25 > 0 then 'quantity' end as kind,
 case when l_tax > 0 then l_tax when l_discount > 0 then l_discount when l_quantity - 25 > 0 then l_quantity - 25 end as prob from lineitem""")
def last_positive(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 25).alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    kind, prob = rollup.last_positive(["quantity", "discount", "tax"])
    return li.select("l_orderkey", "l_linenumber", kind.alias("kind"), prob.alias("prob"))


@query("""with s as (select l_suppkey, l_quantity as x, l_extendedprice as y from lineitem)
select l_suppkey, round(regr_slope(y, x), 4) as slope, round(regr_intercept(y, x), 3) as intercept, round(sqrt((regr_syy(y, x) - pow(regr_sxy(y, x), 2) / regr_sxx(y, x)) / count(*)), 3) as rms, count(*) as n from s group by 1""")
def line_fit(spark: SparkSession, d: str) -> DataFrame:
    from chronoloom.operators.fit import line

    out = line(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice")
    return out.select("l_suppkey", r("slope", 4).alias("slope"), r("intercept", 3).alias("intercept"), r("rms", 3).alias("rms"), "n")


@query("""with o as (select o_custkey, o_orderdate, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) as k from orders)
select c_custkey, coalesce(n_name, '-') as nation, o_orderkey as last_order from customer left join nation on n_nationkey = c_nationkey left join o on o_custkey = c_custkey and k = 1""")
def lookup_join(spark: SparkSession, d: str) -> DataFrame:
    last = table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", -F.col("o_orderkey"))).alias("last_order"))
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    out = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(last, c["c_custkey"] == last["o_custkey"], "left")
    return out.select("c_custkey", F.coalesce("n_name", F.lit("-")).alias("nation"), "last_order")


@query("select c_mktsegment, count(*) as n, round(sum(case when exists (select 1 from orders where o_custkey = c_custkey) then c_acctbal else 0 end), 4) as active from customer group by 1")
def semi_join_total(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    active = c.join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("active"))
    return c.groupBy("c_mktsegment").agg(F.count("*").alias("n")).join(active, "c_mktsegment", "left").select("c_mktsegment", "n", r(F.coalesce("active", F.lit(0.0)), 4).alias("active"))


@query("""with a as (select c_custkey as k, c_acctbal as v from customer), b as (select p_partkey as k, p_retailprice as v from part)
select coalesce(a.k, b.k) as k, coalesce(a.v, b.v) as v, cast(a.k is not null as int) as in_a, cast(b.k is not null as int) as in_b from a full join b on a.k = b.k""")
def prefer_first(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.lit(1).alias("in_a"))
    b = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("w"), F.lit(1).alias("in_b"))
    return a.join(b, "k", "full_outer").select("k", F.coalesce("v", "w").alias("v"), F.coalesce("in_a", F.lit(0)).alias("in_a"), F.coalesce("in_b", F.lit(0)).alias("in_b"))


@query("select p_brand, p_partkey, p_retailprice, cast(k as int) as k from (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as k from part) where k <= 5")
def top_of_group(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return table(spark, d, "part").withColumn("k", F.row_number().over(w)).filter("k <= 5").select("p_brand", "p_partkey", "p_retailprice", "k")


@query("""with t as (select l_suppkey as g, l_quantity / 50 as q from lineitem), c as (select g, i, count(*) filter (where q >= 0.9 - 0.05 * i) as n from t, range(12) s(i) group by all),
b as (select g, min(i) as i from c where n >= 30 group by 1) select g, round(0.9 - 0.05 * b.i, 6) as threshold, n from b join c using (g, i)""")
def relaxed_threshold(spark: SparkSession, d: str) -> DataFrame:
    """For each group the strictest threshold of a grid that leaves enough rows: one pass with a count for each step."""
    q = F.col("l_quantity") / 50
    steps = [F.count(F.when(q >= 0.9 - 0.05 * i, 1)).alias(f"n{i}") for i in range(12)]
    counts = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("g")).agg(*steps)
    first = F.coalesce(*[F.when(F.col(f"n{i}") >= 30, F.struct(F.lit(0.9 - 0.05 * i).alias("threshold"), F.col(f"n{i}").alias("n"))) for i in range(12)])
    return counts.select("g", first.alias("s")).filter("s is not null").select("g", r("s.threshold").alias("threshold"), "s.n")
