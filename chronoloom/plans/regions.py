"""Queries of error regions on detectors, straight lines in stamps, and how normal a series is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.functions.values import NORMAL_QUANTILE
from chronoloom.operators import detect, regions, series
from chronoloom.plans.points import POINTS, stars
from chronoloom.plans.registry import query, r, table


def _ring(spark: SparkSession, d: str, points: int, least: int, step: int) -> DataFrame:
    """Vertices of a region around each star; its size goes by its id."""
    a, size = 2 * F.pi() * F.col("k") / points, least + F.col("id") % 5 * step
    ring = stars(spark, d).select("id", "x", "y").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return ring.select("id", "k", (F.col("x") + size * F.cos(a)).alias("x"), (F.col("y") + size * F.sin(a)).alias("y"))


@query(POINTS + """, c as (select i as box, i % 8 * 125.0 as x0, i // 8 * 125.0 as y0 from range(64) t(i)),
v as (select s.id, k, s.x + (30 + s.id % 5 * 60) * cos(2 * pi() * k / 12) as x, s.y + (30 + s.id % 5 * 60) * sin(2 * pi() * k / 12) as y from stars s, range(12) t(k)),
p as (select distinct id, box from v, c where x > x0 and x < x0 + 125 and y > y0 and y < y0 + 125),
e as (select a.id, a.x, a.y, b.x as xn, b.y as yn from v a join v b on a.id = b.id and b.k = (a.k + 1) % 12 where a.y <> b.y),
h as (select id, box from e, c where (y > y0 + 62.5) <> (yn > y0 + 62.5) and x0 + 62.5 < (xn - x) * (y0 + 62.5 - y) / (yn - y) + x group by 1, 2 having count(*) % 2 = 1)
select id, box, 'passed' as how from p union all select id, box, 'inside' from h anti join p using (id, box)""")
def impacted_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Cuts that each star's region touches, small and large."""
    x0, y0 = (F.col("id") % 8 * 125).cast("double"), (F.floor(F.col("id") / 8) * 125).cast("double")
    boxes = spark.range(64).select(F.col("id").alias("box"), x0.alias("x0"), y0.alias("y0"), (x0 + 125).alias("x1"), (y0 + 125).alias("y1"), (x0 + 62.5).alias("cx"), (y0 + 62.5).alias("cy"))
    return regions.impacted_boxes(_ring(spark, d, 12, 30, 60), boxes, "id", "k", 125.0)


def _reached_sql() -> str:
    """The mosaic by its rule: a place is (row, column); the upper row of each camera is turned."""
    place = lambda row, col: f"case when {row} // 2 < 2 then case when {row} % 2 = 0 then 4 - {col} else 1 + {col} end else case when {row} % 2 = 0 then 2 - {col} else 3 + {col} end end"
    beyond = "case sx when -1 then x <= 0 when 0 then x >= 0 and x <= 1000 else x >= 1000 end and case sy when -1 then y <= 0 when 0 then y >= 0 and y <= 900 else y >= 900 end"
    edge = "(sx = 0 or case sx when -1 then min(x) < 0 else max(x) > 1000 end) and (sy = 0 or case sy when -1 then min(y) < 0 else max(y) > 900 end)"
    return POINTS + f""", v as (select s.id, s.x + (100 + s.id % 5 * 150) * cos(2 * pi() * k / 36) as x, s.y + (100 + s.id % 5 * 150) * sin(2 * pi() * k / 36) as y from stars s, range(36) t(k)),
s as (select a.i::int - 1 as sx, b.i::int - 1 as sy from range(3) a(i), range(3) b(i) where a.i <> 1 or b.i <> 1),
g as (select id, sx, sy, coalesce((max(x) filter ({beyond}) - min(x) filter ({beyond})) * (max(y) filter ({beyond}) - min(y) filter ({beyond})), 0) as size, {edge} as hit from v, s group by 1, 2, 3),
m as (select row, col, {place("row", "col")} as ccd, row // 2 as c from (select r.i as row, k.i as col from range(8) r(i), range(2) k(i))),
o as (select g.*, row, col, case when row % 2 = 0 then -1 else 1 end as turn from g join m on m.ccd = g.id // 4 % 4 + 1 and m.c = case when g.id % 3 = 0 then 3 - g.id % 4 else g.id % 4 end where hit)
select o.id, (case when o.id % 3 = 0 then 4 - n.c else n.c + 1 end)::int as next_camera, n.ccd::int as next_ccd, sx, sy, round(size, 4) as size, size > 10000 as enough from o join m n on n.row = o.row - turn * sy and n.col = o.col + turn * sx"""


@query(_reached_sql())
def reached_detectors(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring detectors that each star's region reaches."""
    i = F.col("id")
    v = _ring(spark, d, 36, 100, 150).withColumns({"north": i % 3 == 0, "camera": (i % 4 + 1).cast("int"), "ccd": (F.floor(i / 4) % 4 + 1).cast("int")})
    return regions.reached_detectors(v, ["id"], "north", "camera", "ccd", 1000, 900).withColumn("size", r("size", 4))


def _lines_sql(rounds: int = 10) -> str:
    sql = """with e as (select vec_id, embedding[37]::double as c, embedding from embeddings where embedding[37] <> 0), p as (select vec_id, unnest(range(64)) as p, unnest(embedding)::double as v, c from e),
k0 as (select vec_id, p, least(255.0, v / c * 255) as v from p)"""
    for i in range(1, rounds + 1):
        sql += f", s{i} as (select vec_id, median(v) as m, stddev_pop(v) as s from k{i - 1} group by 1), k{i} as (select k.* from k{i - 1} k join s{i} using (vec_id) where v >= m - 3 * s and v <= m + 2 * s)"
    return sql + f""", f as (select vec_id, median(v) as m, stddev_pop(v) as s from k{rounds} group by 1), b as (select vec_id, p % 8 as x, p // 8 as y from k0 join f using (vec_id) where v > m + 1.0 * s),
h as (select vec_id, a::int as angle, floor(x * cos(radians(a)) + y * sin(radians(a)) + 0.5 + 1e-7)::int as distance, case when sin(radians(a)) > abs(cos(radians(a))) + 1e-7 then x else y end as pos from b, range(180) t(a)),
n as (select vec_id, angle, distance, count(*) as votes from h group by 1, 2, 3 having count(*) >= 6), u as (select distinct vec_id, angle, distance, pos from h semi join n using (vec_id, angle, distance)),
i as (select *, pos - row_number() over (partition by vec_id, angle, distance order by pos) as island from u), l as (select vec_id, angle, distance, island, count(*) - 1 as length from i group by 1, 2, 3, 4)
select vec_id, angle, distance, any_value(votes) as votes, max(length)::int as length from l join n using (vec_id, angle, distance) group by 1, 2, 3 having max(length) >= 4"""


@query(_lines_sql())
def straight_lines(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as stamps of 8 x 8 pixels: lines through what is bright."""
    e = table(spark, d, "embeddings").select("vec_id", detect.bright_mask(F.col("embedding"), 36, level=1.0).alias("mask"))
    return detect.straight_lines(e, ["vec_id"], "mask", 8, votes=6, shortest=4)


def _ratio(part: str, x: str) -> str:
    """The quotient of two polynomials as SQL."""
    over, under = ("(" * len(c) + f"{c[-1]!r})" + "".join(f" * {x} + {k!r})" for k in c[-2::-1]) for c in NORMAL_QUANTILE[part])
    return f"{over} / {under}"


def _shapiro_sql() -> str:
    """Ranks, their normal scores, and the two outer weights on each side."""
    score = f"case when abs(q) <= 0.425 then q * ({_ratio('middle', '(0.180625 - q * q)')}) else sign(q) * (case when t <= 5 then {_ratio('tail', '(t - 1.6)')} else {_ratio('far', '(t - 5)')} end) end"
    return f"""with r as (select user_id, value as v, row_number() over w as i, count(*) over (partition by user_id) as n, avg(value) over (partition by user_id) as mean from events window w as (partition by user_id order by value)),
p as (select *, (i - 0.375) / (n + 0.25) - 0.5 as q, sqrt(-ln(least((i - 0.375) / (n + 0.25), 1 - (i - 0.375) / (n + 0.25)))) as t from r), m as (select user_id, n, i, v - mean as v, {score} as m from p),
s as (select user_id, n, sum(v * v) as ss, sum(m * m) as mm, max(m) as top, max(m) filter (i = n - 1) as nxt, 1 / sqrt(n) as u from m group by 1, 2 having count(*) > 5 and max(v) > min(v)),
a as (select *, -2.706056 * u ** 5 + 4.434685 * u ** 4 - 2.071190 * u ** 3 - 0.147981 * u ** 2 + 0.221157 * u + top / sqrt(mm) as a1, -3.582633 * u ** 5 + 5.682633 * u ** 4 - 1.752461 * u ** 3 - 0.293762 * u ** 2 + 0.042981 * u + nxt / sqrt(mm) as a2 from s),
w as (select *, (mm - 2 * top * top - 2 * nxt * nxt) / (1 - 2 * a1 * a1 - 2 * a2 * a2) as phi from a)
select m.user_id, w.n, round(least(1, sum(v * case when i = 1 then -a1 when i = m.n then a1 when i = 2 then -a2 when i = m.n - 1 then a2 else m / sqrt(phi) end) ** 2 / any_value(ss)), 6) as shapiro_w from m join w using (user_id) group by 1, 2"""


@query(_shapiro_sql())
def shapiro_w(spark: SparkSession, d: str) -> DataFrame:
    """How normal the values of each user with more than five are."""
    return series.shapiro_w(table(spark, d, "events"), ["user_id"], "value").filter("n > 5 and shapiro_w is not null").withColumn("shapiro_w", r("shapiro_w"))
