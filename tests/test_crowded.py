"""Joins of crowded places: equal to plain loops, and no work for each pair of points."""

import math

import numpy as np
import pytest

from chronoloom.operators import clusters, spatial


def _points(spark, n, width, seed, first=0):
    xy = np.round(np.random.default_rng(seed).uniform(0, width, (n, 2)), 2)
    return xy, spark.createDataFrame([(first + i, float(x), float(y), float(i * 7 % 10)) for i, (x, y) in enumerate(xy)], "id long, x double, y double, mag double")


def _apart(a, b):
    return np.hypot(a[:, None, 0] - b[None, :, 0], a[:, None, 1] - b[None, :, 1])


@pytest.mark.parametrize("width", [6.0, 30.0, 120.0])
def test_nearest_and_least_agree_with_loops(spark, width):
    (p, left), (q, right) = _points(spark, 500, width, 1), _points(spark, 700, width, 2)
    d = _apart(p, q)
    want = {i: int(d[i].argmin()) for i in range(500) if d[i].min() < 5}
    assert {r.l_id: r.r_id for r in spatial.nearest(left, right, 5.0, "id", ["id"]).collect()} == want
    least = {i: int(np.flatnonzero(d[i] <= 5)[-1]) for i in range(500) if (d[i] <= 5).any()}
    from pyspark.sql import functions as F

    assert {r.l_id: r.r_id for r in spatial.best_in_range(left, right, 5.0, "id", [-F.col("r_id")]).collect()} == least
    best = spatial.closest(left, right, 5.0, "id").collect()
    i, j = divmod(int(d.argmin()), 700)
    assert [(r.l_id, r.r_id) for r in best] == ([(i, j)] if d.min() <= 5 else [])
    own = _apart(p, p) + np.where(np.eye(500), np.inf, 0)
    near = {r.id: r.min_dist for r in spatial.self_nearest(left, 5.0, "id").collect()}
    assert all(near[i] == (pytest.approx(own[i].min()) if own[i].min() <= 5 else None) for i in range(500))
    mag = np.arange(500) * 7 % 10
    alone = {i for i in range(500) if not ((own[i] > 1) & (own[i] < 5) & (mag < mag[i] + 1)).any()}
    assert {r.id for r in spatial.isolated(left, 5.0, "id", "mag", 1.0, 1.0).collect()} == alone


@pytest.mark.parametrize("width", [8.0, 60.0, 90.0])
def test_groups_and_clusters_agree_with_loops(spark, width):
    p, df = _points(spark, 300, width, 3)
    near = _apart(p, p) <= 3

    def reach(of):
        name = np.where(of, np.arange(300), 300)
        while True:
            new = np.where(of, np.minimum(name, np.where(near & of[None, :], name[None, :], 300).min(axis=1)), 300)
            if (new == name).all():
                return name
            name = new

    assert {r.id: r.group for r in spatial.groups(df, 3.0, "id").collect()} == dict(enumerate(reach(np.full(300, True)).tolist()))
    core = near.sum(axis=1) >= 4
    name = reach(core)
    border = np.where(near & core[None, :], name[None, :], 300).min(axis=1)
    want = {i: int(name[i]) if core[i] else int(border[i]) if border[i] < 300 else None for i in range(300)}
    assert {r.id: r.cluster for r in clusters.density_clusters(df, 3.0, 4, "id").collect()} == want


def test_a_crowd_is_not_compared_point_by_point(spark):
    """40,000 points in less than a radius: 1.6e9 pairs."""
    df = spark.range(40000).selectExpr("id", "id % 200 / 100.0D as x", "div(id, 200) / 100.0D as y", "1.0D as mag")
    assert [r.group for r in spatial.groups(df, 5.0, "id").select("group").distinct().collect()] == [0]
    assert [r.cluster for r in clusters.density_clusters(df, 5.0, 3, "id").select("cluster").distinct().collect()] == [0]
    assert {round(r.min_dist, 9) for r in spatial.self_nearest(df, 5.0, "id").select("min_dist").distinct().collect()} == {0.01}


def test_listed_sides_are_not_broadcast(spark):
    df = spark.range(100).selectExpr("id", "id * 1.0D as x", "id * 1.0D as y")
    assert "Broadcast" not in spatial.within(df, df, 2.0)._jdf.queryExecution().executedPlan().toString()
    assert math.isclose(spatial.within(df, df, 2.0).filter("l_id < r_id").first().distance, math.sqrt(2))


def test_neighbour_lists_are_made_in_cells_and_crowded_ones_dealt(spark, monkeypatch):
    monkeypatch.setattr(spatial, "DEAL", 500)
    monkeypatch.setattr(clusters, "PAIRS", 64)
    monkeypatch.setattr(clusters, "within", None)  # its pairs were shuffled by point
    xy, df = _points(spark, 300, 30.0, 4)
    odd = spark.createDataFrame([(1000, None, 1.0, 0.0), (None, 1.0, 1.0, 0.0)], df.schema)
    got = {r.id: r.near for r in clusters.neighbours(df.union(odd), 5.0, "id").collect()}
    d = _apart(xy, xy)
    assert got == {i: [j for j in range(300) if j != i and d[i, j] <= 5] for i in range(300)} | {1000: [], None: []}


def test_cones_at_a_pole_are_dealt_over_several_tasks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    left, right = ([(i, float(ra), float(dec)) for i, (ra, dec) in enumerate(zip(rng.uniform(0, 360, n), rng.uniform(85, 90, n)))] for n in (200, 150))
    a, b = (spark.createDataFrame(rows, "id long, ra double, dec double") for rows in (left, right))
    want = sorted((r.l_id, r.r_id) for r in spatial.sky_within(a, b, 4.0).collect())
    monkeypatch.setattr(spatial, "DEAL", 300)
    got = spatial.sky_within(a, b, 4.0)
    assert sorted((r.l_id, r.r_id) for r in got.collect()) == want and len(want) > 10_000
    x, y = spatial.dealt(a.withColumn("c", spatial.F.lit(1)), b.withColumn("c", spatial.F.lit(1)), ["c"])
    assert x.select("_deal").distinct().count() > 50 and y.count() == 150 * 100


def test_crossings_meet_in_place_and_no_pairs_of_all_are_made(spark, monkeypatch):
    """Slow, fast and standing tracks, lives of one moment, odd rows; then 20,000 tracks far apart: 2e8 pairs, of which the cells hold none but a row of near ones."""
    rng = np.random.default_rng(9)
    rows = [(i, 5.0, *(float(v) for v in (*rng.uniform(-90, 90, 1), rng.normal(0, s), *rng.uniform(-90, 90, 1), rng.normal(0, s))), (a := float(rng.uniform(-20, 20))), a + float(rng.choice([0, 3, 30]))) for i, s in enumerate([0, 0.1, 2, 40] * 60)]
    rows += [(900, 5.0, 0.0, float("nan"), 0.0, 0.0, 0.0, 9.0), (901, 5.0, 0.0, 0.0, 0.0, 0.0, 9.0, 0.0), (902, None, 0.0, 0.0, 0.0, 0.0, 0.0, 9.0), (903, 5.0, float("inf"), 0.0, 0.0, 0.0, 0.0, 9.0), (904, 5.0, 1.0, 0.0, 1.0, 1e-13, -20.0, 40.0)]
    kind = "track long, t_ref double, x0 double, vx double, y0 double, vy double, t_min double, t_max double"
    want = {}
    for i, p in enumerate(rows):
        for q in rows[i + 1 :]:
            lo, hi = max(p[6], q[6]), min(p[7], q[7])
            if p[0] in (900, 901, 902, 903) or q[0] in (900, 901, 902, 903) or lo > hi:
                continue
            x, y = (p[k] + p[k + 1] * (lo - 5) - q[k] - q[k + 1] * (lo - 5) for k in (2, 4))
            u, v = p[3] - q[3], p[5] - q[5]
            t = max(0, min(hi - lo, -(x * u + y * v) / (u * u + v * v))) if u * u + v * v else 0
            if (d := math.hypot(x + u * t, y + v * t)) < 7:
                want[p[0], q[0]] = d
    for deal in (spatial.DEAL, 200):
        monkeypatch.setattr(spatial, "DEAL", deal)
        monkeypatch.setattr(clusters, "PAIRS", 64 if deal == 200 else clusters.PAIRS)
        got = [((r.a_track, r.b_track), r.distance) for r in clusters.closest_approach(spark.createDataFrame(rows, kind), 7.0).collect()]
        assert len(got) == len(dict(got)) and dict(got) == pytest.approx(want, abs=1e-9) and len(want) > 100
    assert clusters.closest_approach(spark.createDataFrame(rows[:0], kind), 7.0).count() == clusters.closest_approach(spark.createDataFrame(rows, kind), 0.0).count() == 0
    wide = spark.range(20000).selectExpr("id as track", "0.0D as t_ref", "id % 200 * 9.0D as x0", "1.0D as vx", "div(id, 200) * 9.0D as y0", "0.0D as vy", "0.0D as t_min", "3.0D as t_max")
    made = []
    passed = clusters._passed
    monkeypatch.setattr(clusters, "_passed", lambda *a: made.append(passed(*a)) or made[0])
    assert clusters.closest_approach(wide, 7.0).count() == 0
    assert made[0].groupBy("_b", "_cx", "_cy").count().selectExpr("sum(count * count)").first()[0] < 20000 * 60  # pairs compared


def test_neighbour_lists_as_text_and_cells_listed_as_often_however_dense(spark, monkeypatch):
    xy, df = _points(spark, 300, 30.0, 4)
    odd = spark.createDataFrame([(1000, None, 1.0, 0.0), (None, 1.0, 1.0, 0.0), (7, *map(float, xy[7]), 0.0)], df.schema)
    d = _apart(xy, xy)
    want = sorted((i, ";".join(str(j) for j in range(300) for _ in range(1 + (j == 7)) if j != i and d[i, j] <= 5)) for i in [*range(300), 7])
    for name in ("long", "string", "double"):
        got = clusters.neighbours(df.union(odd).withColumn("id", spatial.F.col("id").cast("long")), 5.0, "id", joined=";") if name == "long" else clusters.neighbours(df.union(odd).withColumn("id", spatial.F.format_string("%04d", "id") if name == "string" else spatial.F.col("id").cast("double")).filter("id is not null and id not like 'n%'"), 5.0, "id", joined=";")
        rows = [(int(float(r.id)), ";".join(str(int(float(k))) for k in r.near.split(";") if k)) for r in got.collect() if r.id is not None]
        assert sorted(rows) == sorted([*want, (1000, "")]), name
    monkeypatch.setattr(spatial, "DEAL", 500)
    listed = []
    meeting = clusters._meeting
    monkeypatch.setattr(clusters, "_meeting", lambda own, others, cell: listed.append(others.count()) or meeting(own, others, cell))
    for n in (1000, 4000):  # as many cells, four times as dense
        clusters.neighbours(spark.range(n).selectExpr("id", "id * 7919 % 1000 / 10.0D as x", "id * 104729 % 997 / 10.0D as y"), 5.0, "id")
    assert listed[1] < listed[0] * 6  # each cell was dealt over 16 times as many tasks, and listed in each
