"""Tracks and brightest-first choice against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.operators import clusters, spatial, tracks

POINT = "id long, x double, y double, t double, track long"


def plain_fit(t, v, most):
    """Bounded least squares: the free solution, or the best one on the bound."""
    u = t - t.mean()
    basis = np.column_stack([np.ones_like(u), u, u * u / 2])
    if len(t) < 3 or most is None:
        a = 0.0
    else:
        a = float(np.clip(np.linalg.lstsq(basis, v, rcond=None)[0][2], -most, most))
    x0, vx = np.linalg.lstsq(basis[:, :2], v - a * basis[:, 2], rcond=None)[0]
    return x0, vx, a


@pytest.fixture(scope="module")
def sky(spark):
    """Pieces of long courses, some overlapping, with scatter: many tracks that take each other, in chains too."""
    rng = np.random.default_rng(21)
    rows, name = [], 0
    for _ in range(60):
        x, y, vx, vy = rng.uniform(0, 250, 2).tolist() + rng.normal(0, 8, 2).tolist()
        for _ in range(int(rng.integers(2, 12))):
            t0, n = float(rng.uniform(0, 18)), int(rng.integers(3, 9))
            name += 1
            for t in np.sort(rng.uniform(t0, t0 + 2, n)):
                rows.append((len(rows) + 1000, float(x + vx * (t - 10) + rng.normal(0, 2.5)), float(y + vy * (t - 10) + rng.normal(0, 2.5)), float(t), name))
    return rows


@pytest.mark.parametrize("most", [None, 1.0])
def test_fit_equals_bounded_least_squares(spark, sky, most):
    got = {r.track: r for r in tracks.fit(spark.createDataFrame(sky, POINT), (), most).collect()}
    assert len(got) > 300
    for name, r in got.items():
        own = np.array([row[1:4] for row in sky if row[4] == name])
        for axis, v in (("x", own[:, 0]), ("y", own[:, 1])):
            want = plain_fit(own[:, 2], v, most)
            assert [r[f"{axis}0"], r[f"v{axis}"], r[f"a{axis}"]] == pytest.approx(want, abs=1e-5)
        assert (r.n_points, r.t_min, r.t_max) == (len(own), own[:, 2].min(), own[:, 2].max())


def plain_merge(rows, fits, radius):
    """The loop itself: by size, each track still there takes every other one still there whose points are near its course on average."""
    members = {}
    for row in rows:
        members.setdefault(row[4], []).append(row)
    order, gone = sorted(fits, key=lambda k: (-fits[k].n_points, k)), set()
    for i in order:
        if i in gone:
            continue
        f = fits[i]
        for j in order:
            if j == i or j in gone:
                continue
            d = [np.hypot(x - f.x0 - f.vx * (t - f.t_ref) - f.ax * (t - f.t_ref) ** 2 / 2, y - f.y0 - f.vy * (t - f.t_ref) - f.ay * (t - f.t_ref) ** 2 / 2) for _, x, y, t, _ in members[j]]
            if np.mean(d) < radius:
                members[i] = members[i] + members.pop(j)
                gone.add(j)
    return {row[0]: name for name, rows in members.items() for row in rows}


def test_merge_equals_the_greedy_loop(spark, sky):
    points = spark.createDataFrame(sky, POINT)
    fitted = tracks.fit(points, (), None)
    want = plain_merge(sky, {r.track: r for r in fitted.collect()}, 12.0)
    got = {r.id: r.track for r in tracks.merge(points, fitted, 12.0).collect()}
    assert got == want and 60 < len(set(want.values())) < len({row[4] for row in sky}) * 0.8


def test_passes_finds_all_whatever_the_speed(spark, sky):
    rng = np.random.default_rng(2)
    course = [(i, 10.0, *rng.uniform(0, 250, 1).tolist(), float(rng.normal(0, s)), float(rng.normal(0, a)), *rng.uniform(0, 250, 1).tolist(), float(rng.normal(0, s)), 0.0, 2.0, 17.5) for i, (s, a) in enumerate([(0, 0), (1e-3, 0), (1, 0), (8, 0.5), (500, 3), (8, 0)] * 8)]
    made = spark.createDataFrame(course, "track long, t_ref double, x0 double, vx double, ax double, y0 double, vy double, ay double, t_from double, t_to double")
    got = {(r.id, r.r_track) for r in tracks.passes(spark.createDataFrame(sky, POINT), made, 9.0).collect()}
    want = {(i, c[0]) for i, x, y, t, _ in sky for c in course if c[8] <= t <= c[9] and np.hypot(x - c[2] - c[3] * (t - 10) - c[4] * (t - 10) ** 2 / 2, y - c[5] - c[6] * (t - 10)) < 9.0}
    assert got == want and len(want) > 50


def test_tagging_two_fields(spark):
    rng = np.random.default_rng(6)
    rows = []
    for field in (1, 2):
        for c, (x, y, vx, vy) in enumerate([(20, 20, 30, 20), (200, 30, -25, 30)]):
            for t in np.arange(0, 4, 0.1):
                if 2.0 < t < 2.4 and c == 0:
                    continue  # a gap that merging closes
                rows.append((field, float(x + vx * t + rng.normal(0, 0.2)), float(y + vy * t + rng.normal(0, 0.2)), float(t), 1, "Asteroid"))
        rows += [(field, 20 + 30 * 2.2, 20 + 20 * 2.2, 2.2, 1, "-"), (field, 20 + 30 * 2.3, 20 + 20 * 2.3, 2.3, -1, "-"), (field, 240.0, 240.0, 1.0, 1, "Asteroid"), (field, 240.0, 10.0, 1.0, 1, "star"), (field, 5.0, 5.0, 1.0, 1, None)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    events = spark.createDataFrame(rows, "id long, field int, x double, y double, t double, flux_sign int, classification string")
    got = {r.id: r for r in tracks.tag_moving(events, ["field"], rounds=2).collect()}
    assert len(got) == len(rows)
    for field in (1, 2):
        mine = [got[r[0]] for r in rows if r[1] == field]
        assert [(r.asteroid_id, r.classification) for r in mine[-5:]] == [(mine[0].asteroid_id, "Asteroid"), (-1, "-"), (0, "Asteroid"), (-1, "star"), (-1, None)]
        seen = [r.asteroid_id for r in mine[:-5]]
        assert set(seen) == {1, 2} and set(seen[:-40]) == {seen[0]} and seen[-40:] == [3 - seen[0]] * 40
    assert tracks.tag_moving(events.limit(0), ["field"], rounds=1).count() == 0


def test_brightest_first_equals_the_greedy_choice(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i % 5), i, float(rng.integers(0, 60)) / 2, float(rng.integers(0, 60)) / 2, None if i % 97 == 0 else float(rng.integers(0, 40))) for i in range(1500)] + [(0, 5000 + i, 3.0, 3.0, 1.0) for i in range(300)]
    rows += [(1, 9000 + i, i * 0.9, 100.0, float(100 - i)) for i in range(40)] + [(1, 9999, None, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "frame int, id long, x double, y double, flux double")
    want = set()
    for frame in range(5):
        kept = []
        for _, i, x, y, _ in sorted((r for r in rows if r[0] == frame and r[2] is not None), key=lambda r: (-(r[4] if r[4] is not None else -np.inf), r[1])):
            if all((x - a) ** 2 + (y - b) ** 2 > 1 for _, a, b in kept):
                kept.append((i, x, y))
        want |= {i for i, *_ in kept}
    got = spatial.brightest_first(df, ["frame"], 1.0, "flux", "id")
    assert got.columns == df.columns and {r.id for r in got.collect()} == want | {9999}
    assert spatial.brightest_first(df.filter(F.lit(False)), ["frame"], 1.0, "flux", "id").count() == 0


def test_seeds_of_a_field_are_contracted_before_they_meet(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, f"f{i % 3}", float(x), float(y), float(t), 1, "Asteroid") for i, (x, y, t) in enumerate(zip(rng.normal(50, 1, 180), rng.normal(50, 1, 180), rng.uniform(0, 1, 180)))]
    events = spark.createDataFrame(rows, "id long, field string, x double, y double, t double, flux_sign int, classification string")
    seen, own = [], clusters.connected_components
    monkeypatch.setattr(clusters, "connected_components", lambda edges, *a: seen.append(edges.count()) or own(edges, *a))
    got = tracks.tag_moving(events, ["field"], rounds=1).groupBy("field").agg(F.count_distinct("asteroid_id").alias("n"), F.min("asteroid_id").alias("k")).collect()
    assert {(r.field, r.n, r.k) for r in got} == {(f"f{i}", 1, 1) for i in range(3)}
    assert seen[0] < 180  # there are about 60 * 59 pairs in each field


def test_clusters_of_given_pairs_and_wide_cells_equal_plain_loops(spark):
    rng = np.random.default_rng(7)
    xy, field = np.round(rng.uniform(-20, 20, (400, 2)), 1), rng.integers(0, 2, 400)
    df = spark.createDataFrame([(i, int(f), float(x), float(y)) for i, ((x, y), f) in enumerate(zip(xy, field))], "id long, field long, x double, y double")
    near = (np.hypot(*(xy[:, None] - xy[None]).transpose(2, 0, 1)) <= 2.0) & (field[:, None] == field)
    pairs = {(int(i), int(j)) for i, j in zip(*np.nonzero(near))}
    for width in (1, 2, 3):
        for listed in (False, True):
            met = spatial.within(df, df, 2.0, keys=["field"], width=width, list_left=listed)
            rows = [(r.l_id, r.r_id) for r in met.collect()]
            assert len(rows) == len(pairs) and set(rows) == pairs
    core = near.sum(axis=1) >= 4
    name = np.where(core, np.arange(400), 400)
    while (new := np.where(core, np.minimum(name, np.where(near & core[None, :], name[None, :], 400).min(axis=1)), 400)).tolist() != name.tolist():
        name = new
    border = np.where(near & core[None, :], name[None, :], 400).min(axis=1)
    want = {i: int(name[i]) if core[i] else int(border[i]) if border[i] < 400 else None for i in range(400)}
    for keys in ([], ["field"]):
        got = clusters.density_clusters_of(df, met.select(F.col("l_id").alias("u"), F.col("r_id").alias("v"), F.col("l_field").alias("field")), 4, "id", keys=keys)
        assert {r.id: r.cluster for r in got.collect()} == want and 2 < len({c for c in want.values()}) and core.sum() > 30
