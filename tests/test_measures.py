"""Error cuts, reference frames, neighbours on the sphere and aperture shares against plain loops and hand-worked values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.functions import photometry
from chronoloom.operators import curves, robust, spatial


def plain_errors(v, e, sigma=3.0, passes=10):
    m, before, good = np.median(v), None, np.ones(len(v), bool)
    out = (m, None, None, None)
    for _ in range(passes - 1):
        new = np.abs(v - m) <= sigma * e
        if not new.any():
            return (None, None, None, None), new
        w = 1 / e[new] ** 2
        m = (w * v[new]).sum() / w.sum()
        n = new.sum()
        out = (m, math.sqrt(1 / w.sum()), v[new].std(ddof=1) if n > 1 else None, (((v[new] - m) / e[new]) ** 2).sum() / (n - 1) if n > 1 else None)
        same = (new == good).all()
        good = new
        if same:
            break
    return out, good


def test_error_cuts_equal_the_plain_loop(spark):
    rng = np.random.default_rng(9)
    groups = {1: [(5.0, 1.0)], 2: [(1.0, 0.1), (9.0, 0.1)], 3: [(1.0, 0.1), (1.1, 0.1), (9.0, 50.0)], None: [(2.0, 1.0), (2.5, 2.0), (30.0, 1.0)]}
    groups |= {10 + i: list(zip(rng.standard_t(1.3, n).tolist(), rng.uniform(0.1, 1, n).tolist())) for i, n in enumerate((4, 9, 50, 200))}
    rows = [(k, v, e) for k, vs in groups.items() for v, e in vs] + [(1, 7.0, 0.0), (1, None, 1.0), (1, 7.0, None), (88, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "k int, v double, e double")
    got = {r.k: r for r in robust.error_cut_loop(df, ["k"], "v", "e").collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        want, good = plain_errors(*np.array(vs).T)
        r = got[k]
        assert (r.n_kept, r.n_cut) == (good.sum(), (~good).sum()), k
        for a, b in zip((r.mean, r.mean_err, r.stdev, r.chi2_norm), want):
            assert a == (b if b is None else pytest.approx(b, rel=1e-9)), k
    assert got[2].n_kept == 0 and got[1].n_kept == 1
    assert robust.error_cut_loop(df.limit(0), ["k"], "v", "e").count() == 0


def plain_reference(m, good):
    """Raise the percentile until a good frame lies under it in all blocks."""
    for p in range(5, 101):
        ok = (m <= np.percentile(m, p, axis=0)).all(axis=1) & good
        if ok.any():
            at = np.flatnonzero(ok)
            best = at[m[at].sum(axis=1).argmin()]
            return int(best), p, int(good[:best].sum())
    return None


def test_reference_frames_equal_the_loop(spark):
    rng = np.random.default_rng(12)
    rows, want = [], {}
    for key, (frames, blocks, spread) in enumerate([(40, 4, 3.0), (60, 9, 0.3), (25, 16, 2.0), (5, 1, 1.0)]):
        m = rng.normal(100, spread, (frames, 1)) + rng.normal(0, 1, (frames, blocks))
        good = rng.random(frames) > 0.2
        want[key] = plain_reference(m, good)
        rows += [(key, f, b, float(m[f, b]), bool(good[f])) for f in range(frames) for b in range(blocks)]
    rows += [(9, 0, 0, 1.0, False), (9, 1, 0, 2.0, None)]
    df = spark.createDataFrame(rows, "camera int, frame int, block int, median double, good boolean")
    got = {r.camera: (r.frame, r.percentile, r.index_good) for r in robust.reference_frames(df, ["camera"], "frame", good="good").collect()}
    assert got == want and None not in want.values()
    pixels = spark.createDataFrame([(1, x, y, float(x + y)) for x in range(0, 14) for y in range(0, 11)] + [(1, 5, 5, None)], "frame int, x int, y int, v double")
    blocks = {r.block: (r.median, r.n) for r in robust.block_medians(pixels, [], "frame", "v", 2, margin=4, size=10).collect()}
    assert blocks == {0: (8.0, 25), 1: (13.0, 25), 2: (13.0, 25), 3: (18.0, 25)}


def test_neighbours_on_the_sphere(spark):
    rng = np.random.default_rng(13)
    rows = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(rng.uniform(0, 360, 150), np.degrees(np.arcsin(rng.uniform(-1, 1, 150)))))]
    rows += [(200, 0.001, 10.0), (201, 359.999, 10.0), (202, 5.0, 90.0), (203, 185.0, 89.9), (204, 50.0, -30.0), (205, 50.0, -30.0)]
    df = spark.createDataFrame([*rows, (300, None, 1.0), (None, 50.0, -30.0)], "id int, ra double, dec double")
    got = {r.id: r.min_dist_arcsec for r in spatial.sky_self_nearest(df, 0.5, "id").collect()}
    assert len(got) == len(rows) + 2 and got[300] is None and got[None] is None and got[204] == got[205] == 0
    v = np.array([[math.cos(math.radians(d)) * math.cos(math.radians(a)), math.cos(math.radians(d)) * math.sin(math.radians(a)), math.sin(math.radians(d))] for _, a, d in rows])
    chord = np.linalg.norm(v[:, None] - v[None], axis=2)
    np.fill_diagonal(chord, 9)
    for (i, *_), c in zip(rows, chord.min(axis=1)):
        assert got[i] == pytest.approx(3600 * math.degrees(2 * math.asin(c / 2)), rel=1e-6, abs=1e-4)
    far = spark.createDataFrame([(1, 10.0, 0.0), (2, 190.0, 0.0)], "id int, ra double, dec double")
    assert [r.min_dist_arcsec for r in spatial.sky_self_nearest(far, 7.0, "id").collect()] == pytest.approx([648000.0] * 2)
    assert [r.min_dist_arcsec for r in spatial.sky_self_nearest(far.limit(1), 7.0, "id").collect()] == [None]


def test_aperture_shares(spark):
    """A moved image by numpy, a point's light by hand, and places without an image."""
    rng = np.random.default_rng(14)
    prf = rng.uniform(0, 1, (7, 7)) * np.exp(-np.hypot(*np.mgrid[-3:4, -3:4]))
    at = [(x, y) for x in (-0.5, -0.2, 0.0, 0.3) for y in (-0.4, 0.0, 0.45)]
    df = spark.createDataFrame([(x, y, prf.ravel().tolist()) for x, y in at] + [(0.0, 0.0, None), (0.0, 0.0, [0.0] * 49), (0.0, 0.0, [1.0])], "x double, y double, prf array<double>")
    got = [r.s for r in df.select(curves.captured(F.col("prf"), F.col("x"), F.col("y"), 7).alias("s")).collect()]
    for (x, y), s in zip(at, got):
        big = np.zeros((11, 11))
        i, j = math.floor(x), math.floor(y)
        for a, wx in ((i, 1 - x + i), (i + 1, x - i)):
            for b, wy in ((j, 1 - y + j), (j + 1, y - j)):
                big[2 + b : 9 + b, 2 + a : 9 + a] += wx * wy * prf
        assert s == pytest.approx(big[4:7, 4:7].sum() / big[2:9, 2:9].sum(), rel=1e-9)
    assert got[len(at) :] == [None, None, None]
    point = [0.0] * 24 + [1.0] + [0.0] * 24
    objects = spark.createDataFrame([(1, 7, 150.3, 20.0), (2, 7, 250.0, 20.0), (3, 8, 150.0, 20.0)], "id int, ccd int, xcentroid double, ycentroid double")
    shares = curves.aperture_shares(objects, spark.createDataFrame([(7, 1, 0, point)], "ccd int, bx long, by long, prf array<double>"), ["ccd"], 7)
    assert {r.id: r.aperture for r in shares.collect()} == {1: 1.0, 2: None, 3: None}
    lc = spark.createDataFrame([(7, 10.0, 1.0, 0.5), (7, 10.0, 1.0, None), (9, 10.0, 1.0, 0.5)], "cut int, flux double, flux_err double, share double")
    out = curves.in_units(lc, spark.createDataFrame([(7, 20.0)], "cut int, zp_ab double"), ["cut"], "mag", aperture="share").collect()
    assert {(r.units, round(r.flux, 6)) for r in out} == {("mag", round(20 + 2.5 * math.log10(0.5) - 2.5, 6)), ("mag", 17.5), ("counts", 10.0)}


def test_chosen_events(spark):
    rows = [(1, 1, 1, -5.0, 0.1), (1, 1, 2, float("nan"), 0.9), (1, 2, 1, -9.0, 0.5), (1, 3, 1, None, 0.7)]
    group = spark.createDataFrame(rows, "cut int, objid int, eventid int, delta_bic double, stability double")
    pick = lambda df, **k: [(r.objid, r.eventid) for r in curves.chosen_events(df, ["cut"], **k).collect()]
    assert pick(group, n=2) == [(2, 1), (1, 1)] and len(pick(group)) == 4 and pick(group, n=3)[2] == (1, 2)
    assert pick(group.drop("delta_bic"), n=2) == [(1, 2), (3, 1)] and pick(group.drop("delta_bic", "stability"), n=1) == [(1, 1)]
    assert pick(group, events=spark.createDataFrame([(3, 1), (3, 1), (9, 9)], "objid int, eventid int")) == [(3, 1)]
    with pytest.raises(ValueError, match="cut"):
        curves.chosen_events(group.drop("cut"), ["cut"])


def test_star_flags(spark):
    rows = [((3, 1, None, 1), 0.9, 0, 1), ((1, None, 0, 2), 0.7, 1, 0), ((0, 2, None, None), 0.71, 2, 2), ((None,) * 4, None, 2, 0)]
    df = spark.createDataFrame([(*f, s, a, b) for f, s, a, b in rows], "g int, r int, i int, z int, s double, a int, b int")
    assert [tuple(x) for x in df.select(photometry.star_class_by_flags(*[F.col(c) for c in "griz"]), "a", photometry.star_class_by_score(F.col("s")), "b").collect()] == [(a, a, b, b) for *_, a, b in rows]
