"""Plate solutions, clipping, headers and cuts against plain loops and hand-worked values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.functions import sky
from chronoloom.operators import astrometry, robust


def basis(x, y, order):
    return np.column_stack([x**i * y**j for i, j in sky.powers(order)])


@pytest.mark.parametrize("hold", ["none", "constant", "x", "y"])
def test_surfaces_equal_least_squares(spark, hold):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(x), float(y), float(x * 1.01 + y * 0.02 + 3 + 1e-5 * x * y + rng.normal())) for g in range(3) for x, y in rng.uniform(-1500, 1500, (80, 2))]
    rows += [(0, None, 1.0, 2.0), (1, 1.0, float("nan"), 2.0), (None, 1.0, 1.0, 1.0), (7, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double, w double")
    got = {r.g: r for r in astrometry.fit_surfaces(df, ["g"], "x", "y", {"w": hold}, 3).collect()}
    assert set(got) == {0, 1, 2, 7, None} and got[7].w is None and got[None].w is None and got[7].n == 1
    for g in range(3):
        x, y, w = np.array([r[1:] for r in rows if r[0] == g and r[1] is not None and not math.isnan(r[2])]).T
        a = basis(x / 1000, y / 1000, 3)
        least = {"none": 0, "constant": 1}.get(hold, 2)
        free = [k for k, p in enumerate(sky.powers(3)) if sum(p) >= least]
        want = np.zeros(10)
        want[free] = np.linalg.lstsq(a[:, free], w - {"x": x, "y": y}.get(hold, 0), rcond=None)[0]
        want[free] /= 1000.0 ** np.array([sum(sky.powers(3)[k]) for k in free])
        if hold in "xy":
            want[1 if hold == "x" else 2] = 1
        size = 1000.0 ** np.array([sum(p) for p in sky.powers(3)])
        assert np.array(got[g].w) * size == pytest.approx(want * size, rel=1e-6, abs=1e-6) and got[g].n == 80
    assert astrometry.fit_surfaces(df.limit(0), ["g"], "x", "y", {"w": hold}, 3).count() == 0


def plain_cut(v, sigma=3.0, passes=10):
    """The loop over one group's values: mean, deviation, which are kept."""
    c = np.median(v)
    d = np.abs(v - c)
    good = d < np.percentile(d, 80) if len(v) > 3 else np.ones(len(v), bool)
    if good.sum() < 3 and len(v) > 3:
        good = d <= np.sort(d)[2]
    m, n = np.median(v[good]), int(good.sum())
    if n < 2:
        return m, None, good
    c4 = {2: 0.7978845608, 3: 0.8862269255, 4: 0.9213177319, 5: 0.9399856030}.get(n) or math.sqrt(2 / (n - 1)) * math.exp(math.lgamma(n / 2) - math.lgamma((n - 1) / 2))
    s = math.sqrt(((v[good] - m) ** 2).sum() / (n - 1)) / c4
    for _ in range(passes - 1):
        if not s > 0:
            break
        new = np.abs(v - m) <= sigma * s
        if new.sum() < 2:
            break
        same = new.sum() == good.sum()
        good, m, s = new, v[new].mean(), v[new].std(ddof=1)
        if same:
            break
    return m, s, good


@pytest.mark.parametrize("held", [1 << 20, 8])
def test_cut_loop_equals_the_plain_loop(spark, held, monkeypatch):
    monkeypatch.setattr(robust, "has_large", lambda *a, h=held: h == 8)
    monkeypatch.setattr(robust.quantile, "__defaults__", (*robust.quantile.__defaults__[:3], held, None))
    rng = np.random.default_rng(11)
    groups = {1: [5.0], 2: [1.0, 9.0], 3: [1.0, 2.0, 90.0], 4: [0.0] * 6, 5: [0.0] * 5 + [1.0], 6: [1.0, 2.0, 3.0, 50.0], None: [2.0, 2.5, 3.0, 2.2, 99.0]}
    groups |= {10 + k: rng.standard_t(1.5, size=n).tolist() for k, n in enumerate((4, 5, 7, 12, 40, 300))}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [(1, None), (77, None), (10, float("nan"))]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r for r in robust.sigma_cut_loop(df, ["k"], "v").collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        m, s, good = plain_cut(np.array(vs))
        r = got[k]
        assert (r.n_kept, r.n_cut) == (good.sum(), (~good).sum()), k
        assert r.mean == pytest.approx(m, rel=1e-6) and r.stdev == (s if s is None else pytest.approx(s, rel=2e-5)), k
        inside = [abs(v - r.centre) < r.reach or (abs(v - r.centre) == r.reach and not r.strict) for v in vs]
        assert inside == good.tolist(), k
    assert robust.sigma_cut_loop(df.limit(0), ["k"], "v").count() == 0


def test_plate_solution_equals_the_plain_loop(spark):
    rng = np.random.default_rng(5)
    rows, plain = [], {}
    for g in (1, 2):
        x, y = rng.uniform(-1000, 1000, (2, 400))
        u = 0.4 + x * 1.0005 - 0.001 * y + g * 2e-6 * x * x + 1e-9 * x * y * y + rng.normal(0, 0.02, 400)
        v = -0.3 + y * 0.9996 + 0.0012 * x + 1e-6 * x * y + rng.normal(0, 0.02, 400)
        u[:12] += 3
        v[12:20] -= 2
        rows += [(g, g * 1000 + i, *map(float, t)) for i, t in enumerate(zip(x, y, u, v))]
        keep = np.ones(400, bool)
        for _ in range(20):
            a = basis(x / 1000, y / 1000, 3)
            cu, cv = (np.linalg.lstsq(a[keep], w[keep], rcond=None)[0] for w in (u, v))
            before = keep.sum()
            for res in (u - a @ cu, v - a @ cv):
                at = np.flatnonzero(keep)
                keep[at[~plain_cut(res[at])[2]]] = False
            if keep.sum() == before:
                break
        plain[g] = cu, cv, keep
    rows += [(1, 5000, None, 1.0, 1.0, 1.0), (3, 6000, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, star long, x double, y double, u double, v double")
    fits, seen = astrometry.plate_solution(df, ["g"], "star", "x", "y", "u", "v", 3)
    fits, seen = {r.g: r for r in fits.collect()}, {r.id: r for r in seen.collect()}
    assert len(seen) == len(rows) and not seen[5000].kept and fits[3].u is None
    size = 1000.0 ** np.array([sum(p) for p in sky.powers(3)])
    for g, (cu, cv, keep) in plain.items():
        assert [seen[g * 1000 + i].kept for i in range(400)] == keep.tolist() and not keep[:20].any() and keep.sum() > 300
        assert np.array(fits[g].u) * size == pytest.approx(cu, abs=1e-6) and np.array(fits[g].v) * size == pytest.approx(cv, abs=1e-6)


HEAD = {"crval1": 359.9, "crval2": 40.0, "crpix1": 1025.0, "crpix2": 1020.0, "cd11": -0.0057, "cd12": 0.0003, "cd21": 0.0002, "cd22": 0.0056}


def test_back_and_headers(spark):
    """Distortion there and back within a hundredth of a pixel; a header by hand."""
    forward = [0.5, 1.001, -0.002, 2e-6, 1e-6, -1e-6, 1e-10, 0.0, 2e-10, 0.0], [-0.25, 0.003, 0.999, 1e-6, 0.0, 3e-6, 0.0, 1e-10, 0.0, 0.0]
    fits = spark.createDataFrame([(1, 400, *forward)], "g int, n long, u array<double>, v array<double>")
    heads = spark.createDataFrame([(1, 2078, 2136, *HEAD.values(), {"A_5_5": 1.0}), (2, 2078, 2136, *HEAD.values(), {"A_5_5": 1.0})], "g int, naxis1 int, naxis2 int, " + ", ".join(f"{c} double" for c in HEAD) + ", sip map<string,double>")
    moved = spark.createDataFrame([(1, 400, [0.0, *forward[0][1:]], [0.0, *forward[1][1:]])], fits.schema)
    back = astrometry.inverse_surfaces(moved, heads, ["g"], 3).first()
    x, y = np.meshgrid(np.linspace(-1000, 1000, 9), np.linspace(-1000, 1000, 9))
    x, y = x.ravel(), y.ravel()
    a = basis(x, y, 3)
    u, v = a @ np.array([0.0, *forward[0][1:]]), a @ np.array([0.0, *forward[1][1:]])
    b = basis(u, v, 3)
    assert back.x[0] == back.y[0] == 0.0 and b @ np.array(back.x) == pytest.approx(x, abs=0.02) and b @ np.array(back.y) == pytest.approx(y, abs=0.02)
    terms = astrometry.coefficient_rows(fits, astrometry.inverse_surfaces(fits, heads, ["g"], 3), ["g"], 3)
    listed = terms.orderBy("siaf_index").collect()
    assert [(t.siaf_index, t.exponent_x, t.exponent_y) for t in listed] == [(0, 0, 0), (10, 1, 0), (11, 0, 1), (20, 2, 0), (21, 1, 1), (22, 0, 2), (30, 3, 0), (31, 2, 1), (32, 1, 2), (33, 0, 3)]
    assert [t.to_x for t in listed] == forward[0] and [t.to_y for t in listed] == forward[1]
    new = {r.g: r for r in astrometry.updated_headers(heads, terms, ["g"]).collect()}
    h = new[1]
    assert (h.crpix1, h.crpix2) == (1025.5, 1019.75)
    cd = np.array([[HEAD["cd11"], HEAD["cd12"]], [HEAD["cd21"], HEAD["cd22"]]]) @ np.array([[1.001, -0.002], [0.003, 0.999]])
    assert [h.cd11, h.cd12, h.cd21, h.cd22] == pytest.approx(cd.ravel(), rel=1e-12)
    assert len(h.sip) == 4 * 7 + 4 and h.sip["A_2_0"] == 2e-6 and h.sip["B_0_2"] == 3e-6 and h.sip["AP_ORDER"] == 3.0 and "A_5_5" not in h.sip
    assert {c: new[2][c] for c in HEAD} == HEAD and new[2].sip == {"A_5_5": 1.0}
    plain = {r.g: r for r in astrometry.updated_headers(heads, terms, ["g"], offset=False, rotation=False, distortion=False).collect()}
    assert {c: plain[1][c] for c in HEAD} == HEAD and plain[1].sip == {"A_5_5": 1.0}


def test_pixels_and_cuts_round_trip(spark):
    rows = [(float(x), float(y)) for x in range(0, 2049, 256) for y in range(0, 2049, 256)]
    a, b = [0.0, 0.0, 0.0, 3e-6, -1e-6, 2e-6, 1e-10, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 1e-6, 2e-6, -2e-6, 0.0, 0.0, 0.0, 2e-10]
    head = F.struct(*[F.lit(v).alias(k) for k, v in HEAD.items()], F.array(*map(F.lit, a)).alias("a"), F.array(*map(F.lit, b)).alias("b"))
    cut = F.struct(F.lit(512).alias("corner_x"), F.lit(300).alias("corner_y"), F.lit(0.25).alias("dx"), F.lit(-0.5).alias("dy"))
    df = spark.createDataFrame(rows, "x double, y double")
    ra, dec = sky.pixel_to_sky(F.col("x"), F.col("y"), head, 3)
    placed = df.withColumns({"ra": ra, "dec": dec})
    px, py = sky.sky_to_pixel(F.col("ra"), F.col("dec"), head, 3)
    cx, cy = astrometry.sky_to_cut(F.col("ra"), F.col("dec"), head, cut, 3)
    r2, d2 = astrometry.cut_to_sky(F.col("cx"), F.col("cy"), head, cut, 3)
    out = placed.withColumns({"px": px, "py": py, "cx": cx, "cy": cy}).withColumns({"r2": r2, "d2": d2}).collect()
    for r in out:
        assert (r.px, r.py, r.cx, r.cy) == pytest.approx((r.x, r.y, r.x - 512 + 0.25, r.y - 300 - 0.5), abs=1e-6) and (r.r2, r.d2) == pytest.approx((r.ra, r.dec), abs=1e-9)
    centre = [r for r in out if abs(r.x - 1024) < 1 and abs(r.y - 1024) < 1][0]
    u, v = 0.0, 5.0  # (1024, 1024) lies 5 rows above the reference pixel
    v, u = v + b[5] * v * v + b[9] * v**3, u + a[5] * v * v
    xi, eta = HEAD["cd11"] * u + HEAD["cd12"] * v, HEAD["cd21"] * u + HEAD["cd22"] * v
    assert (centre.dec, centre.ra) == pytest.approx((40 + eta, 359.9 + xi / math.cos(math.radians(40 + eta))), abs=1e-6)


def test_cut_corners_by_hand(spark):
    cuts = spark.createDataFrame([(i,) for i in range(1, 10)], "cut long")
    got = {r.cut: r for r in astrometry.cut_corners(cuts, 3, 10).collect()}
    assert [(got[i].corner_x, got[i].corner_y) for i in range(1, 10)] == [(x, y) for y in (0, 677, 1355) for x in (44, 721, 1399)]
    assert {r.half for r in got.values()} == {347.0} and got[5].centre_x == 1068.0
    one = astrometry.cut_corners(cuts.limit(1), 1, 0).first()
    assert (one.corner_x, one.corner_y, one.half) == (44, 0, 1024.0)
