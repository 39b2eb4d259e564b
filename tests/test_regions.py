"""Regions on the mosaic, lines in stamps and normality, by hand-worked and brute-force values."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.functions.values import normal_quantile
from chronoloom.operators import detect, regions, series


def test_normal_quantile(spark):
    p = [0.0, 1e-15, 1e-6, 0.01, 0.075, 0.0750001, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-9, 1.0]
    got = [r.q for r in spark.createDataFrame([(v,) for v in p], "p double").select(normal_quantile(F.col("p")).alias("q")).collect()]
    assert got[0] is None and got[-1] is None
    assert got[1:-1] == pytest.approx([NormalDist().inv_cdf(v) for v in p[1:-1]], rel=1e-12, abs=1e-15)


def test_shapiro_of_known_samples(spark):
    """A published sample, also far from zero; three values by hand (the middle one's place alone decides); groups without a result."""
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    groups = {1: weights, 2: [1.0, 2.0, 3.0], 3: [1.0, 1.0, 4.0], 4: [5.0] * 9, 5: [1.0, 2.0], 6: [1e9 + w for w in weights], None: [1.0, 2.0, 4.0, 8.0]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs] + [(1, None), (1, float("nan")), (9, None)], "k int, v double")
    got = {r.k: r for r in series.shapiro_w(df, ["k"], "v").collect()}
    assert set(got) == set(groups)
    assert got[1].n == 11 and got[1].shapiro_w == pytest.approx(0.78881, abs=1e-5) and got[6].shapiro_w == pytest.approx(got[1].shapiro_w, abs=1e-6)
    assert got[2].shapiro_w == pytest.approx(1.0) and got[3].shapiro_w == pytest.approx(0.75)
    assert got[4].shapiro_w is None and got[5].shapiro_w is None and 0.8 < got[None].shapiro_w < 1
    assert series.shapiro_w(df.limit(0), ["k"], "v").count() == 0


def holds(ring, x, y):
    return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])) % 2 == 1


def test_impacted_boxes_equals_all_pairs(spark):
    rng = np.random.default_rng(8)
    rings = {}
    for i in range(60):
        n = int(rng.integers(3, 14))
        size, a = float(rng.choice([3, 30, 300])), np.sort(rng.uniform(0, 2 * np.pi, n))
        c, away = rng.uniform(-100, 900, 2), size * rng.uniform(0.3, 1, n)  # stars, not convex
        rings[i] = list(zip((c[0] + away * np.cos(a)).tolist(), (c[1] + away * np.sin(a)).tolist()))
    rings |= {100: [(10.0, 10.0)], 101: [(50.0, 50.0), (250.0, 50.0), (250.0, 250.0), (50.0, 250.0)]}
    boxes = [(b, x, y, x + w, y + w, x + w / 2, y + w / 2) for b, (x, y, w) in enumerate((i * 90.0, j * 90.0, 100.0) for i in range(9) for j in range(9))]
    v = spark.createDataFrame([(i, k, x, y) for i, ring in rings.items() for k, (x, y) in enumerate(ring)] + [(100, 5, None, 3.0)], "region int, k int, x double, y double")
    got = {(r.region, r.box): r.how for r in regions.impacted_boxes(v, spark.createDataFrame(boxes, "box int, x0 double, y0 double, x1 double, y1 double, cx double, cy double"), "region", "k", 100.0).collect()}
    want = {}
    for i, ring in rings.items():
        for b, x0, y0, x1, y1, cx, cy in boxes:
            if any(x0 < x < x1 and y0 < y < y1 for x, y in ring):
                want[i, b] = "passed"
            elif holds(ring, cx, cy):
                want[i, b] = "inside"
    assert got == want and {"passed", "inside"} == set(want.values())


def test_adjacency_by_hand(spark):
    near = {(r.north, r.camera, r.ccd, r.sx, r.sy): (r.next_camera, r.next_ccd) for r in regions.adjacency(spark).collect()}
    # North: camera 4 is on top. Its upper row (4, 3) is turned by half: detector 4's own left is the mosaic's right, and nothing lies above.
    assert near[True, 4, 4, -1, 0] == (4, 3) and (True, 4, 4, 1, 0) not in near and near[True, 4, 4, 0, 1] == (4, 1) and (True, 4, 4, 0, -1) not in near
    # Its lower row (1, 2) isn't turned; below detector 1 comes camera 3's detector 4.
    assert near[True, 4, 1, 1, 0] == (4, 2) and near[True, 4, 1, 0, -1] == (3, 4) and near[True, 4, 1, 1, -1] == (3, 3)
    # Camera 2 has (2, 1) above (3, 4), camera 1 below it.
    assert near[True, 2, 3, 0, -1] == (1, 2) and near[True, 2, 2, 0, -1] == (3, 1) and (True, 1, 3, 0, -1) not in near
    # South: camera 1 on top with (4, 3) above (1, 2).
    assert near[False, 1, 1, 0, -1] == (2, 4) and (False, 1, 4, 0, -1) not in near
    sides = {(k[0], k[1], k[2]) for k in near}
    assert len(sides) == 32 and len(near) == 2 * (8 * 2 + 7 * 4 + 7 * 4)  # beside, above and below, across corners
    for (north, c, d, sx, sy), (nc, nd) in near.items():
        assert any(k[:3] == (north, nc, nd) and v == (c, d) for k, v in near.items())


def test_reached_detectors_by_hand(spark):
    ring = lambda i, cx, cy, size: [(i, True, 4, 1, cx + size * math.cos(a), cy + size * math.sin(a)) for a in np.linspace(0, 2 * math.pi, 9)]
    df = spark.createDataFrame(ring(1, 1000.0, 1000.0, 100.0) + ring(2, 2100.0, 1000.0, 200.0) + ring(3, 2136.0, 0.0, 400.0) + ring(4, 0.0, 1000.0, 50.0) + ring(5, 2130.0, 1000.0, 20.0), "id int, north boolean, camera int, ccd int, x double, y double")
    got = {(r.id, r.sx, r.sy): r for r in regions.reached_detectors(df, ["id"], "north", "camera", "ccd").collect()}
    assert set(got) == {(2, 1, 0), (3, 1, 0), (3, 0, -1), (3, 1, -1), (5, 1, 0)}  # no detector to the left of detector 1
    assert (got[2, 1, 0].next_camera, got[2, 1, 0].next_ccd, got[2, 1, 0].enough) == (4, 2, True)
    assert got[2, 1, 0].size == pytest.approx((200 - 200 * math.sqrt(0.5)) * 200 * math.sqrt(2))
    assert (got[3, 1, -1].next_camera, got[3, 1, -1].next_ccd) == (3, 3) and got[3, 1, -1].size == pytest.approx(400 * 400)
    assert not got[5, 1, 0].enough


def test_lines_in_stamps(spark):
    """A diagonal and a row are lines, a blob, a broken row and a dark stamp aren't."""
    def image(marked, sky=0.0):
        img = np.random.default_rng(1).normal(sky, 0.01, (11, 11))
        for x, y in [*marked, (5, 5)]:
            img[y, x] = 1.0
        return img.ravel().tolist()

    row = [(x, 5) for x in range(11)]
    stamps = {1: image([(i, i) for i in range(11)]), 2: image(row), 3: image([(x, y) for x in (4, 5, 6) for y in (4, 5, 6)]), 4: image([p for p in row if p[0] != 3] + [(3, 6)]), 5: [0.0] * 121, 6: image(row)[:60] + [None] * 61, 7: None}
    df = spark.createDataFrame([(k, v) for k, v in stamps.items()], "k int, img array<double>")
    masks = df.select("k", detect.bright_mask(F.col("img"), 60).alias("m"))
    seen = {r.k: r.m for r in masks.collect()}
    assert sorted(seen[1]) == [12 * i for i in range(11)] and sorted(seen[2]) == list(range(55, 66)) and len(seen[3]) == 9 and seen[5] is seen[6] is seen[7] is None
    got = {}
    for r in detect.straight_lines(masks, ["k"], "m", 11).collect():
        got.setdefault(r.k, []).append((r.angle, r.distance, r.votes, r.length))
    assert set(got) == {1, 2} and (135, 0, 11, 10) in got[1] and (90, 5, 11, 10) in got[2]
    assert all(v >= 10 and n >= 8 for lines in got.values() for _, _, v, n in lines)
