"""Work that follows the input: what is listed, met and held in place of results, which other tests compare with SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.operators import crossmatch, robust, tracks


def test_equal_values_make_no_group_large(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    assert not robust.has_large(df, ["k"], "v", 50)
    assert robust.has_large(spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v")), ["k"], "v", 50)


def test_clipping_writes_what_each_pass_measures(spark, monkeypatch):
    written = []
    monkeypatch.setattr(robust, "materialize", lambda df, name="step", m=robust.materialize: written.append(name) or m(df, name))
    v = np.random.default_rng(4).normal(0, 1, 400).round(3)
    got = robust.sigma_clip(spark.createDataFrame([(0, float(a)) for a in v], "k int, v double"), ["k"], "v", 1.5, 3).filter("kept").collect()
    kept = v
    for _ in range(3):
        kept = kept[abs(kept - np.median(kept)) < 1.5 * kept.std()]
    assert sorted(r.v for r in got) == sorted(kept.tolist())
    assert written == ["clip"] * 3


def test_a_group_meets_its_median_by_its_true_size(spark, monkeypatch):
    written = []
    monkeypatch.setattr(robust, "materialize", lambda df, name="step", m=robust.materialize: written.append(name) or m(df, name))
    z = np.random.default_rng(5).normal(20, 0.1, 60)
    got = robust.zeropoint_series(spark.createDataFrame([(0, float(a)) for a in z], "k int, z double"), ["k"], "z").collect()
    assert written == ["medians"]
    assert got[0].scatter == pytest.approx(1.4826 * np.median(abs(z - np.median(z))))
    assert got[0].zp == pytest.approx(2.5 * math.log10(np.median(10 ** (0.4 * z))))


@pytest.mark.parametrize("which", ["stars", "variables"])
def test_events_meet_few_of_a_crowded_catalogue(spark, monkeypatch, which):
    """The first of many in reach is found without meeting all of them, as are those of events with few in reach."""
    met = []

    def counting(*args, m=crossmatch.in_reach):
        pairs = m(*args).cache()
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(crossmatch, "in_reach", counting)
    monkeypatch.setattr(crossmatch, "AHEAD", 16)
    rng = np.random.default_rng(6)
    e = np.column_stack((rng.uniform(10, 14, 60), rng.uniform(-2, 2, 60)))
    e[:3] += [20, 0]  # these have few or none
    c = np.column_stack((rng.uniform(10, 14, 1500), rng.uniform(-2, 2, 1500)))
    c[:4] = e[0] + [[0, 0.1], [0.1, 0], [0.2, 0], [0, 5]]
    mag = rng.integers(0, 30, 1500) / 10
    events = spark.createDataFrame([(i, float(a), float(d), 0.3, 0.4, "-") for i, (a, d) in enumerate(e)], "id long, ra double, dec double, ra_err double, dec_err double, classification string")
    rows = [(float(a), float(d), i, i, f"V{i}", float(mag[i]) if i % 3 else None, float(mag[i])) for i, (a, d) in enumerate(c)]
    catalogue = spark.createDataFrame(rows, "ra double, dec double, source long, ordinal long, type string, rpmag double, gmag double")
    rank = [(mag[i] if i % 3 else math.inf, 0.0 if i % 3 else mag[i], i) for i in range(1500)]
    dra, ddec = c[None, :, 0] - e[:, None, 0], c[None, :, 1] - e[:, None, 1]
    if which == "stars":
        a, b = dra * np.cos(np.radians(e[:, None, 1])) / 0.3, ddec / 0.4
        want = {i: str(min(np.flatnonzero(near), key=lambda j: rank[j])) if near.any() else "-" for i, near in enumerate(np.hypot(a, b) <= 3)}
        got = {r.id: r.gaia_id for r in crossmatch.match_stars(events, catalogue, "id").collect()}
    else:
        near = (abs(dra) < 0.9) & (abs(ddec) < 1.2)
        want = {i: f"V{n.argmax()}" if n.any() else "-" for i, n in enumerate(near)}
        got = {r.id: r.classification for r in crossmatch.match_variables(events, catalogue, "id").collect()}
    assert got == want
    assert "-" in want.values() and sum(met) < 60 * 150


def test_courses_are_listed_in_few_cells(spark):
    """Slow tracks need no speed class of their own, and a bucket no more than four cells; what passes is that of a loop."""
    rng = np.random.default_rng(7)
    v = [2.0 ** -k for k in range(12)]
    t = spark.createDataFrame([(i, 0.0, 20.0, float(s), 0.0, 20.0, float(-s), 0.0, -5.0, 5.0) for i, s in enumerate(v)], "track long, t_ref double, x0 double, vx double, ax double, y0 double, vy double, ay double, t_from double, t_to double")
    p = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(np.column_stack((rng.uniform(14, 26, (400, 2)), rng.uniform(-6, 6, 400))))]
    got = {(r.id, r.r_track) for r in tracks.passes(spark.createDataFrame(p, "id long, x double, y double, t double"), t, 1.5).select("id", "r_track").collect()}
    assert got == {(i, j) for i, x, y, at in p for j, s in enumerate(v) if -5 <= at <= 5 and math.hypot(x - 20 - s * at, y - 20 + s * at) < 1.5}
    listed = tracks._on_the_way(t.withColumn("_k", F.lit(1)), 1.5)
    assert listed.groupBy("track", "_b").count().agg(F.max("count")).first()[0] <= 4


def test_the_brightest_of_crowded_places_settle_first(spark, monkeypatch):
    """As a plain loop, though not all pairs within reach are written."""
    from chronoloom.operators import spatial

    pairs = []

    def counting(df, name="step", m=spatial.materialize):
        out = m(df, name)
        pairs.append(out.count() if name == "pairs" else 0)
        return out

    monkeypatch.setattr(spatial, "materialize", counting)
    rng = np.random.default_rng(8)
    rows = [(i % 2, i, *map(float, rng.uniform(0, 12, 2).round(2)), float(rng.integers(0, 40))) for i in range(1200)]
    kept = []
    for row in sorted(rows, key=lambda r: (-r[4], r[1])):
        if all(k[0] != row[0] or math.hypot(k[2] - row[2], k[3] - row[3]) > 3 for k in kept):
            kept.append(row)
    df = spark.createDataFrame(rows, "frame long, id long, x double, y double, flux double")
    got = spatial.brightest_first(df, ["frame"], 3.0, "flux", "id").collect()
    assert sorted(r.id for r in got) == sorted(k[1] for k in kept)
    assert sum(pairs) < 20 * len(rows)
