"""Filters of objects, light-curve windows, cut-outs and joins on the sphere, on small hand-worked tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from chronoloom.operators import clusters, curves, detect, filters, resolve, spatial
from chronoloom.sources import files


def test_objects_by_cone_class_and_bounds(spark):
    rows = [(1, 10.0, 0.0, 3, "VEB", 20.0), (2, 10.01, 0.0, 9, "RRLyrae", -45.0), (3, 10.02, 0.0, 1, "Asteroid", 80.0), (4, None, None, 2, None, None)]
    o = spark.createDataFrame(rows, "objid int, ra double, dec double, n_events int, classification string, gal_b double")
    ids = lambda **k: sorted(r.objid for r in filters.filter_objects(o, **k).collect())
    assert ids() == [1, 2, 3, 4]
    assert ids(centre=(10.0, 0.0)) == [1, 2]  # 36 arc seconds, then 72
    assert ids(centre=(10.0, 0.0), distance=36.0001) == [1, 2] and ids(centre=(10.0, 0.0), distance=35.9) == [1]
    assert ids(n_events=(2, 3)) == [1, 4]
    assert ids(classification="var") == [1] and ids(classification="!variable") == [2, 3]  # RRLyrae counts for events only
    assert ids(galactic_latitude=45.0) == [2, 3]
    with pytest.raises(TypeError):
        ids(galactic_latitude="45")


def test_crossbin_members_keep_repeated_rows_and_shared_ids_need_no_order(spark):
    ev = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (2, [3]), (3, []), (4, None)], "k int, crossbin_ids array<long>")
    wanted = spark.createDataFrame([(2,), (2,), (None,)], "id long")
    assert [r.k for r in filters.members_of(ev, wanted).collect()] == [1, 1]
    lists = spark.createDataFrame([(1, [5, 7]), (2, [7, 9]), (3, [9]), (4, [1]), (5, None)], "k int, ids array<long>")
    got = {r.k: r.codes for r in resolve.shared_ids(lists, ["k"], "ids").collect()}
    assert got == {1: [1], 2: [1, 2], 3: [2], 4: [], 5: []}


def test_windows_are_clipped_and_meet_over_buckets(spark):
    series = spark.createDataFrame([(1, f, float(f)) for f in range(300)] + [(2, 0, 1.0)], "k int, f long, flux double")
    ev = spark.createDataFrame([(1, 1, 3.0, 5.0), (1, 2, 295.0, 298.0), (1, 3, 100.0, 200.0), (3, 1, 5.0, 6.0)], "k int, e int, frame_start double, frame_end double")
    got = curves.event_light_curves(series, ev, ["k"], "f", F.lit(300)).groupBy("e").agg(F.min("f").alias("a"), F.max("f").alias("b"), F.count("*").alias("n")).collect()
    assert {r.e: (r.a, r.b, r.n) for r in got} == {1: (0, 16, 17), 2: (285, 299, 15), 3: (90, 211, 122)}
    assert curves.event_light_curves(series, ev.filter("e = 1 and k = 1"), ["k"], "f", F.lit(300), buffer=-1).count() == 300
    assert curves.event_light_curves(series.limit(0), ev, ["k"], "f", F.lit(300)).count() == 0


@pytest.mark.parametrize(
    "s, e, p, n, interval, want",
    [(10, 12, 11, 100, 1, [8, 9, 10, 11, 12, 13, 14]), (0, 0, 0, 100, 1, [0, 1, 2]), (10, 11, 10, 100, 4, [8, 10, 12, 16, 20]), (97, 99, 99, 100, 1, [95, 96, 97, 98, 99]), (1, 1, 40, 100, 9, [0, 40, 49, 58, 67])],
)
def test_cutout_frames(spark, s, e, p, n, interval, want):
    row = spark.createDataFrame([(s, e, p)], "s long, e long, p long")
    assert row.select(curves.cutout_frames(F.col("s"), F.col("e"), F.col("p"), F.lit(n), interval=interval)).first()[0] == want


def test_times_clamp_to_the_last_frame_and_nulls_stay(spark):
    times = spark.createDataFrame([(f, 100 + f / 10) for f in range(10)], "frame long, mjd double")
    ev = spark.createDataFrame([(1, 4, 1, 2), (2, 4, 2, 5), (3, 1, None, 3)], "k int, frame_bin int, frame_start long, frame_end long")
    got = {r.k: (r.mjd_start, r.mjd_end) for r in curves.true_times(ev, times, ("frame_start", "frame_end")).collect()}
    assert got == {1: (100.4, 100.8), 2: (100.8, 100.9), 3: (None, 100.3)}


def test_frame_after_falls_back_to_one_before(spark):
    # thirty-seconds, as their differences are exact
    series = spark.createDataFrame([(1, f, f / 32) for f in range(10)] + [(2, 0, 0.0)], "k int, f int, t double")
    peaks = spark.createDataFrame([(1, 8 / 32), (2, 0.0), (3, 0.0)], "k int, peak double")
    assert {r.k: r.after for r in curves.frame_after(series, peaks, ["k"], "f", "t", "peak", 1 / 16).collect()} == {1: 6, 2: None, 3: None}
    early = spark.createDataFrame([(1, 3 / 32)], "k int, peak double")
    assert curves.frame_after(series, early, ["k"], "f", "t", "peak", 1 / 16).first().after == 5


def test_units_fall_back_to_counts_and_repeated_zeropoints_add_no_rows(spark):
    lc = spark.createDataFrame([(1, 100.0, 1.0), (2, 100.0, 1.0), (3, 100.0, 1.0)], "cut int, flux double, flux_err double")
    zp = spark.createDataFrame([(1, 20.0), (1, 20.0), (3, None)], "cut int, zp_ab double")
    got = {r.cut: (round(r.flux, 6), r.units) for r in curves.in_units(lc, zp, ["cut"], "Jy").collect()}
    assert got == {1: (round(100 * 3631 / 10**8, 6), "Jy"), 2: (100.0, "counts"), 3: (100.0, "counts")}


def test_sphere_join_equals_all_pairs_at_poles_and_across_zero(spark):
    rng = np.random.default_rng(3)
    ra = np.r_[rng.uniform(0, 360, 120), 0.0, 359.9, 360.0, 10.0, 190.0, 5.0]
    dec = np.r_[np.degrees(np.arcsin(rng.uniform(-1, 1, 120))), 1.0, 1.0, 1.0, 89.5, 89.5, 90.0]
    pts = spark.createDataFrame([(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))], "id int, ra double, dec double")
    v = np.c_[np.cos(np.radians(dec)) * np.cos(np.radians(ra)), np.cos(np.radians(dec)) * np.sin(np.radians(ra)), np.sin(np.radians(dec))]
    away = np.degrees(2 * np.arcsin(np.minimum(1, np.linalg.norm(v[:, None] - v[None], axis=2) / 2)))
    for radius in (0.7, 3.0, 25.0):
        got = sorted((r.l_id, r.r_id) for r in spatial.sky_within(pts, pts, radius).collect())
        assert got == sorted(map(tuple, np.argwhere(away <= radius).tolist()))


def test_pixels_about_a_place(spark):
    rng = np.random.default_rng(5)
    img = rng.normal(0, 1, (6, 7))
    img[2, 3], img[5, 6] = -9.0, 50.0
    df = spark.createDataFrame([(1, [float(x) for x in img.ravel()], 6, 5), (2, [], 3, 2)], "frame int, img array<double>, x int, y int")
    got = {r[0]: r[1:] for r in df.select("frame", detect.annulus_deviation(F.col("img"), F.col("x"), F.col("y"), 7, 6), detect.deepest_below(F.col("img"), F.lit(3), F.lit(3), 7, 6)).collect()}
    jj, ii = np.mgrid[-11:12, -11:12]
    out = ii**2 + jj**2 > 4
    ring = img[np.clip(5 + jj[out], 0, 5), np.clip(6 + ii[out], 0, 6)]
    assert math.isclose(got[1][0], ring.std(), rel_tol=1e-9) and got[1][1] == 9.0 and got[2][0] is None
    noise = {r.frame: r.noise for r in detect.clipped_noise(df).collect()}
    v = img.ravel()
    for _ in range(5):
        v = v[np.abs(v - np.median(v)) <= 3 * v.std()]
    assert math.isclose(noise[1], v.std(), rel_tol=1e-9) and noise[2] is None


def test_candidates_and_staged_classes(spark):
    ev = spark.createDataFrame([(1, 2.0, 0.1, 5.0, 5.0, 5.0, 1), (2, 2.0, 0.1, 5.0, 50.0, 5.0, 1), (3, 2.0, 0.1, 5.0, 50.0, 5.0, 7), (4, 1.0, 0.1, 5.0, 5.0, 5.0, 1), (5, 2.0, 0.1, None, 5.0, 5.0, 1)], "id int, mjd_start double, mjd_duration double, lc_sig_max double, xccd double, yccd double, cut int")
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    ids = lambda **k: sorted(r.id for r in filters.candidates_in_region(ev, square, 1.0, 3.0, 1.0, **k).collect())
    assert ids() == [1] and ids(whole_cuts=(7,)) == [1, 3] and ids(whole_cuts=(7,), cuts=(2,)) == [3]
    m = spark.createDataFrame([(1.0, 0.0), (0.75, 0.69), (0.75, 0.7), (0.5, 0.9), (0.49, 1.0), (None, 1.0)], "m double, g double")
    got = [r[0] for r in m.select(filters.moving_class(F.col("m"), F.col("g"), F.lit("-"))).collect()]
    assert got == ["Asteroid", "-", "Asteroid", "Asteroid", "-", "-"]


def test_null_positions_and_bounds_give_null(spark):
    df = spark.createDataFrame([(None, 1, [1.0, 2.0, 3.0, 4.0])], "x int, y int, img array<double>")
    lo, hi = curves.window_bounds(F.col("x"), F.col("y"), F.lit(9), 2)
    box = curves.cutout_box(F.col("x"), F.col("y"), 2, 2)
    got = df.select(lo, hi, curves.cutout_frames(F.col("x"), F.col("y"), F.col("y"), F.lit(9)), box[0], box[1], box[3], detect.annulus_deviation(F.col("img"), F.col("x"), F.col("y"), 2, 2), detect.deepest_below(F.col("img"), F.col("x"), F.col("y"), 2, 2)).first()
    assert tuple(got) == (None, None, None, None, None, 1, None, None)


def test_tables_by_suffix_lines_and_curves(spark, tmp_path):
    schema = T._parse_datatype_string("a int, b double")
    df = spark.createDataFrame([(1, 0.5), (2, None)], schema)
    for suffix in ("parquet", "csv"):
        path = files.save_table(df, f"{tmp_path}/t.{suffix}")
        files.save_table(df, path)
        assert sorted(files.load_table(spark, path, schema).collect()) == sorted(df.collect())
    for wrong in (lambda: files.load_table(spark, f"{tmp_path}/t.txt"), lambda: files.save_table(df, f"{tmp_path}/t.txt"), lambda: files.load_table(spark, f"{tmp_path}/t.csv")):
        with pytest.raises(ValueError):
            wrong()
    got = files.lines_table(spark, ["# a b", "1 2.5", "", "  3   x"], schema).collect()
    assert [tuple(r) for r in got] == [(1, 2.5), (3, None)]
    lc = spark.createDataFrame([(o, float(t), 1.0, 0.1) for o in (7, 8) for t in (3, 1, 2)], "objid int, mjd double, flux double, flux_err double")
    name = curves.curve_name(F.lit(1), F.lit(2), F.lit(3), F.lit(4), F.col("objid"), None, "aperture", "counts")
    files.save_curves(lc, f"{tmp_path}/lc", name)
    one = f"{tmp_path}/lc/name=S1C2C3C4O7_aperture_counts.csv"
    assert [r.mjd for r in spark.read.option("header", True).schema("mjd double, flux double, flux_err double").csv(one).collect()] == [1.0, 2.0, 3.0]


def test_tracks_grow_by_the_first_that_fits(spark):
    tracks = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 0.0, 0.0), (2, 0.0, 0.0, 1.0, 1.0, 0.0)], "track int, t_ref double, x0 double, vx double, y0 double, vy double")
    pts = spark.createDataFrame([(1, 10.5, 0.9, 10.5, None), (2, 10.5, 1.5, 10.5, None), (3, 10.5, 2.0, 10.5, None), (4, 50.0, 50.0, 1.0, 2), (5, 1.0, 1.0, None, None)], "id int, x double, y double, t double, track int")
    assert {r.id: r.track for r in clusters.grow_tracks(pts, tracks, 1.0, "id").collect()} == {1: 1, 2: 2, 3: None, 4: 2, 5: None}
    assert clusters.grow_tracks(pts.filter("id = 4"), tracks, 1.0, "id").first().track == 2
    assert clusters.grow_tracks(pts, tracks.limit(0), 1.0, "id").filter("track is null").count() == 4
