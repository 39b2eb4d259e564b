"""Operators against independent statements of what they do, on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from chronoloom.functions import photometry, sky, values
from chronoloom.operators import clusters, detect, filters, fit, periods, resolve, rollup, series, spatial
from chronoloom.operators.components import connected_components
from chronoloom.sources import files
from chronoloom.sources.shared import materialize


def test_sessions_join_at_the_gap_and_part_beyond(spark):
    df = spark.createDataFrame([(1, 0), (1, 5), (1, 10), (1, 16), (2, 3)], "k int, t int")
    got = {(r.k, r.t): r.eventid for r in series.sessions(df, ["k"], "t", 5).collect()}
    assert got == {(1, 0): 1, (1, 5): 1, (1, 10): 1, (1, 16): 2, (2, 3): 1}


def test_extension_counts_misses_in_all(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for k in range(60):
        sig = rng.choice([1.0, 4.0], 40, p=[0.6, 0.4])
        s = int(rng.integers(10, 20))
        e = s + int(rng.integers(0, 6))
        hits = [i for i in range(s, e + 1) if sig[i] >= 3]
        for walk in (range(e + 1, 40), range(s - 1, -1, -1)):
            miss = 0
            for i in walk:
                miss += sig[i] < 3
                if miss == 5:
                    break
                if sig[i] >= 3:
                    hits.append(i)
        want[k] = (min(hits, default=s), max(hits, default=e), len(hits))
        rows += [(k, i, float(sig[i]), s, e) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, f int, sig double, s int, e int")
    got = {r.k: (r.frame_start, r.frame_end, r.n_detections) for r in series.extend(df, ["k"], "f", "sig", "s", "e").collect()}
    assert got == want


def test_components_of_loops_chains_and_nothing(spark):
    edges = spark.createDataFrame([(1, 1), (2, 3), (3, 2), (3, 4), (10, 9), (9, 8), (8, 7), (None, 5)], "u long, v long")
    assert {(r.node, r.component) for r in connected_components(edges).collect()} == {(2, 2), (3, 2), (4, 2), (7, 7), (8, 7), (9, 7), (10, 7)}
    assert connected_components(edges.filter("u > 99")).count() == 0


def test_long_chain_of_components(spark):
    n = 300
    order = np.random.default_rng(1).permutation(n).tolist()
    edges = spark.createDataFrame(list(zip(order[:-1], order[1:])), "u long, v long")
    assert connected_components(edges).agg(F.countDistinct("component"), F.count("*")).first() == (1, n)


def test_weighted_mean_of_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "a", 0), (1, 3.0, float("nan"), "b", 1), (1, 1.0, 4.0, "c", 2), (2, 5.0, 7.0, "d", 0)], "k int, w double, x double, c string, o int")
    got = {r.k: r for r in rollup.weighted_mean_variance(df, ["k"], "w", ["x"], ["c"], "o").collect()}
    assert (got[1].x, got[1].e_x, got[1].c, got[1].n) == (3.0, 1.0, "a", 3)
    assert (got[2].x, got[2].e_x) == (7.0, None)


def test_range_join_on_the_radius_and_across_cells(spark):
    rng = np.random.default_rng(2)
    a, b = rng.uniform(-5, 5, (80, 2)), rng.uniform(-5, 5, (90, 2))
    a[0], b[0] = (0.0, 0.0), (1.0, 0.0)
    left = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(a)], "id int, x double, y double")
    right = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(b)], "id int, x double, y double")
    got = sorted((r.l_id, r.r_id) for r in spatial.within(left, right, 1.0).collect())
    assert got == [(i, j) for i in range(80) for j in range(90) if np.hypot(*(a[i] - b[j])) <= 1.0]


def test_groups_link_points_in_one_place(spark):
    df = spark.createDataFrame([(5, 0.0, 0.0), (3, 0.0, 0.0), (9, 0.4, 0.0), (7, 5.0, 5.0)], "id int, x double, y double")
    assert {r.id: r.group for r in spatial.groups(df, 0.5, "id").collect()} == {5: 3, 3: 3, 9: 3, 7: 7}
    assert {r.id: r.group for r in spatial.groups(df, 0.5, "id", least=2).collect()} == {5: 3, 3: 3, 9: 3, 7: None}


def test_brightest_first_is_greedy(spark):
    df = spark.createDataFrame([(0, 1, 0.0, 0.0, 9.0), (0, 2, 1.0, 0.0, 8.0), (0, 3, 2.0, 0.0, 7.0), (1, 4, 0.5, 0.0, 1.0)], "frame int, id int, x double, y double, flux double")
    assert sorted(r.id for r in spatial.brightest_first(df, ["frame"], 1.5, "flux", "id").collect()) == [1, 3, 4]


def test_polygon_and_cone_over_zero(spark):
    df = spark.createDataFrame([(359.9, 0.0), (0.1, 0.0), (180.0, 0.0), (10.0, 89.95)], "ra double, dec double")
    assert sorted(r.ra for r in spatial.cone(df, 0.0, 0.0, 0.2).collect()) == [0.1, 359.9]
    assert [r.ra for r in spatial.cone(df, 190.0, 89.9, 0.3).collect()] == [10.0]
    tri = [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)]
    pts = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0)], "x double, y double")
    assert [r.inside for r in pts.select(spatial.in_polygon(F.col("x"), F.col("y"), tri).alias("inside")).collect()] == [True, False]


def test_filters_are_tri_state(spark):
    schema = "objid int, gaia_id string, classification string, source_mask int, frame_bin int, crossbin_ids array<bigint>, bad_frame_flag int, lc_flat int, gal_b double, frame_duration int, total_events int, flux_sign int, xcentroid_err double, ycentroid_err double, lc_sig_max double"
    rows = [(1, "-", "VEB", 1, 1, [], 0, 0, -20.0, 4, 2, 1, 0.1, 0.1, 6.0), (1, "7", "Junk", 1, 1, [], 0, 1, 20.0, 4, 2, 1, 0.1, 0.1, 6.0), (2, "8", "Asteroid", 5, 4, [3], 1, 0, 5.0, 4, 9, -1, 2.0, 0.1, 2.0)]
    ev = spark.createDataFrame(rows, schema)
    objects = spark.createDataFrame([(2, "-")], "objid int, gaia_id string")
    n = lambda **k: filters.filter_events(ev, objects, **k).count()
    assert (n(), n(star_free=True), n(star_free=False), n(star_free="hard"), n(exclude=())) == (2, 1, 1, 0, 3)
    assert (n(classification="var"), n(classification="!var"), n(crossbins=False), n(bad_frames=False), n(flat=False)) == (1, 1, 1, 1, 2)
    assert (n(galactic_latitude=10.0), n(galactic_latitude=[0, 10]), n(frame_duration=(None, 4)), n(at_least={"lc_sig_max": 5})) == (1, 1, 1, 1)
    assert (n(total_events=(3, None)), n(flux_sign=-1), n(centroid_error=0.2), n(source_mask_below=4), n(frame_bin=4)) == (1, 1, 1, 1, 1)
    with pytest.raises(TypeError):
        filters.latitude(F.col("gal_b"), "5")


def test_values(spark):
    row = spark.range(1).select(
        values.known(F.lit(float("nan"))).alias("a"), values.wrap_degrees(F.lit(-190.0)).alias("b"), values.round_half_up(F.lit(-2.5)).alias("c"), values.hex_to_int(F.lit("0x1F")).alias("d"),
        values.mjd_of_stamp(F.lit("2020001120000")).alias("e"), values.bin_seconds(F.lit("2hrs")).alias("f"), values.bin_seconds(F.lit("x")).alias("g"), sky.sexagesimal(F.lit(-0.5), False).alias("h"),
        sky.degrees_of(F.lit("-00:30:00"), False).alias("i"), values.ratio(F.lit(1), F.lit(0)).alias("j"), photometry.zeropoint_of_scale(F.lit(-1.0)).alias("k"),
    ).first()
    assert tuple(row) == (None, 170.0, -2, 31, 58849.5, 7200.0, None, "-00:30:00.00", -0.5, None, None)


def test_bazin_fit_finds_the_truth(spark):
    t = np.arange(0, 60, 1.0)
    rng = np.random.default_rng(3)
    f = fit.bazin(t, 40.0, 20.0, 1.5, 8.0, 2.0) + rng.normal(0, 0.3, len(t))
    df = spark.createDataFrame([(1, float(a), float(b), 0.3) for a, b in zip(t, f)] + [(2, 0.0, 1.0, 0.3)], "k int, t double, f double, e double")
    got = {r.k: r for r in fit.fit_bazin(df, ["k"], "t", "f", "e").collect()}
    assert got[1].fit_ok and abs(got[1].A - 40) < 2 and abs(got[1].t0 - 20) < 0.5 and abs(got[1].tau_fall - 8) < 0.6 and got[1].delta_bic < -100
    assert not got[2].fit_ok and got[2].A is None


def test_period_and_gaussian(spark):
    t = np.sort(np.random.default_rng(4).uniform(0, 40, 200))
    rows = [("p", float(x), float(np.sin(2 * np.pi * x / 3.7))) for x in t] + [("g", float(x), float(5 * np.exp(-0.5 * ((x - 20) / 3) ** 2))) for x in t]
    df = spark.createDataFrame(rows, "k string, t double, v double")
    assert abs({r.k: r.period for r in periods.fourier_period(df, ["k"], "t", "v").collect()}["p"] - 3.7) < 0.05
    score = {r.k: r.gaussian_score for r in fit.gaussian_score(df, ["k"], "t", "v").collect()}
    assert score["g"] > 0.99 > 0.5 > score["p"]


def test_detection_recovers_planted_sources(spark):
    rng = np.random.default_rng(5)
    y, x = np.mgrid[:48, :48]
    image = rng.normal(0, 1, (48, 48)) + 60 * np.exp(-((x - 12) ** 2 + (y - 30) ** 2) / 2.5) - 50 * np.exp(-((x - 33) ** 2 + (y - 9) ** 2) / 2.5)
    frames = spark.createDataFrame([(7, 48, 48, image.ravel().tolist())], "frame long, ny int, nx int, img array<double>")
    got = {(r.flux_sign, r.xint, r.yint) for r in detect.detect(frames, level=8.0).collect()}
    assert {(1, 12, 30), (-1, 33, 9)} <= got and len(got) <= 6
    assert abs(detect.frame_noise(frames).first().noise - 1.0) < 0.1


def test_surface_and_matched_weights(spark):
    rng = np.random.default_rng(6)
    p = rng.uniform(-1, 1, (200, 2))
    df = spark.createDataFrame([(float(a), float(b), float(1 + 2 * a - 3 * b + 0.5 * a * b)) for a, b in p], "x double, y double, z double")
    c = fit.polynomial_surface(df, "x", "y", "z", 2)
    assert abs(c[0, 0] - 1) < 1e-6 and abs(c[1, 0] - 2) < 1e-6 and abs(c[0, 1] + 3) < 1e-6 and abs(c[1, 1] - 0.5) < 1e-6 and abs(c[2, 0]) < 1e-6
    template = rng.random((3, 3))
    stamp = (5 * template + 2).ravel().tolist()
    row = spark.createDataFrame([(stamp,)], "img array<double>").select(fit.dot(F.col("img"), fit.matched_weights(template)).alias("f")).first()
    assert abs(row.f - 5) < 1e-9


def test_files_round_trip(spark, tmp_path):
    np.save(tmp_path / "cube.npy", np.arange(24, dtype=np.float32).reshape(2, 3, 4))
    got = files.read_arrays(spark, str(tmp_path)).orderBy("frame").collect()
    assert [(r.frame, r.ny, r.nx, r.img[5]) for r in got] == [(0, 3, 4, 5.0), (1, 3, 4, 17.0)]
    schema = T.StructType().add("a", T.IntegerType()).add("b", T.DoubleType())
    assert files.read_results(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "t.txt").write_text("# a b\n 1  2.5\n2 --\n\n")
    assert [tuple(r) for r in files.read_spaced(spark, str(tmp_path / "t.txt"), schema).collect()] == [(1, 2.5), (2, None)]
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "e" / "x.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "d" / "y.csv").write_text("# note\na,b\n5,6\n")
    assert files.read_csv_union(spark, str(tmp_path / "d"), schema).count() == 3
    df = spark.createDataFrame([(1, 1, 1, 2, "x")], "sector int, cam int, ccd int, cut int, v string")
    assert files.write_results(df, str(tmp_path / "out"), if_absent=True) and not files.write_results(df, str(tmp_path / "out"), if_absent=True)
    files.write_table(df, str(tmp_path / "text"))
    assert [r.value for r in spark.read.text(str(tmp_path / "text")).collect()] == ["# sector cam ccd cut v", "1 1 1 2 x"]


def test_interval_match_prefers_the_finest_resolution(spark):
    truth = spark.createDataFrame([(1, 9, 0.0, 0.0, 0.0, 10.0, 5.0), (2, 9, 0.0, 0.0, 100.0, 110.0, 101.0), (3, 9, 5.0, 5.0, 0.0, 4.0, 1.0), (4, 9, 50.0, 0.0, 0.0, 1.0, 0.5)], "injid int, k int, x double, y double, start double, end double, peak double")
    ev = spark.createDataFrame([(5, 9, 0.0, 0.0, 0.0, 9.0, 5.0, 4), (6, 9, 0.3, 0.4, 3.0, 12.0, 7.0, 1), (7, 9, 5.0, 5.0, 0.0, 8.0, 3.0, 4)], "eventid int, k int, x double, y double, start double, end double, peak double, frame_bin int")
    alone = spark.createDataFrame([(9, 0.5, 0.5, 110.0), (9, 51.5, 0.0, 0.5)], "k int, x double, y double, start double")
    got = {r.injid: r for r in resolve.match_intervals(truth, ev, ["k"], 50.0, minutes=1.0, isolated=alone).collect()}
    assert {i: (r.detected, r.event) for i, r in got.items()} == {1: ("y", 6), 2: ("iso", None), 3: ("4", 7), 4: ("n", None)}
    # Half a pixel apart, 7 of 12 shared, lengths 10 and 9, peaks 2 of 10 apart.
    assert abs(got[1].score - (0.5 * 0.5 + 2 * (1 - 7 / 12) + 0.5 * math.log(10 / 9) + 0.1 * 0.2)) < 1e-9
    assert abs(got[3].score - (2 * 0.5 + 0.5 * math.log(2) + 0.1 * 0.5)) < 1e-9


def test_shapes_by_hand(spark):
    from chronoloom.functions import photometry as ph

    one = spark.range(1)
    lit = lambda *x: [F.lit(float(v)) for v in x]
    e, w = ph.shape(*lit(4, 1))
    row = one.select(e.alias("e"), w.alias("w"), ph.flux_of_snr(*lit(10, 2, 9, 4)).alias("f"), ph.bazin_exposed(*lit(1, 2, 5, 1, 0.5, 2, 1), samples=3).alias("b"), ph.bazin_exposed(*lit(1, 0, 5, 1, 0.5, 2, 1)).alias("b0")).first()
    assert row.e == 0.75 and abs(row.w - 2 * math.sqrt(2 * math.log(2)) * 2) < 1e-12
    assert abs(row.f / math.sqrt(9 * 4 + row.f / 4) - 10) < 1e-9
    at = lambda t: 5 * math.exp(-(t - 1) / 2) / (1 + math.exp(-(t - 1) / 0.5)) + 1
    assert abs(row.b - (at(0) + at(1) + at(2)) / 3) < 1e-9 and abs(row.b0 - at(1)) < 1e-9
    s = fit.bazin_shape(2.0, 10.0, 0.5, 3.0)
    assert s["tau_ratio"] == 6 and abs(s["fwhm"] - s["rise_time"] - s["decay_time"]) < 1e-9 and s["decay_time"] > s["rise_time"] > 0
    assert fit.bazin_shape(-1.0, 0.0, 1.0, 2.0)["peak"] is None


def test_particle_hits_by_hand(spark):
    cases = {  # id: (bin, sign, duration, detections, significances, class)
        1: (1, 1, 1, 1, [6.0], "CosmicRay"), 2: (1, 1, 1, 1, [4.0], "Junk"), 3: (1, -1, 1, 1, [6.0], "-"), 4: (2, 1, 1, 1, [6.0], "-"), 5: (1, 1, 2, 2, [6.0, 1.0], "CosmicRay"),
        6: (1, 1, 2, 2, [6.0, 4.0], "-"), 7: (1, 1, 3, 2, [6.0, 1.0, 4.0], "CosmicRay"), 8: (1, 1, 3, 2, [4.0, 1.0, 4.5], "Junk"), 9: (1, 1, 3, 2, [4.0, 4.5, 1.0], "-"), 10: (1, 1, 3, 3, [6.0, 1.0, 4.0], "-"),
    }
    samples = spark.createDataFrame([(k, i, s) for k, c in cases.items() for i, s in enumerate(c[4])], "k int, frame int, sig double")
    events = spark.createDataFrame([(k, *c[:4]) for k, c in cases.items()], "k int, frame_bin int, flux_sign int, frame_duration int, n_detections int")
    assert {r.k: r.classification for r in clusters.spike_class(samples, events, ["k"], "frame", "sig").collect()} == {k: c[5] for k, c in cases.items()}


def test_streams(spark, tmp_path):
    from chronoloom.streaming.windows import stream_bins, stream_sessions

    rows = [("a", f"2024-01-01 00:{m:02d}:00", float(m)) for m in (0, 4, 30, 31)] + [("a", "2024-01-02 00:00:00", 0.0)]
    spark.createDataFrame(rows, "k string, t string, v double").select("k", F.to_timestamp("t").alias("t"), "v").write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema("k string, t timestamp, v double").parquet(str(tmp_path / "in"))
    for name, df in (("sessions", stream_sessions(source(), ["k"], "t", "v", "5 minutes", "1 minute")), ("bins", stream_bins(source(), ["k"], "t", "v", "10 minutes", "1 minute"))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert sorted((r.n, r.mean) for r in spark.table("sessions").collect()) == [(2, 2.0), (2, 30.5)]
    assert sorted((r.n, r.mean) for r in spark.table("bins").collect()) == [(2, 2.0), (2, 30.5)]


def test_materialized_tables_survive(spark):
    df = materialize(spark.range(5), "x")
    assert df.count() == 5 and df.filter("id > 2").count() == 2


def test_density_clusters_take_borders_and_leave_noise(spark):
    from chronoloom.operators.clusters import density_clusters

    pts = [(1, 0.0), (2, 0.5), (3, 1.0), (4, 2.0), (5, 9.0), (6, 9.5)]
    df = spark.createDataFrame([(i, x, 0.0) for i, x in pts], "id int, x double, y double")
    assert {r.id: r.cluster for r in density_clusters(df, 1.0, 3, "id").collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: None, 6: None}


def test_injected_light_is_all_there(spark):
    from chronoloom.operators.inject import add_to_pixels, light_curves

    inj = spark.createDataFrame([(1, "flare", 2, 10.0, 3.0), (2, "negative", 0, 4.0, 2.0)], "injid int, event_type string, start int, height double, scale double")
    curves = light_curves(inj, 6)
    pixels = spark.range(6 * 400).selectExpr("cast(id div 400 as int) as frame", "cast(id % 20 as int) as x", "cast((id div 20) % 20 as int) as y", "1.0D as flux")
    places = spark.createDataFrame([(1, 5, 5), (2, 12, 12)], "injid int, x int, y int")
    out = {r.frame: r.total for r in add_to_pixels(pixels, curves, places, 1.0).groupBy("frame").agg(F.sum("flux").alias("total")).collect()}
    want = {r.frame: r.f for r in curves.groupBy("frame").agg(F.sum("flux").alias("f")).collect()}
    assert all(abs(out[f] - 400 - want[f]) < 1e-9 for f in range(6))


def test_headers_and_manifests(spark, tmp_path):
    card = lambda k, v: f"{k:<8}= {v:>20}".ljust(80)
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "a.fits").write_bytes((card("SIMPLE", "T") + card("CRPIX1", "1045.5") + card("NAME", "'abc     '") + "END".ljust(80)).encode() + b"\0" * 100)
    assert files.read_headers(spark, str(tmp_path / "h"), ["CRPIX1", "NAME"]).first().header == {"CRPIX1": "1045.5", "NAME": "abc"}
    (tmp_path / "m.sh").write_text("get x2020001120000-s1-2-3-1_a.fits\nget x2020003000000-s1-2-3-1_a.fits\nget x2020001120000-s1-1-3-1_a.fits\n")
    assert [r.mjd for r in files.manifest(spark, str(tmp_path / "m.sh"), 2, 3, 58849.0, 58850.0).collect()] == [58849.5]
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert files.drop_results(spark, str(tmp_path / "t")) and not (tmp_path / "t").exists()


def test_tracks_at_the_points_own_time(spark):
    tracks = spark.createDataFrame([(1, 10.0, 0.0, 10.0, 0.0, 0.0, 9.5, 11.95)], "track int, t_ref double, x0 double, vx double, y0 double, vy double, t_min double, t_max double")
    points = spark.createDataFrame([(1, 9.0, 0.0, 10.9), (2, 0.0, 0.0, 10.9), (3, -5.0, 0.2, 9.5), (4, 19.6, 0.0, 11.96), (5, 19.5, 0.0, 11.95)], "id int, x double, y double, t double")
    got = {r.id: r.track for r in clusters.link_to_tracks(points, tracks, 0.5, "id").collect()}
    assert got == {1: 1, 2: None, 3: 1, 4: None, 5: 1}


def test_interpolation_beyond_the_knots(spark):
    knots = spark.createDataFrame([(1, 0, 5.0), (1, 10, 15.0)], "k int, x int, y double")
    rows = spark.createDataFrame([(1, -3), (1, 0), (1, 4), (1, 10), (1, 99), (2, 1)], "k int, t int")
    got = {(r.k, r.t): r.interpolated for r in series.interpolate(rows, knots, ["k"], "t", "x", "y", 8).collect()}
    assert got == {(k, t): float(np.interp(t, [0, 10], [5, 15])) if k == 1 else None for k, t in got}


def test_hard_filter_needs_objects(spark):
    ev = spark.createDataFrame([(1, "-", "Star")], "objid int, gaia_id string, classification string")
    with pytest.raises(ValueError):
        filters.filter_events(ev, star_free="hard")


def test_bazin_slopes_are_the_models(spark):
    t, p = np.linspace(-3, 40, 60), [3.0, 8.0, 1.2, 6.0, 0.5]
    for k in range(5):
        up, down = ([v + d * (i == k) * 1e-6 for i, v in enumerate(p)] for d in (1, -1))
        assert np.allclose(fit.bazin_slopes(t, *p)[:, k], (fit.bazin(t, *up) - fit.bazin(t, *down)) / 2e-6, atol=1e-5)


def test_bazin_window_baseline_and_region(spark):
    t = np.arange(0, 200, 1.0)
    rng = np.random.default_rng(9)
    f = fit.bazin(t, 30.0, 100.0, 1.5, 8.0, 4.0) + rng.normal(0, 0.3, len(t)) + np.where(np.abs(t - 30) < 3, 500.0, 0.0)  # another event far off
    rows = [(1, float(a), float(b), 0.3 if i % 50 else -1.0, 95.0, 120.0, 4.0) for i, (a, b) in enumerate(zip(t, f))]
    df = spark.createDataFrame(rows, "k int, t double, f double, e double, s double, z double, c double")
    r = fit.fit_bazin(df, ["k"], "t", "f", "e", window=("s", "z"), baseline="c").collect()[0]
    assert r.fit_ok and r.offset == 4.0 and abs(r.A - 30) < 1.5 and abs(r.tau_fall - 8) < 0.5 and 0.6 < r.redchi2 < 1.5
    assert 25 <= r.n_region <= 40 and r.delta_chi2 > 1000 and abs(r.delta_bic + r.delta_chi2 - 4 * np.log(r.n_region)) < 1e-6
    free = fit.fit_bazin(df, ["k"], "t", "f", "e", window=("s", "z")).collect()[0]
    assert abs(free.offset - 4) < 0.3 and abs(free.A - 30) < 1.5
    assert not fit.fit_bazin(df.filter("t < 5"), ["k"], "t", "f", "e", window=("s", "z")).collect()[0].fit_ok


def test_gaussian_score_where_parameters_stand_for_each_other(spark):
    f = [75.64, 1.97, 3.6, 115.41, 27.42, 300.44, 37.31, 133.84, 199.18, 47.47, 47.76, 149.22, 6.05, 518.46, 8.9, 283.0, 112.06, 133.23, 213.32, 34.1, 55.2, 69.83, 67.97, 9.76, 67.59, 73.95]
    t = [0, 1, 2, 3, 5, 7, *range(9, 24), *range(25, 30)]
    f[10], f[24] = 47.760000000000005, 67.58999999999999
    df = spark.createDataFrame([(1, float(a), b) for a, b in zip(t, f)], "k int, t double, v double")
    assert fit.gaussian_score(df, ["k"], "t", "v").first().gaussian_score == pytest.approx(0.51, abs=1e-3)
