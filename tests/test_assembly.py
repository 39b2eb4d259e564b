"""Event assembly against a plain loop over each object's light curve."""

import numpy as np
import pytest

from chronoloom.operators import assembly


def plain_measure(lc, start, end, sign, covered, buffer, window):
    """Nearest frames bound the baseline; positions are those of the time-ordered samples."""
    frames, times, flux = lc
    nearest = lambda t: frames[int(np.argmin(np.abs(times - t)))]
    t0, t1 = times[frames == start][0], times[frames == end][0]
    b0, b1, w0, w1 = nearest(t0 - buffer), nearest(t1 + buffer), nearest(t0 - buffer - window), nearest(t1 + buffer + window)
    ground = ~np.isin(frames, covered) & (((frames > w0) & (frames < b0)) | ((frames < w1) & (frames > b1)))
    own = flux[(frames >= start) & (frames <= end)]
    peak = max(own) if sign > 0 else min(own)
    frame = min(f for f, v in zip(frames, flux) if start <= f <= end and v == peak)
    base = flux[ground]
    if len(base) < 2 or base.std() == 0:
        return None, None, peak, frame, None, None
    med, std = np.median(base), base.std()
    top, mean = (peak - med) / std, (own.mean() - med) / std
    return med, std, peak, frame, top if sign > 0 else abs(top), mean if sign > 0 else abs(mean)


def plain_extend(lc, start, end, sign, med, std, triggers, level=3.0, misses=5):
    frames, _, flux = lc
    hit = set() if std is None else {f for f, v in zip(frames, flux) if (v - med) / std * sign >= level}
    found = set(triggers) | {f for f in hit if start <= f <= end}
    for step, at in ((1, end), (-1, start)):
        count = 0
        while count < misses:
            at += step
            if at in hit:
                found.add(at)
            else:
                count += 1
    return min(found), max(found), len(found)


@pytest.fixture(scope="module")
def sky():
    """Curves with gaps, plateaus longer than the walk's first reach, dips, and objects without samples."""
    rng = np.random.default_rng(8)
    samples, detections = {}, []
    for obj in range(30):
        frames = np.array([f for f in range(260) if rng.random() > 0.05 or f % 50 == 0])
        flux = np.round(rng.normal(0, 1, len(frames)), 3)
        for _ in range(4):
            at, long, sign = int(rng.integers(20, 240)), int(rng.choice([1, 2, 3, 8, 40])), int(rng.choice([1, 1, -1]))
            flux[(frames >= at) & (frames < at + long) & (rng.random(len(frames)) > 0.08)] += sign * float(rng.choice([4, 8, 12]))
            seen = [int(f) for f in frames if at <= f < at + min(long, 3)]
            detections += [(obj, f, sign, float(rng.integers(1, 9)), float(f), 2.0) for f in seen]
        samples[obj] = frames, frames / 2.0, np.round(flux, 3)
    detections.append((99, 7, 1, 3.0, 1.0, 2.0))
    return samples, detections


@pytest.mark.parametrize("reach", [5, 64])
def test_chain_equals_a_plain_loop(spark, sky, reach, monkeypatch):
    samples, detections = sky
    own = assembly.extend.__defaults__
    monkeypatch.setattr(assembly.extend, "__defaults__", (*own[:-1], reach))
    det = spark.createDataFrame([(o, f, f / 2.0, s, snr, x, y) for o, f, s, snr, x, y in detections], "objid long, frame long, time double, flux_sign int, snr double, x double, y double")
    lc = spark.createDataFrame([(o, int(f), float(t), float(v)) for o, (fs, ts, vs) in samples.items() for f, t, v in zip(fs, ts, vs)], "objid long, frame long, time double, flux double")
    got = {(r.objid, r.eventid): r for r in assembly.assemble_events(det, lc, ["objid"], 4, 3.0, 30.0).collect()}
    want = 0
    for obj, curve in samples.items():
        mine = sorted({(f, s) for o, f, s, *_ in detections if o == obj})
        order = sorted({s for _, s in mine}, key=lambda s: (min(f for f, z in mine if z == s), -s))
        events = []
        for s in order:
            runs = []
            for f in sorted(f for f, z in mine if z == s):
                if runs and f - runs[-1][-1] <= 4:
                    runs[-1].append(f)
                else:
                    runs.append([f])
            events += [(s, r) for r in runs]
        bounds = []
        for s, run in events:
            med, std, *_ = plain_measure(curve, run[0], run[-1], s, [], 3.0, 30.0)
            bounds.append((s, *plain_extend(curve, run[0], run[-1], s, med, std, run)))
        cover = {}
        for i, (_, a, b, _) in enumerate(bounds):
            cover |= {f: i for f in range(a, b + 1)}
        for i, (s, a, b, n) in enumerate(bounds):
            med, std, peak, frame, top, mean = plain_measure(curve, a, b, s, [f for f, j in cover.items() if j != i], 3.0, 30.0)
            r = got[obj, i + 1]
            assert (r.flux_sign, r.frame_start, r.frame_end, r.n_detections, r.frame_duration, r.total_events) == (s, a, b, n, b - a + 1, len(bounds))
            assert (r.frame_max, r.flux_max) == (frame, peak) and [r.lc_sig_max, r.lc_sig_med] == (pytest.approx([top, mean]) if top is not None else [None, None])
            want += 1
    lone = got[99, 1]
    assert len(got) == want + 1 and (lone.frame_start, lone.frame_end, lone.n_detections, lone.lc_sig_max, lone.e_x) == (7, 7, 1, None, None)
    assert max(r.frame_duration for r in got.values()) > 10 and {r.flux_sign for r in got.values()} == {1, -1}


def test_moving_events_are_found_again(spark):
    flux = [0.0, 1.0] * 15 + [9.0, 9.0, 9.0, 9.0] + [0.0, 1.0] * 15
    lc = spark.createDataFrame([(1, f, float(f), v) for f, v in enumerate(flux)], "objid long, frame long, time double, flux double")
    rows = [(1, 1, -1, 31, 32, 31.0, 32.0, 2, 2, "Asteroid"), (1, 2, 1, 50, 50, 50.0, 50.0, 1, 1, "-")]
    events = spark.createDataFrame(rows, "objid long, eventid long, flux_sign int, frame_start long, frame_end long, time_start double, time_end double, frame_duration long, n_detections long, classification string")
    got = {r.eventid: r for r in assembly.recheck_moving(lc, events, ["objid"], 3.0, 15.0).collect()}
    assert (got[1].frame_start, got[1].frame_end, got[1].time_end, got[1].n_detections, got[1].frame_duration, got[1].flux_sign) == (30, 33, 33.0, 4, 3, -1)
    assert tuple(got[2]) == rows[1]


def test_nothing_detected(spark):
    det = spark.createDataFrame([], "objid long, frame long, time double, flux_sign int, snr double, x double, y double")
    lc = spark.createDataFrame([(1, 1, 1.0, None)], "objid long, frame long, time double, flux double")
    assert assembly.assemble_events(det, lc, ["objid"], 4, 3.0, 30.0).count() == 0


def test_measures_are_made_without_pairs_of_samples_and_events(spark, monkeypatch):
    monkeypatch.setattr(assembly, "_meet", None)  # each event met its surroundings there, and the pairs were shuffled
    rng = np.random.default_rng(3)
    curves = {("a", 1): np.round(rng.normal(0, 1, 400), 3), ("a", 2): np.full(400, 0.1), ("b", 1): np.round(rng.normal(5, 2, 400), 3)}
    lost = {5, 30, 31, 200}
    lc = [(*k, f, f / 2.0, None if f in lost else float(v)) for k, vs in curves.items() for f, v in enumerate(vs) if f % 11] + [("a", None, 3, 1.5, 1.0), ("c", 1, 4, 2.0, None)]
    spans = [(1, 60, 64, 1), (2, 63, 63, -1), (3, 150, 301, 1), (4, 5, 5, 1)]
    events = [(*k, e, s, a, b, a / 2.0, b / 2.0) for k in curves for e, a, b, s in spans] + [("c", 1, 1, 1, 4, 4, 2.0, 2.0), ("c", 1, 2, 1, 4000, 4000, 2000.0, 2000.0), ("d", 1, 1, 1, 4, 4, 2.0, 2.0)]
    samples = spark.createDataFrame(lc, "field string, objid long, frame int, time double, flux double")
    df = spark.createDataFrame(events, "field string, objid long, eventid long, flux_sign int, frame_start int, frame_end int, time_start double, time_end double")
    for masked in (False, True):
        got = {(r.field, r.objid, r.eventid): r for r in assembly.measure(samples, df, ["field", "objid"], 3.0, 30.0, masked).collect()}
        assert len(got) == len(events) and got["c", 1, 2].n_base is None and got["d", 1, 1].n_base is None and got["c", 1, 1].n_base == 0
        for k in curves:
            own = [(f, v) for *o, f, _, v in lc if tuple(o) == k]
            fs, ts = np.array([f for f, _ in own]), np.array([f / 2.0 for f, _ in own])
            for e, a, b, s in spans:
                near = lambda t: min(fs, key=lambda f: (abs(f / 2.0 - t), f))  # noqa: B023, E731
                w0, b0, b1, w1 = near(a / 2 - 33), near(a / 2 - 3), near(b / 2 + 3), near(b / 2 + 33)
                other = {f for f in range(400) if masked and (c := [i for i, x, y, _ in spans if x <= f <= y]) and max(c) != e}
                base = [v for f, v in own if v is not None and f not in other and (w0 < f < b0 or b1 < f < w1)]
                seen = [(v, f) for f, v in own if v is not None and a <= f <= b]
                r = got[*k, e]
                flat = len(base) < 2 or k[1] == 2
                assert r.n_base == len(base) and r.base_std == (None if flat else pytest.approx(np.std(base))) and r.base_median == (pytest.approx(np.median(base)) if len(base) > 1 else None)
                if seen:
                    v = max(v for v, _ in seen) if s > 0 else min(v for v, _ in seen)
                    assert (r.flux_max, r.frame_max) == (v, min(f for w, f in seen if w == v))
                else:
                    assert r.flux_max is None and r.frame_max is None
