"""Periodograms, their peaks and harmonics against plain loops, and a short period in a long series."""

import numpy as np
import pytest

from chronoloom.operators import periods


def plain_power(t, v, oversample):
    span, n, u = t[-1] - t[0], len(t), v - v.mean()
    out = []
    for k in range(int((n / 2 - 1) * oversample) + 1):
        x = 2 * np.pi * (1 / span + k / (span * oversample)) * t
        basis = np.column_stack([np.cos(x), np.sin(x)])
        got = np.linalg.lstsq(basis, u, rcond=None)[0]
        out.append(1 - ((u - basis @ got) ** 2).sum() / (u @ u))
    return np.array(out)


def plain_peaks(power, freq, prominence=3.0, distance=20, reach=150):
    p = power / power.mean()
    tops = [i for i in range(1, len(p) - 1) if p[i] > p[i - 1] and p[i] > p[i + 1]]
    kept = set(tops)
    for i in sorted(tops, key=lambda i: (-p[i], -i)):
        if i in kept:
            kept -= {j for j in kept if j != i and abs(i - j) < distance}
    found = {}
    for i in kept:
        feet = []
        for step in (-1, 1):
            low, j = p[i], i
            while 0 <= j < len(p) and abs(j - i) <= reach and p[j] <= p[i]:
                low = min(low, p[j])
                j += step
            feet.append(low)
        if p[i] - max(feet) >= prominence:
            found[i] = p[i] - max(feet)
    left, out, signal = sorted(found, key=lambda i: (-found[i], i)), {}, 0
    while left:
        signal += 1
        ratio = {i: freq[i] / freq[left[0]] for i in left}
        own = [i for i in left if np.floor(ratio[i] * 10 + 0.5) / 10 - ratio[i] // 1 <= 3 * (freq[1] - freq[0])]
        out |= {i: (signal, int(ratio[i] // 1), found[i]) for i in own}
        left = [i for i in left if i not in own]
    return out


def test_powers_and_peaks_equal_plain_loops(spark, monkeypatch):
    rng = np.random.default_rng(12)
    series = {}
    for name, n in (("a", 150), ("b", 301), ("short", 5), ("flat", 40)):
        t = np.sort(rng.uniform(0, 50, n)) + 1000
        wave = 3 * np.sin(2 * np.pi * t / 4.1) + 1.5 * np.sin(2 * np.pi * t / 2.05 + 1) + (2 * np.cos(2 * np.pi * t / 0.77) if name == "b" else 0)
        series[name] = t, np.full(n, 2.0) if name == "flat" else wave + rng.normal(0, 0.5, n)
    rows = [(k, float(a), float(b)) for k, (t, v) in series.items() for a, b in zip(t, v)] + [("a", None, 1.0), ("b", 3.0, None), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "key string, t double, v double").repartition(3)
    monkeypatch.setattr(periods, "SLICE", 60)  # several slices a series
    spectrum = periods.periodogram(df, ["key"], "t", "v").cache()
    got = {}
    for r in spectrum.collect():
        got.setdefault(r.key, {})[r.k] = r
    assert set(got) == {"a", "b"}
    lists = {}
    for r in periods.peaks(spectrum, ["key"]).collect():
        lists.setdefault(r.key, {})[r.k] = (r.signal, r.harmonic, pytest.approx(r.prominence, rel=1e-6))
    for key in ("a", "b"):
        want = plain_power(*series[key], 5)
        mine = [got[key][k] for k in range(len(got[key]))]
        assert [r.power for r in mine] == pytest.approx(want, abs=1e-8)
        assert plain_peaks(want, np.array([r.frequency for r in mine])) == lists[key]
    assert len(lists["b"]) >= 3 and {s for s, *_ in lists["b"].values()} >= {1, 2}
    best = {r.key: r for r in periods.fourier_period(df, ["key"], "t", "v").collect()}
    assert abs(best["a"].period - 4.1) < 0.05 and abs(best["a"].r21 - 0.5) < 0.1 and best["flat"].period is None and best["short"].period is None and set(best) == {*series, None}


def test_eight_hours_in_thirty_days_of_a_hundred_thousand_samples(spark):
    n = 100_000
    t = np.sort(np.random.default_rng(7).uniform(0, 30, n))
    v = np.sin(2 * np.pi * t * 3) + 0.3 * np.sin(2 * np.pi * t * 6 + 1) + np.random.default_rng(8).normal(0, 2, n)
    t, u = t - t[0], v - v.mean()
    span, many = t[-1], n // 2
    power = np.zeros(many)
    for at in range(0, many, periods.BLOCK):
        size = min(periods.BLOCK, many - at)
        uc, us, _, _ = periods.block_sums(t, u, (1 + at) / span, 1 / span, size)
        power[at : at + size] = uc * uc + us * us
    assert abs(span / (1 + power.argmax()) * 24 - 8) < 0.1


def test_blocks_add_up(spark, monkeypatch):
    rng = np.random.default_rng(5)
    t, u = np.sort(rng.uniform(0, 9, 700)), rng.normal(size=700)
    whole = periods.block_sums(t, u, 0.11, 0.02, 1000)
    x = 2 * np.pi * np.outer(0.11 + 0.02 * np.arange(1000), t)
    assert whole == pytest.approx(np.stack([np.cos(x) @ u, np.sin(x) @ u, np.cos(2 * x).sum(1), np.sin(2 * x).sum(1)]), abs=1e-8)
    monkeypatch.setattr(periods, "STEP", 64)
    assert periods.block_sums(t, u, 0.11, 0.02, 1000) == pytest.approx(whole, abs=1e-8)


def test_feet_are_found_however_far_they_may_lie(spark):
    power = [0.0, 9.0, 1.0, 0.5, 8.0, 0.2, 0.1, 0.3] + [0.0] * 40
    s = spark.createDataFrame([(1, k, 1.0 + k, p) for k, p in enumerate(power)], "id int, k long, frequency double, power double")
    got = {reach: sorted(map(tuple, periods.peaks(s, ["id"], distance=2, reach=reach).select("k", "power", "prominence").collect())) for reach in (47, 2_000_000_000)}
    assert got[47] == got[2_000_000_000] and [g[0] for g in got[47]] == [1, 4]


def test_a_period_needs_no_signals_and_leaves_out_what_is_not_finite(spark, monkeypatch):
    rng = np.random.default_rng(3)
    t = np.sort(rng.uniform(0, 60, 200))
    rows = [("a", float(a), float(np.sin(2 * np.pi * a / 3.3) + 0.2 * b)) for a, b in zip(t, rng.normal(size=200))]
    odd = [("a", 1.5, float("inf")), ("a", float("-inf"), 1.0), ("a", 2.5, float("nan")), ("b", 1.0, float("inf"))]
    monkeypatch.setattr(periods, "peaks", None)  # a round for each signal
    got = {r.key: r for r in periods.fourier_period(spark.createDataFrame(rows + odd, "key string, t double, v double"), ["key"], "t", "v").collect()}
    assert abs(got["a"].period - 3.3) < 0.05 and got["b"].period is None
