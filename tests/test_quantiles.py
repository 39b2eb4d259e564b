"""Exact quantiles of groups larger than a task may hold."""

import numpy as np
import pytest

from chronoloom.operators import robust


@pytest.mark.parametrize("share", [0.05, 0.5, 1.0])
def test_ranks_are_exact_whatever_the_values(spark, share):
    rng = np.random.default_rng(3)
    groups = {
        "even": rng.normal(size=5000), "odd": rng.normal(size=4001), "heavy": 10.0 ** rng.uniform(-300, 300, 6000), "ties": rng.integers(0, 4, 5000).astype(float), "one": np.full(3000, 7.5),
        "small": rng.normal(size=12), "two": np.repeat([1.0, 2.0], 2000), "edge": np.concatenate([np.full(2999, -1.0), [5.0]]), None: rng.normal(size=3000), "lone": np.array([4.0]),
    }
    rows = [(k, float(v), 1) for k, vs in groups.items() for v in vs] + [("even", None, 1), ("odd", float("nan"), 1), ("void", None, 1)]
    df = spark.createDataFrame(rows, "k string, v double, n int")
    got = {r.k: r for r in robust.quantile(df, ["k"], "v", share, out="q", count="size", held=100).collect()}
    assert set(got) == {*groups, "void"} and got["void"].q is None and got["void"]["size"] == 0
    for k, vs in groups.items():
        assert got[k].q == pytest.approx(np.quantile(vs, share), rel=1e-12, abs=1e-300) and got[k]["size"] == len(vs), k


def test_whole_table_and_empty(spark):
    df = spark.createDataFrame([(float(i % 101),) for i in range(3000)], "v double")
    assert robust.quantile(df, [], "v", held=50).collect()[0].asDict() == {"median": float(np.median([i % 101 for i in range(3000)])), "n": 3000}
    assert robust.quantile(df.limit(0).withColumnRenamed("v", "w").selectExpr("w", "w as k"), ["k"], "w").count() == 0


def test_measures_built_on_it_agree(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(int(g), float(v)) for g in range(3) for v in rng.normal(20, 1, 700)], "g int, v double")
    want = [sorted(map(tuple, f().collect())) for f in (lambda: robust.mad_by_group(df, ["g"], "v"), lambda: robust.zeropoint_series(df, ["g"], "v"), lambda: robust.sigma_clip(df, ["g"], "v", 2.0, 3))]
    monkeypatch.setattr(robust.quantile, "__defaults__", (*robust.quantile.__defaults__[:-2], 60, None))
    monkeypatch.setattr(robust.has_large, "__defaults__", (60,))
    got = [sorted(map(tuple, f().collect())) for f in (lambda: robust.mad_by_group(df, ["g"], "v"), lambda: robust.zeropoint_series(df, ["g"], "v"), lambda: robust.sigma_clip(df, ["g"], "v", 2.0, 3))]
    for a, b in zip(want, got):
        assert [pytest.approx(r, rel=1e-12) for r in a] == b


def test_keys_may_have_any_name(spark):
    rows = [(g, h, float(i % 37 * (g + h + 1))) for g in range(2) for h in range(2) for i in range(400)]
    df = spark.createDataFrame(rows, "b int, k0 int, lo double")
    got = {(r.b, r.k0): (r.m, r.v0) for r in robust.quantile(df, ["b", "k0"], "lo", 0.68, out="m", count="v0", held=50).collect()}
    assert got == {(g, h): (pytest.approx(np.quantile([i % 37 * (g + h + 1) for i in range(400)], 0.68)), 400) for g in range(2) for h in range(2)}
