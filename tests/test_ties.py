"""Queries agree with their SQL where values are equal but for rounding."""

import os

import pytest
from compare import DATA, TABLES, differences, duck

from chronoloom.plans import registry


def _differences(spark, tmp_path, name, **tables):
    """Those of a query over sf0.001 with some tables replaced, each given as SQL."""
    con = duck(f"{DATA}/sf0.001")
    for t in TABLES:
        if t in tables:
            con.sql(tables[t]).write_parquet(f"{tmp_path}/{t}.parquet")
        else:
            os.symlink(f"{DATA}/sf0.001/{t}.parquet", f"{tmp_path}/{t}.parquet")
    return differences(spark, str(tmp_path), registry.QUERIES[name], registry.ORACLE_SQL[name])


def test_points_on_the_edges_of_a_polygon(spark, tmp_path):
    # These keys lie at y = 100 or 800 with x under 700.
    assert _differences(spark, tmp_path, "point_in_polygon", customer="select * replace (k::bigint as c_custkey) from (select * from customer limit 1), (values (4565), (14333), (14574), (1)) v(k)") == ""


def test_scores_of_series_of_one_value_and_of_exact_ranks(spark, tmp_path):
    # 0.1 three times has a deviation of rounding alone; of 41 values the cuts are values themselves.
    rows = "select * replace (row_number() over () as event_id, u as user_id, v as value) from (select * from events limit 1), (select 1 as u, 0.1::double as v from range(7) union all select 2, (i * 0.37)::double from range(41) t(i) union all select 3, (i % 3)::double from range(120) t(i))"
    assert _differences(spark, tmp_path, "trimmed_scores", events=rows) == ""
    got = registry.QUERIES["trimmed_scores"](spark, str(tmp_path))
    assert got.count() == 37 + 40  # ranks 2 to 38 of 0 to 40, and of 0, 1 and 2 what is between the ends


def test_values_at_the_mean_of_their_series(spark, tmp_path):
    # 0.1, 0.2, 0.3: whether 0.2 exceeds their mean depends on the order of the sum.
    rows = "select * replace (row_number() over () as event_id, u as user_id, v as value) from (select * from events limit 1), (select u, unnest([0.1 * u, 0.2 * u, 0.3 * u])::double as v from range(1, 40) t(u))"
    assert _differences(spark, tmp_path, "lc_features", events=rows) == ""


@pytest.mark.parametrize("name", ["curved_fit"])
def test_fractions_at_half_a_last_digit(spark, name):
    assert differences(spark, f"{DATA}/sf0.1", registry.QUERIES[name], registry.ORACLE_SQL[name]) == ""


def test_courses_of_points_at_one_time(spark, tmp_path):
    # One, two, three and sixty points at one time, whose acceleration is free; then three at two times and three at three.
    rows = "select * replace (k::bigint as o_orderkey, c::bigint as o_custkey) from (select * from orders limit 1), (select 7 as k, 1 as c union all select 50 * i + 7, 2 from range(2) t(i) union all select 50 * i + 8, 3 from range(3) t(i) union all select 50 * i + 7, 20 from range(60) t(i) union all select i * 25, 30 from range(3) t(i) union all select i * 7, 40 from range(3) t(i))"
    assert _differences(spark, tmp_path, "curved_fit", orders=rows) == ""


def test_sql_adds_up_tracks_in_the_same_order():
    """Distances at the limit are told apart by their last bit, so both sides place each track first."""
    assert "(a.x0 + a.vx * (greatest(a.t_min, b.t_min) - a.t_ref)) - (b.x0 +" in registry.ORACLE_SQL["track_crossings"]
