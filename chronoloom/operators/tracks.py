"""Tracks of moving points: fits with bounded acceleration, points near a course, greedy merging, and the tagging of a whole table.

Points are ``(*keys, id, x, y, t, track)``, track null where there is none, and
tracks ``(*keys, track, n_points, t_ref, x0, vx, ax, y0, vy, ay, t_min, t_max)``;
``keys`` are fields that don't meet, and tracks are named by a point's id, so that
names are unique over all fields.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.operators.clusters import density_clusters_of
from chronoloom.operators.components import connected_components
from chronoloom.operators.spatial import within
from chronoloom.sources.shared import drop_shared, materialize

_COURSE = ["track", "t_ref", "x0", "vx", "ax", "y0", "vy", "ay"]
#: Speeds are told apart by powers of two from this one on.
_SLOWEST = -20
#: How far a track may move in a bucket of time, and how wide a cell is, in radii.
_MOVE, _CELL = 4.0, 6.0


def fit(points: DataFrame, keys: Sequence[str] = (), most_acceleration: float | None = 1.0) -> DataFrame:
    """Tracks of least squares about each one's mean time, as one aggregate of sums.

    Courses are ``x0 + vx u + ax u^2 / 2``. The acceleration of either axis is
    bounded: outside the bound the best course is the best one on it, as the sum of
    squares is convex. None (and tracks under three points): straight. A track at
    one time doesn't move.
    """
    own = points.filter("track is not null")
    mean = own.groupBy(*keys, "track").agg(F.avg("t").alias("t_ref"), F.count("*").alias("n_points"), F.min("t").alias("t_min"), F.max("t").alias("t_max"))
    rows = own.select(*keys, "track", "x", "y", "t").join(mean, [*keys, "track"]).withColumn("u", F.col("t") - F.col("t_ref")).withColumn("q", F.col("u") * F.col("u") / 2)
    s = lambda c: F.sum(c)
    u, q = F.col("u"), F.col("q")
    sums = [s(u * u).alias("_uu"), s(u * q).alias("_uq"), s(q).alias("_q"), s(q * q).alias("_qq")]
    sums += [e for c in "xy" for e in (s(c).alias(f"_{c}"), s(u * F.col(c)).alias(f"_u{c}"), s(q * F.col(c)).alias(f"_q{c}"))]
    m = rows.groupBy(*keys, *mean.columns[len(list(keys)) :]).agg(*sums)
    n, uu = F.col("n_points"), F.when(F.col("t_min") < F.col("t_max"), F.col("_uu"))
    slope = F.coalesce(F.col("_uq") / uu, F.lit(0.0))
    left = F.col("_qq") - F.col("_q") * F.col("_q") / n - slope * F.col("_uq")  # what of q neither 1 nor u explains
    out = {}
    for c in "xy":
        free = (F.col(f"_q{c}") - F.col("_q") / n * F.col(f"_{c}") - slope * F.col(f"_u{c}")) / left
        bend = F.lit(0.0) if most_acceleration is None else F.when((n >= 3) & (left > 1e-12 * F.col("_qq")), F.greatest(F.lit(-most_acceleration), F.least(F.lit(most_acceleration), free))).otherwise(0.0)
        out |= {f"a{c}": bend, f"v{c}": F.coalesce((F.col(f"_u{c}") - F.col(f"a{c}") * F.col("_uq")) / uu, F.lit(0.0)), f"{c}0": (F.col(f"_{c}") - F.col(f"a{c}") * F.col("_q")) / n}
    for name, value in out.items():
        m = m.withColumn(name, value)
    return m.select(*keys, "track", "n_points", *_COURSE[1:], "t_min", "t_max")


def place(axis: str, t: Column, prefix: str = "") -> Column:
    """Where a track is at a time."""
    u = t - F.col(f"{prefix}t_ref")
    return F.col(f"{prefix}{axis}0") + F.col(f"{prefix}v{axis}") * u + F.col(f"{prefix}a{axis}") * u * u / 2


def off(x: Column, y: Column, t: Column, prefix: str = "") -> Column:
    """Distance of a place from a track at a time."""
    dx, dy = x - place("x", t, prefix), y - place("y", t, prefix)
    return F.sqrt(dx * dx + dy * dy)


def _width(radius: float) -> Column:
    """How long a bucket of a speed class is."""
    return F.lit(_MOVE * radius) / F.pow(F.lit(2.0), F.col("_k"))


def _on_the_way(courses: DataFrame, radius: float) -> DataFrame:
    """Courses, once for each bucket of their class from ``t_from`` to ``t_to`` and each cell that holds what they pass there."""
    at = courses.withColumn("_b", F.explode(F.sequence(*[F.floor(F.col(c) / _width(radius)).cast("long") for c in ("t_from", "t_to")])))
    middle, reach = (F.col("_b") + 0.5) * _width(radius), (_MOVE / 2 + 1) * radius * (1 + 1e-9)
    for c in "xy":
        edges = [F.floor((place(c, middle) + m) / (_CELL * radius)).cast("long") for m in (-reach, reach)]
        at = at.withColumn(f"_c{c}", F.explode(F.sequence(*edges)))
    return at


def passes(points: DataFrame, tracks: DataFrame, radius: float, keys: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """``(point columns, r_track, r_<carry>, distance)`` where a track passes under ``radius`` of a point, at times from its ``t_from`` to its ``t_to``.

    Tracks are told apart by speed class; in a class time is bucketed so that no
    track moves further than four radii in a bucket. Then all that it passes lies
    within three radii of its middle there, half a cell, so it is listed in at
    most four cells a bucket: it costs what its course is long, and a fast track
    makes no slow one's cells larger.
    """
    cell = _CELL * radius
    swing = F.greatest(F.abs(F.col("t_from") - F.col("t_ref")), F.abs(F.col("t_to") - F.col("t_ref")))
    speed = F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")) + F.sqrt(F.col("ax") * F.col("ax") + F.col("ay") * F.col("ay")) * swing
    kind = F.greatest(F.lit(_SLOWEST), F.when(speed > 0, F.ceil(F.log2(speed))).otherwise(_SLOWEST)).cast("int")
    courses = tracks.filter("t_from <= t_to").select(*keys, *dict.fromkeys([*_COURSE, *carry]), "t_from", "t_to", kind.alias("_k"))
    found = courses.groupBy("_k").agg(F.max(F.col("t_to") - F.col("t_from"))).collect()  # a number for each power of two of speeds
    longest = max((life for _, life in found), default=0.0)
    # Slower classes than that whose bucket holds the longest life would save nothing.
    least = max(_SLOWEST, math.floor(math.log2(_MOVE * radius / longest))) if longest > 0 else _SLOWEST
    kinds = sorted({max(k, least) for k, _ in found}) or [least]
    courses = courses.withColumn("_k", F.greatest("_k", F.lit(least)))
    at = _on_the_way(courses, radius)
    at = at.select(*[F.col(c).alias(f"r_{c}") for c in [*keys, *dict.fromkeys([*_COURSE, *carry]), "t_from", "t_to"]], *[F.col(c).alias(f"r{c}") for c in ("_k", "_b", "_cx", "_cy")])
    listed = points.withColumn("_k", F.explode(F.array(*map(F.lit, kinds)))).withColumn("_b", F.floor(F.col("t") / _width(radius)).cast("long"))
    listed = listed.withColumns({"_cx": F.floor(F.col("x") / cell).cast("long"), "_cy": F.floor(F.col("y") / cell).cast("long")})
    on = [F.col(c) == F.col(f"r{c}") for c in ("_k", "_b", "_cx", "_cy")] + [F.col(k) == F.col(f"r_{k}") for k in keys]
    met = listed.join(at.hint("merge"), reduce(Column.__and__, on)).filter("t between r_t_from and r_t_to").withColumn("distance", off(F.col("x"), F.col("y"), F.col("t"), "r_"))
    return met.filter(F.col("distance") < radius).select(*points.columns, *[f"r_{c}" for c in dict.fromkeys(["track", *carry])], "distance")


def _at_all_times(points: DataFrame, tracks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The tracks, to be looked at over the whole time of their field's points."""
    span = points.groupBy(*keys).agg(F.min("t").alias("t_from"), F.max("t").alias("t_to"))
    return tracks.join(span, list(keys)) if keys else tracks.crossJoin(F.broadcast(span))  # one row


def grow(points: DataFrame, tracks: DataFrame, radius: float, keys: Sequence[str] = ()) -> DataFrame:
    """Points without a track take the first track (by name) that passes under ``radius`` of them, within its life or not."""
    free = points.filter("track is null")
    won = passes(free.select(*keys, "id", "x", "y", "t"), _at_all_times(free, tracks, keys), radius, keys).groupBy("id").agg(F.min("r_track").alias("_won"))
    return points.join(won, "id", "left").withColumn("track", F.coalesce("track", "_won")).select(*points.columns)


def merge(points: DataFrame, tracks: DataFrame, radius: float, keys: Sequence[str] = ()) -> DataFrame:
    """Points with the tracks of each other's courses joined: in order of size (then name) a track that is still there takes all others
    whose points lie ``radius`` from its course on average (less than that), with what those have taken before.

    Only tracks near each other matter to each other, so a round does all tracks
    at once that precede those up to two steps away: what they take can't be in
    question between them. Points are joined with courses only for pairs that
    come near each other; nothing is gathered.
    """
    own = materialize(points.filter("track is not null").select(*keys, "id", "x", "y", "t", "track"), "points")
    close = passes(own, _at_all_times(own, tracks, keys), radius, keys).filter("track <> r_track").select("track", "r_track").distinct()
    course = tracks.select(*[F.col(c).alias(f"r_{c}") for c in _COURSE])
    # Pairs get the course first, so that points come last and their rows are grouped where they meet.
    mean = lambda pairs, of: pairs.join(course, "r_track").join(of.hint("merge"), "track").groupBy("track", "r_track").agg(F.avg(off(F.col("x"), F.col("y"), F.col("t"), "r_")).alias("d")).filter(F.col("d") < radius)
    drawn = mean(close, own).select("track", "r_track")
    links = materialize(drawn.union(drawn.select("r_track", "track")).distinct(), "links")
    # name: of each linked track, which has it now; order: of those still to act, null once they have.
    size = tracks.select("track", F.struct((-F.col("n_points")).alias("n"), F.col("track").alias("t")).alias("order"))
    held = materialize(links.select("track").distinct().join(size, "track").select("track", F.col("track").alias("name"), "order"), "names")
    while True:
        names = held.select("track", "name")
        now = links.join(names, "track").select(F.col("name").alias("a"), "r_track").join(names.select(F.col("track").alias("r_track"), F.col("name").alias("b")), "r_track").select("a", "b").filter("a <> b").distinct()
        there = held.filter("track = name").select(F.col("track").alias("a"), "order")
        both = materialize(now, "neighbours")
        least = lambda state: state.select("a", "order").union(both.join(state.select(F.col("a").alias("b"), "order"), "b").select("a", "order")).groupBy("a").agg(F.min("order").alias("order"))
        first = least(least(there)).withColumnRenamed("order", "_least")
        acting = materialize(there.filter("order is not null").join(first, "a").filter(F.col("order") == F.col("_least")).select("a"), "acting")
        if acting.isEmpty():
            break
        pairs = both.join(acting, "a").select(F.col("b").alias("track"), F.col("a").alias("r_track"))
        grown = own.join(names, "track").select("x", "y", "t", F.col("name").alias("track"))
        taken = mean(pairs, grown).select(F.col("track").alias("name"), F.col("r_track").alias("_by"))
        done = acting.select(F.col("a").alias("track"), F.lit(1).alias("_done"))
        new = held.join(taken, "name", "left").join(done, "track", "left")
        new = materialize(new.select("track", F.coalesce("_by", "name").alias("name"), F.when(F.col("_done").isNull(), F.col("order")).alias("order")), "names")
        drop_shared(held, both, acting)
        held = new
    return points.join(held.select("track", "name"), "track", "left").withColumn("track", F.coalesce("name", "track")).select(*points.columns)


def cross(points: DataFrame, tracks: DataFrame, limit: float, bounds: float, keys: Sequence[str] = (), step: float = 1.0) -> DataFrame:
    """Points with tracks joined that come under ``limit`` of each other, in place and time, inside the field (0 to ``bounds``) while both exist.

    Joined tracks and those joined to them become one, named by the least. A course
    counts as straight within each ``step`` of time.
    """
    life = tracks.select(*keys, *_COURSE, "t_min", "t_max").withColumn("_b", F.explode(F.sequence(F.floor(F.col("t_min") / step).cast("long"), F.floor(F.col("t_max") / step).cast("long"))))
    lo, hi = F.greatest(F.col("_b") * step, F.col("t_min")), F.least((F.col("_b") + 1) * step, F.col("t_max"))
    legs = life.select(*keys, "track", "_b", lo.alias("lo"), hi.alias("hi"), place("x", lo).alias("x"), place("y", lo).alias("y"), place("x", hi).alias("x1"), place("y", hi).alias("y1"))
    length = F.sqrt(F.pow(F.col("x1") - F.col("x"), 2) + F.pow(F.col("y1") - F.col("y"), 2))
    kind = F.greatest(F.lit(0), F.ceil(F.log2(length / limit + 1))).cast("int")
    legs = materialize(legs.withColumn("_k", kind), "legs")
    pairs = None
    for k in [r[0] for r in legs.select("_k").distinct().collect()]:  # a number for each power of two of lengths
        # The longer leg's class sets the cell: two legs that meet lie within both lengths and the limit of each other's starts.
        a, b = legs.filter(F.col("_k") == k), legs.filter(F.col("_k") <= k)
        met = within(a, b, limit * (2.0 ** (k + 1) + 1), keys=[*keys, "_b"]).filter("l_track <> r_track")
        pairs = met if pairs is None else pairs.unionByName(met)
    if pairs is None:
        return points
    t0, t1 = F.greatest("l_lo", "r_lo"), F.least("l_hi", "r_hi")

    def at(p: str, c: str, t: Column) -> Column:
        rate = F.coalesce((F.col(f"{p}_{c}1") - F.col(f"{p}_{c}")) / F.when(F.col(f"{p}_hi") > F.col(f"{p}_lo"), F.col(f"{p}_hi") - F.col(f"{p}_lo")), F.lit(0.0))
        return F.col(f"{p}_{c}") + rate * (t - F.col(f"{p}_lo"))

    d0, d1 = ([at("l", c, t) - at("r", c, t) for c in "xy"] for t in (t0, t1))
    ex, ey = d1[0] - d0[0], d1[1] - d0[1]
    span = ex * ex + ey * ey
    s = F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(d0[0] * ex + d0[1] * ey) / span))).otherwise(0.0)
    t = t0 + s * (t1 - t0)
    inside = at("l", "x", t).between(0, bounds) & at("l", "y", t).between(0, bounds)
    near = pairs.filter(t0 <= t1).filter((F.sqrt(F.pow(d0[0] + s * ex, 2) + F.pow(d0[1] + s * ey, 2)) < limit) & inside)
    joined = connected_components(near.select("l_track", "r_track"), "l_track", "r_track").select(F.col("node").alias("track"), F.col("component").alias("_to"))
    return points.join(joined, "track", "left").withColumn("track", F.coalesce("_to", "track")).select(*points.columns)


def link(points: DataFrame, tracks: DataFrame, radius: float, bounds: float, keys: Sequence[str] = ()) -> DataFrame:
    """Points with the track that passes nearest (under ``radius``) at their time in its life, where it is inside the field; of equals the first by name."""
    lives = tracks.withColumns({"t_from": F.col("t_min"), "t_to": F.col("t_max")})
    met = passes(points.select(*keys, "id", "x", "y", "t"), lives, radius, keys, carry=_COURSE)
    met = met.filter(place("x", F.col("t"), "r_").between(0, bounds) & place("y", F.col("t"), "r_").between(0, bounds))
    best = met.groupBy("id").agg(F.min(F.struct("distance", "r_track"))["r_track"].alias("_best"))
    return points.drop("track").join(best, "id", "left").withColumnRenamed("_best", "track").select(*points.columns)


def tag_moving(
    events: DataFrame, keys: Sequence[str] = (), least: int = 3, space: float = 6.0, time: float = 0.5, most_acceleration: float | None = 1.0, growth: float = 5.0, rounds: int = 5,
    merging: float = 10.0, least_track: int = 10, crossing: float = 2.0, bounds: float = 256.0, reach: float = 2.0, moving: str = "Asteroid",
) -> DataFrame:
    """Events ``(*keys, id, x, y, t, flux_sign, classification)`` with ``asteroid_id``: tracks of ``moving`` events and all other events on them.

    Density clusters in place and time seed tracks; tracks grow, merge and join
    where they cross, each refitted between; those of at least ``least_track``
    events are numbered from 1 in each field. Other positive events near a track
    in its life get its number and become ``moving``. Moving events on no track
    have 0, all others -1.
    """
    keys = list(keys)
    is_moving = F.col("classification") == moving
    seeds = events.filter(is_moving).select(*keys, "id", "x", "y", "t")
    met = within(seeds, seeds, space, keys=keys, width=2).filter(F.pow(F.col("distance") / space, 2) + F.pow((F.col("l_t") - F.col("r_t")) / time, 2) <= 1)
    p = materialize(density_clusters_of(seeds, met.select(F.col("l_id").alias("u"), F.col("r_id").alias("v"), *[F.col(f"l_{k}").alias(f"_{k}") for k in keys]), least, "id", "track", [f"_{k}" for k in keys]), "moving")
    steps = [*[(grow, growth)] * rounds, *[(merge, merging)] * rounds]
    for step, radius in steps:
        new = materialize(step(p, materialize(fit(p, keys, most_acceleration), "tracks"), radius, keys), "moving")
        drop_shared(p)
        p = new
    p = materialize(cross(p, fit(p, keys, most_acceleration), crossing, bounds, keys), "moving")
    kept = p.filter("track is not null").groupBy(*keys, "track").agg(F.count("*").alias("n")).filter(F.col("n") >= least_track)
    numbers = materialize(kept.select("track", F.row_number().over(Window.partitionBy(*keys).orderBy("track")).cast("long").alias("number")), "numbers")  # tracks, far fewer than points
    tracks = materialize(fit(p.join(numbers, "track", "left_semi"), keys, most_acceleration), "tracks")
    others = link(events.filter(~F.coalesce(is_moving, F.lit(False)) & (F.col("flux_sign") >= 0)).select(*keys, "id", "x", "y", "t", F.lit(None).cast("long").alias("track")), tracks, reach, bounds, keys)
    found = p.select("id", "track").union(others.select("id", "track")).join(numbers, "track").select("id", "number")
    out = events.join(found, "id", "left").withColumn("classification", F.when(F.col("number").isNotNull(), moving).otherwise(F.col("classification")))
    return out.withColumn("asteroid_id", F.coalesce("number", F.when(F.col("classification") == moving, 0).otherwise(-1)).cast("long")).select(*events.columns, "asteroid_id")
