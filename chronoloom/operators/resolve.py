"""Identity: first rows per key, keys to numbers, sets, matches of intervals, links across resolutions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronoloom.operators.components import connected_components
from chronoloom.sources.shared import materialize


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by an explicit order: an aggregate, so that a large group costs no sort."""
    rest = [c for c in df.columns if c not in keys]
    least = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return least.select(*keys, "_r.*")


def factorise(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "code") -> DataFrame:
    """Number keys from 1 in the order in which they first appear (ties by the keys); distinct keys are few enough for one task."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_f"))
    codes = first.withColumn(out, F.row_number().over(Window.orderBy("_f", *keys))).drop("_f")
    return df.join(codes, list(keys))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).union(b.subtract(a))


def unique_in_order(df: DataFrame, value: str, order: str) -> DataFrame:
    return df.groupBy(value).agg(F.min(order).alias("first")).orderBy("first")


def interval_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> tuple[Column, Column]:
    """Length of the common part of two intervals, and its share of their union."""
    common = F.least(e1, e2) - F.greatest(s1, s2)
    return common, common / (F.greatest(e1, e2) - F.least(s1, s2))


def match_intervals(truth: DataFrame, events: DataFrame, keys: Sequence[str], width: float, radius: float = 1.0, least_share: float = 0.0, weights: tuple[float, float, float, float] = (0.5, 2.0, 0.5, 0.1), minutes: float = 1440.0, isolated: DataFrame | None = None, id_col: str = "injid", event_col: str = "eventid") -> DataFrame:
    """For each true interval its best event: finest resolution first, then least score.

    Both sides have ``x``, ``y``, ``start``, ``end`` and ``peak`` (times of
    ``minutes`` minutes each); events have ``frame_bin``. Candidates lie within
    ``radius``, overlap, and share at least ``least_share`` of the union. The score
    adds, weighted, the separation, what the overlap lacks of the union, the
    absolute logarithm of the lengths' ratio, and the peaks' offset in true
    lengths (of a minute at least). ``detected``: 'y' at resolution 1, else the
    resolution; 'iso' where only one of ``isolated (x, y, start)`` lies near within
    the interval; else 'n'. Intervals meet in buckets of ``width``.
    """

    def bucketed(df: DataFrame, p: str, end: str = "end") -> DataFrame:
        df = df.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in keys])
        return df.withColumn("_b", F.explode(F.sequence(F.floor(F.col(f"{p}_start") / width).cast("long"), F.floor(F.col(f"{p}_{end}") / width).cast("long"))))

    a, b = bucketed(truth, "t"), bucketed(events, "e")
    common, share = interval_overlap(F.col("t_start"), F.col("t_end"), F.col("e_start"), F.col("e_end"))
    apart = F.sqrt(F.pow(F.col("e_x") - F.col("t_x"), 2) + F.pow(F.col("e_y") - F.col("t_y"), 2))
    once = F.col("_b") == F.greatest(F.floor(F.col("t_start") / width), F.floor(F.col("e_start") / width))
    pairs = a.join(b, [*keys, "_b"]).filter((common > 0) & (share >= least_share) & (apart <= radius) & once)
    eps = F.lit(2.220446049250313e-16)
    own, found = F.greatest(F.col("t_end") - F.col("t_start"), eps), F.greatest(F.col("e_end") - F.col("e_start"), eps)
    peak = F.abs(F.col("e_peak") - F.col("t_peak")) * minutes / F.greatest(own * minutes, F.lit(1.0))
    ratio = F.greatest(own, found) / F.least(own, found)
    score = weights[0] * apart + weights[1] * (1.0 - share) + weights[2] * F.abs(F.log(ratio)) + weights[3] * peak
    scored = pairs.withColumn("iou", share).withColumn("sep", apart).withColumn("score", score)
    best = scored.groupBy(F.col(f"t_{id_col}").alias(id_col)).agg(F.min_by(F.struct(f"e_{event_col}", "e_frame_bin", "sep", "iou", "score"), F.struct("e_frame_bin", "score", f"e_{event_col}")).alias("m"))
    out = truth.join(best, id_col, "left").withColumn("alone", F.lit(False))
    if isolated is not None:
        near = a.join(bucketed(isolated, "e", "start"), [*keys, "_b"]).filter(F.col("e_start").between(F.col("t_start"), F.col("t_end")) & (apart <= radius))
        out = out.drop("alone").join(near.select(F.col(f"t_{id_col}").alias(id_col)).distinct().withColumn("alone", F.lit(True)), id_col, "left")
    detected = F.when(F.col("m.e_frame_bin") == 1, "y").when(F.col("m").isNotNull(), F.col("m.e_frame_bin").cast("string")).when(F.col("alone"), "iso").otherwise("n")
    return out.select(id_col, detected.alias("detected"), F.col(f"m.e_{event_col}").alias("event"), F.col("m.e_frame_bin").alias("frame_bin"), F.col("m.sep").alias("centroid_sep"), F.col("m.iou").alias("iou"), F.col("m.score").alias("score"))


def shared_ids(df: DataFrame, keys: Sequence[str], ids: str, out: str = "codes") -> DataFrame:
    """Keep of each id list those that other rows have too, numbered densely; the number is the id's rank among shared ids.

    ``keys`` tell the rows apart (without nulls); a row that shares nothing has an empty list.
    """
    keys = list(keys)
    flat = df.select(*keys, F.explode(ids).alias("_id")).distinct()
    shared = flat.groupBy("_id").agg(F.count("*").alias("_n")).filter("_n > 1")
    coded = shared.select("_id", F.row_number().over(Window.orderBy("_id")).alias("_code"))
    lists = flat.join(coded, "_id").groupBy(*keys).agg(F.array_sort(F.collect_list("_code")).alias(out))
    return df.join(lists, keys, "left").withColumn(out, F.coalesce(out, F.array().cast("array<int>"))).select(*df.columns, out)


def hand_down(events: DataFrame, id_col: str, start: str, end: str, resolution: str, group: str, wide_group: str, moving: str, width: float) -> DataFrame:
    """``(id, origin)``: the ids that each event has from finer resolutions, its own where nothing finer reached it in time.

    Bounds are counted in bins of the event's own ``resolution``. An event hands
    what it has to the coarser ones of its ``group`` that it overlaps, with a slack of
    the coarser bin; a ``moving`` one to those of its ``wide_group``. Groups are worked
    through in order, each from fine to coarse: what comes from a later group
    comes late and isn't handed on. The loop is over resolutions, which are few.
    """
    names = {id_col: "id", group: "g", wide_group: "w", resolution: "b", moving: "m"}
    e = events.select(*[F.col(c).alias(n) for c, n in names.items()], (F.col(start) * F.col(resolution)).alias("s"), (F.col(end) * F.col(resolution)).alias("e"))
    bucket = lambda c: F.floor(c / width).cast("long")
    fine = e.select(*[F.col(c).alias(f"f_{c}") for c in e.columns]).withColumn("_b", F.explode(F.sequence(bucket(F.col("f_s")), bucket(F.col("f_e")))))
    coarse = e.withColumn("_b", F.explode(F.sequence(bucket(F.col("s") - F.col("b")), bucket(F.col("e") + F.col("b")))))
    over = (F.col("f_b") < F.col("b")) & (F.col("f_s") <= F.col("e") + F.col("b")) & (F.col("f_e") >= F.col("s") - F.col("b")) & ((F.col("f_g") == F.col("g")) | F.col("f_m"))
    met = fine.join(coarse, (fine["f_w"] == coarse["w"]) & (fine["_b"] == coarse["_b"])).filter(over)
    edges = materialize(met.select(F.col("f_id").alias("source"), "id", "b", (F.col("f_g") <= F.col("g")).alias("early")).distinct(), "edges")
    had = []
    for level in sorted(r[0] for r in e.select("b").distinct().collect()):
        own = e.filter(F.col("b") == level).select("id")
        now = own.select("id", F.col("id").alias("origin"))
        if had:
            before = had[0]
            for h in had[1:]:
                before = before.union(h)
            came = edges.filter(F.col("early") & (F.col("b") == level)).join(before.select(F.col("id").alias("source"), "origin"), "source").select("id", "origin").distinct()
            now = came.union(now.join(came.select("id").distinct(), "id", "left_anti"))
        had.append(materialize(now, "origins"))
    if not had:
        return e.select("id", F.col("id").alias("origin")).withColumnRenamed("id", id_col)
    every = had[0]
    for h in had[1:]:
        every = every.union(h)
    late = edges.filter(~F.col("early")).join(every.select(F.col("id").alias("source"), "origin"), "source").select("id", "origin")
    return every.union(late).distinct().withColumnRenamed("id", id_col)


def link_resolutions(events: DataFrame, keys: Sequence[str], id_col: str, start: str, end: str, resolution: str, width: float) -> DataFrame:
    """Events of one object at different resolutions whose intervals overlap (with a slack of the coarser bin) form a group.

    ``group`` is the least id of the component; overlaps meet in buckets.
    """
    def side(p: str) -> DataFrame:
        d = events.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in (id_col, start, end, resolution)])
        return d.withColumn("_b", F.explode(F.sequence(F.floor((F.col(f"{p}_{start}") - F.col(f"{p}_{resolution}")) / width).cast("long"), F.floor((F.col(f"{p}_{end}") + F.col(f"{p}_{resolution}")) / width).cast("long"))))

    a, b = side("a"), side("b")
    slack = F.col(f"b_{resolution}")
    hit = (F.col(f"a_{resolution}") < F.col(f"b_{resolution}")) & (F.col(f"a_{start}") <= F.col(f"b_{end}") + slack) & (F.col(f"a_{end}") >= F.col(f"b_{start}") - slack)
    links = a.join(b, [*keys, "_b"]).filter(hit).select(F.col(f"a_{id_col}").alias("u"), F.col(f"b_{id_col}").alias("v")).distinct()
    found = connected_components(links)
    return events.join(found.withColumnRenamed("node", id_col), id_col, "left").withColumn("group", F.coalesce("component", id_col)).drop("component")
