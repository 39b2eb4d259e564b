"""Range and nearest-neighbour joins in the plane and on the sky, as equi joins on cells.

A theta join alone would compare all pairs. Here one side lists the nine cells
around each of its points, the other its own cell, so that rows meet by a hash
join on the cell and the exact distance is checked after.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions import sky
from chronoloom.operators.components import connected_components
from chronoloom.sources.shared import drop_shared, materialize

#: Rows of a cell from which on nearest neighbours are looked for in rounds.
CROWD = 64
#: Pairs of a cell from which on its left rows are dealt over several tasks.
DEAL = 1 << 23


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def within(left: DataFrame, right: DataFrame, radius: float, x: str = "x", y: str = "y", keys: Sequence[str] = (), inclusive: bool = True, list_left: bool = False, width: int = 1) -> DataFrame:
    """Pairs of points no further apart than ``radius`` (with equal ``keys``): left columns ``l_*``, right ones ``r_*``, and ``distance``.

    The right side is listed in nine cells, or with ``list_left`` (better where it is the smaller one) the left.
    Where points are few in a radius, cells of a ``width`` of several radii are better: points are listed in fewer, those that are within it.
    Sides are never broadcast, as estimates of size don't know of the listing.
    """
    size = radius * width
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns], _cell(F.col(x), size).alias("_lx"), _cell(F.col(y), size).alias("_ly"))
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns], _cell(F.col(x), size).alias("_rx"), _cell(F.col(y), size).alias("_ry"))

    def spread(df: DataFrame, side: str) -> DataFrame:
        if width == 1:
            return listed(df, [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)], f"_{side}x", f"_{side}y")
        for axis, c in (("x", x), ("y", y)):
            ends = [_cell(F.col(f"{side}_{c}") + m * radius * (1 + 1e-9), size) for m in (-1, 1)]
            df = df.withColumn(f"_{side}{axis}", F.explode(F.sequence(*ends)))
        return df

    a, b = (spread(a, "l"), b) if list_left else (a, spread(b, "r"))
    cond = (F.col("_lx") == F.col("_rx")) & (F.col("_ly") == F.col("_ry"))
    for k in keys:
        cond = cond & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    d = F.sqrt(F.pow(F.col(f"l_{x}") - F.col(f"r_{x}"), 2) + F.pow(F.col(f"l_{y}") - F.col(f"r_{y}"), 2))
    cond = cond & (d <= radius if inclusive else d < radius)
    return a.join(b.hint("merge"), cond).select(*[f"l_{c}" for c in left.columns], *[f"r_{c}" for c in right.columns], d.alias("distance"))


def listed(df: DataFrame, offsets: Sequence[tuple[int, int]], cx: str = "_cx", cy: str = "_cy") -> DataFrame:
    """Each row once for each offset, its cell moved by it."""
    moves = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets])
    return df.withColumn("_move", F.explode(moves)).withColumns({cx: F.col(cx) + F.col("_move.i"), cy: F.col(cy) + F.col("_move.j")}).drop("_move")


def dealt(a: DataFrame, b: DataFrame, cell: Sequence[str], spread: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_deal``: rows of ``a`` in cells of over ``DEAL`` pairs have one of several, rows of ``b`` are listed once in each.

    With ``spread`` only cells of more than that part of all pairs are dealt, so ``b`` is listed no more often where all cells grow.
    """
    counts = lambda df, n: df.groupBy(*cell).agg(F.count("*").alias(n))
    pairs = counts(a, "_na").join(counts(b, "_nb").hint("merge"), list(cell)).withColumn("_pairs", F.col("_na").cast("double") * F.col("_nb"))
    least = float(DEAL)
    if spread is not None:
        pairs = materialize(pairs, "counts")
        least = max(least, (pairs.agg(F.sum("_pairs")).first()[0] or 0.0) / spread)
    shares = F.least(F.col("_na"), F.ceil(F.col("_pairs") / least))
    full = materialize(pairs.withColumn("_shares", shares).filter("_shares > 1").select(*cell, "_shares"), "crowded")
    own = F.pmod(F.xxhash64(*a.columns), F.coalesce("_shares", F.lit(1)))
    a = a.join(full, list(cell), "left").withColumn("_deal", own).drop("_shares")
    b = b.join(full, list(cell), "left").withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")
    return a, b


def _offsets(n: int, wanted) -> list[tuple[int, int]]:
    """Offsets of cells for which ``wanted(least, most)`` holds of the distances between their points, in cells."""
    span = range(-n - 1, n + 2)
    ends = lambda i, j: (math.hypot(max(abs(i) - 1, 0), max(abs(j) - 1, 0)), math.hypot(abs(i) + 1, abs(j) + 1))
    return [(i, j) for i in span for j in span if wanted(*ends(i, j))]


def _crowd(df: DataFrame, radius: float, x: str, y: str, keys: Sequence[str] = ()) -> int:
    """How many rows the fullest cell holds."""
    return df.groupBy(*keys, _cell(F.col(x), radius), _cell(F.col(y), radius)).count().agg(F.max("count")).first()[0] or 0


def in_rounds(left: DataFrame, right: DataFrame, radius: float, id_col: str, pick: Callable[[DataFrame], DataFrame], x: str = "x", y: str = "y", inclusive: bool = True, keys: Sequence[str] = (), spare: float = 0.0, exact: Callable[[DataFrame, float], DataFrame] = lambda pairs, _: pairs) -> DataFrame:
    """``pick`` (one row for each ``l_<id>``, the nearest) of the pairs within ``radius``, of each left row in the first round that finds one.

    Where cells are crowded the first rounds look less far, each twice as far as
    the one before and only for rows that have found nothing: what is found under a
    shorter reach is nearer than all else, so pairs grow with the rows, not with their density.
    Places may be off by ``spare``: then ``exact`` takes the pairs that are under a reach.
    """
    crowd = _crowd(right, radius, x, y, keys)
    if crowd <= CROWD:
        return pick(exact(within(left, right, radius + spare, x, y, keys, inclusive), radius))
    reach, rest, found = radius * math.sqrt(CROWD / 8 / crowd), left, []
    while True:
        last = reach >= radius
        now = radius if last else reach
        met = exact(within(rest, right, now + spare, x, y, keys, inclusive and last, list_left=True), now)
        found.append(materialize(pick(met), "nearest"))
        if last:
            break
        left_over = materialize(rest.join(found[-1].select(F.col(f"l_{id_col}").alias(id_col)), id_col, "left_anti").select(*left.columns), "rest")
        if rest is not left:
            drop_shared(rest)
        rest, reach = left_over, reach * 2
        if rest.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def nearest(left: DataFrame, right: DataFrame, radius: float, id_col: str, order: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """For each left point with one, the nearest right point under ``radius``; ties by ``order`` of the right side."""
    first = right.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.min_by(F.struct(*right.columns), F.struct(*order)).alias("_r")).select("_r.*")

    def pick(pairs: DataFrame) -> DataFrame:
        rest = [c for c in pairs.columns if c != f"l_{id_col}"]
        return pairs.groupBy(f"l_{id_col}").agg(F.min_by(F.struct(*rest), F.struct("distance", *[f"r_{c}" for c in order])).alias("_b")).select(f"l_{id_col}", "_b.*").select(*pairs.columns)

    return in_rounds(left, materialize(first, "places"), radius, id_col, pick, x, y, inclusive=False)


def best_in_range(left: DataFrame, right: DataFrame, radius: float, id_col: str, order: Sequence[Column], x: str = "x", y: str = "y", keys: Sequence[str] = (), spare: float = 0.0, exact: Column | None = None) -> DataFrame:
    """For each left point the right point within ``radius`` (with equal ``keys``) that is least by ``order`` (values of columns named ``r_*``, none null; unique).

    Cells are a quarter of the radius wide. The least of those cells that lie
    within the radius of all of a left cell bounds what its points can have, so
    right points meet only the left cells whose bound they don't exceed: a few for
    each cell, however dense. Places may be off by ``spare``: then ``exact`` decides.
    """
    size = radius / 4
    cell = [*[f"_k_{k}" for k in keys], "_cx", "_cy"]
    left, right = (df.select(*df.columns, *[F.col(k).alias(f"_k_{k}") for k in keys]) for df in (left, right))
    named = lambda df, side: [F.col(c).alias(c if c.startswith("_k_") else f"{side}_{c}") for c in df.columns]
    a = left.select(*named(left, "l"), _cell(F.col(x), size).alias("_cx"), _cell(F.col(y), size).alias("_cy"))
    b = right.select(*named(right, "r"), _cell(F.col(x), size).alias("_cx"), _cell(F.col(y), size).alias("_cy"))
    b = materialize(b.withColumn("_o", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])), "ranked")
    n = math.ceil((radius + spare) / size)
    sure, reach = _offsets(n, lambda least, most: most * size < (radius - spare) * (1 - 1e-9)), _offsets(n, lambda least, most: least * size < (radius + spare) * (1 + 1e-9))
    asked = a.select(*cell).distinct()
    if sure:
        asked = asked.join(listed(b.groupBy(*cell).agg(F.min("_o").alias("_o")), sure).groupBy(*cell).agg(F.min("_o").alias("_bound")).hint("merge"), cell, "left")
    else:
        asked = asked.withColumn("_bound", F.lit(None).cast(b.schema["_o"].dataType))
    asked = materialize(asked, "bounds")
    worst = listed(asked, reach).groupBy(*cell).agg(F.max("_bound").alias("_worst"), F.bool_or(F.col("_bound").isNull()).alias("_open"))
    useful = b.join(worst.hint("merge"), cell).filter(F.col("_open") | (F.col("_o") <= F.col("_worst"))).drop("_open", "_worst")
    met = materialize(listed(useful, reach).join(asked.hint("merge"), cell).filter(F.col("_bound").isNull() | (F.col("_o") <= F.col("_bound"))).drop("_bound"), "candidates")
    d = F.sqrt(F.pow(F.col(f"l_{x}") - F.col(f"r_{x}"), 2) + F.pow(F.col(f"l_{y}") - F.col(f"r_{y}"), 2))
    pairs = a.join(met.hint("merge"), cell).withColumn("distance", d).filter(F.col("distance") <= radius if exact is None else exact).drop(*cell)
    rest = [c for c in pairs.columns if c not in (f"l_{id_col}", "_o")]
    return pairs.groupBy(f"l_{id_col}").agg(F.min_by(F.struct(*rest), "_o").alias("_b")).select(f"l_{id_col}", "_b.*")


def closest(left: DataFrame, right: DataFrame, radius: float, id_col: str, x: str = "x", y: str = "y") -> DataFrame:
    """The pair ``(l_id, r_id, distance)`` nearest to each other of all within ``radius``, ties by the ids: no row if there is none.

    Of points in one place the first counts. The reach begins where few pairs are
    to be expected and doubles until it finds some.
    """
    a, b = (materialize(df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.min(id_col).alias(id_col)), "places") for df in (left, right))
    reach = radius / math.sqrt(max(1, a.count() * _crowd(b, radius, x, y) / 16))
    while True:
        last = reach >= radius
        got = within(a, b, radius if last else reach, x, y).orderBy("distance", f"l_{id_col}", f"r_{id_col}").limit(1).select(f"l_{id_col}", f"r_{id_col}", "distance")
        if last:
            return got
        got = materialize(got, "closest")  # one row
        if not got.isEmpty():
            return got
        reach *= 2


def anti_union(first: DataFrame, second: DataFrame, radius: float, id_col: str, x: str = "x", y: str = "y") -> DataFrame:
    """All of ``first`` and those of ``second`` that have none of ``first`` within ``radius``."""
    taken = within(second, first, radius, x, y).select(F.col(f"l_{id_col}").alias(id_col)).distinct()
    return first.unionByName(second.join(taken, id_col, "left_anti"), allowMissingColumns=True)


def isolated(points: DataFrame, radius: float, id_col: str, magnitude: str, fainter: float, least: float = 0.0, x: str = "x", y: str = "y") -> DataFrame:
    """Points with no neighbour between ``least`` and ``radius`` away that is brighter than ``magnitude + fainter``.

    The brightest of the cells that lie wholly at such a distance settles most points of
    crowded places; the rest are compared with their neighbours.
    """
    size = radius / 4
    sure = _offsets(4, lambda near, far: near * size > least * (1 + 1e-9) and far < 4 - 1e-9)
    placed = points.withColumns({"_cx": _cell(F.col(x), size), "_cy": _cell(F.col(y), size)})
    rest = points
    if sure:
        bright = listed(placed.groupBy("_cx", "_cy").agg(F.min(magnitude).alias("_m")), sure).groupBy("_cx", "_cy").agg(F.min("_m").alias("_m"))
        open_ = placed.join(bright, ["_cx", "_cy"], "left").filter(F.col("_m").isNull() | F.col(magnitude).isNull() | (F.col("_m") >= F.col(magnitude) + fainter))
        rest = materialize(open_.select(*points.columns), "rest")
    pairs = within(rest, points.select(x, y, magnitude), radius, x, y, inclusive=False, list_left=True).filter((F.col("distance") > least) & (F.col(f"r_{magnitude}") < F.col(f"l_{magnitude}") + fainter))
    return rest.join(pairs.select(F.col(f"l_{id_col}").alias(id_col)).distinct(), id_col, "left_anti")


def self_nearest(points: DataFrame, radius: float, id_col: str, x: str = "x", y: str = "y") -> DataFrame:
    """Distance to the nearest other point within ``radius``, null if there is none; points in one place are 0 apart."""
    places = materialize(points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.min(id_col).alias("p"), F.count_distinct(id_col).alias("n")), "places")
    pick = lambda pairs: pairs.filter("l_p <> r_p").groupBy("l_p").agg(F.min("distance").alias("min_dist"))
    apart = in_rounds(places.filter("n = 1"), places, radius, "p", pick, x, y).withColumnRenamed("l_p", "p")
    found = places.filter("n = 1").join(apart, "p").select(x, y, "min_dist").union(places.filter("n > 1").select(x, y, F.lit(0.0)))
    return points.join(found.hint("merge"), [x, y], "left").select(*points.columns, "min_dist")


def linked(points: DataFrame, radius: float, id_col: str, x: str = "x", y: str = "y") -> DataFrame:
    """``(id, group, lone)`` of all points with a place: the least id that links no longer than ``radius`` reach, and whether a point has no other one within it.

    Cells are a third of the radius wide, so points of a cell and of touching ones
    are linked wherever they lie: cells are joined first, and points are compared
    only between cells that this leaves apart.
    """
    size = radius / 3
    placed = materialize(points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(id_col).alias("p"), F.col(x).alias("x"), F.col(y).alias("y"), _cell(F.col(x), size).alias("_cx"), _cell(F.col(y), size).alias("_cy")), "placed")
    cells = materialize(placed.groupBy("_cx", "_cy").agg(F.min("p").alias("c"), F.count("*").alias("n")), "cells")
    ahead = lambda found: [(i, j) for i, j in found if (i, j) > (0, 0)]
    other = lambda df: df.select("_cx", "_cy", F.col("c").alias("d"), *([F.col("k").alias("m")] if "k" in df.columns else []))
    touching = listed(cells, ahead([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)])).join(other(cells).hint("merge"), ["_cx", "_cy"])
    joined = connected_components(touching, "c", "d").select(F.col("node").alias("c"), F.col("component").alias("k"))
    cells = materialize(cells.join(joined, "c", "left").withColumns({"_lone": F.col("k").isNull() & (F.col("n") == 1), "k": F.coalesce("k", "c")}), "cells")
    far = ahead(_offsets(3, lambda least, most: most > 3 and least < 3 + 1e-9))
    moved = cells.select(F.col("_cx").alias("_ax"), F.col("_cy").alias("_ay"), "_cx", "_cy", "k")
    apart = listed(moved, far).join(other(cells).hint("merge"), ["_cx", "_cy"]).filter("k <> m").select("_ax", "_ay", "_cx", "_cy", "k", "m")
    a = placed.select(F.col("_cx").alias("_ax"), F.col("_cy").alias("_ay"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("p").alias("_p"))
    met = apart.join(a.hint("merge"), ["_ax", "_ay"]).join(placed.hint("merge"), ["_cx", "_cy"]).filter(F.sqrt(F.pow(F.col("_x") - F.col("x"), 2) + F.pow(F.col("_y") - F.col("y"), 2)) <= radius)
    links = materialize(met.select("k", "m").distinct(), "links")
    whole = connected_components(links, "k", "m").select(F.col("node").alias("k"), F.col("component").alias("_whole"))
    named = cells.join(whole, "k", "left").select("_cx", "_cy", F.coalesce("_whole", "k").alias("group"), (F.col("_lone") & F.col("_whole").isNull()).alias("lone"))
    return placed.join(named.hint("merge"), ["_cx", "_cy"]).select(F.col("p").alias(id_col), "group", "lone")


def groups(points: DataFrame, radius: float, id_col: str, least: int = 1, x: str = "x", y: str = "y") -> DataFrame:
    """Density groups of at least ``least`` (1 or 2) members, that is components of "no further than radius".

    Points in one place meet once: places link, not points. ``group`` is the
    least id of the group; with ``least`` 2 a lone point has group null.
    """
    places = materialize(points.groupBy(x, y).agg(F.min(id_col).alias("p"), F.count("*").alias("n")), "places")
    named = places.join(linked(places, radius, "p", x, y), "p").select(x, y, "group", (~F.col("lone") | (F.col("n") >= least)).alias("_in"))
    return points.join(named.hint("merge"), [x, y]).select(*points.columns, F.when(F.col("_in"), F.col("group")).alias("group"))


def brightest_first(df: DataFrame, keys: Sequence[str], radius: float, flux: str, order: str, x: str = "x", y: str = "y") -> DataFrame:
    """Drop points within ``radius`` of a brighter kept one of their ``keys`` (a frame), brightest first, ties by ``order`` (unique in a frame).

    Fainter points don't matter to brighter ones. So where cells are crowded the
    brightest few are settled first, then as many again as all before, of which only
    those take part that none of the kept ones reaches: these lie apart from each
    other, so pairs grow with the points, not with their density. Of points in one
    place only the brightest takes part. Missing flux comes last; points without a
    place have no neighbours.
    """
    keys = list(keys)
    bright = F.struct(F.coalesce(-F.col(flux), F.lit(float("inf"))).alias("f"), F.col(order).alias("o"))
    places = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, x, y).agg(F.min(bright).alias("b")).select(*keys, x, y, F.col("b.f").alias("f"), F.col("b.o").alias(order))
    tiers = min(1024, 1 << max(0, math.ceil(_crowd(places, radius, x, y, keys) / (CROWD / 8)) - 1).bit_length())
    if tiers > 1:
        places = places.repartitionByRange(tiers, "f", order).withColumn("_tier", F.spark_partition_id())
    else:
        places = places.withColumn("_tier", F.lit(0))
    places, stay, low, high = materialize(places, "places"), None, 0, 1
    while low < tiers:
        tier = places.filter((F.col("_tier") >= low) & (F.col("_tier") < high)).drop("_tier")
        if stay is not None:
            taken = within(tier, stay, radius, x, y, keys=keys).select(*[F.col(f"l_{c}").alias(c) for c in [*keys, order]]).distinct()
            tier = materialize(tier.join(taken, [*keys, order], "left_anti").select(*keys, x, y, "f", order), "tier")
        kept = materialize(_settled(tier, keys, radius, order, x, y).select(*keys, x, y, order), "kept")
        stay, low, high = kept if stay is None else stay.unionByName(kept), high, high * 2
    nowhere = df.filter(F.col(x).isNull() | F.col(y).isNull())
    node = F.struct(*keys, order)
    return df.withColumn("v", node).join(stay.select(node.alias("v")), "v", "left_semi").select(*df.columns).unionByName(nowhere)


def _settled(places: DataFrame, keys: list[str], radius: float, order: str, x: str, y: str) -> DataFrame:
    """The ``places (*keys, x, y, f, order)`` that stay, least ``f`` first.

    Rounds of joins, for all frames at once: points without an undecided brighter
    neighbour stay, their neighbours go. Only points with neighbours take part.
    """
    node = F.struct(*keys, order)
    pairs = within(places, places, radius, x, y, keys=keys).filter(F.struct("l_f", f"l_{order}") < F.struct("r_f", f"r_{order}"))
    edges = materialize(pairs.select(F.struct(*[F.col(f"l_{c}").alias(c) for c in [*keys, order]]).alias("u"), F.struct(*[F.col(f"r_{c}").alias(c) for c in [*keys, order]]).alias("v")), "pairs")
    gone = []
    while not edges.isEmpty():
        kept = edges.select("u").distinct().join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_anti")
        out = materialize(edges.join(kept, "u", "left_semi").select("v").distinct(), "gone")
        gone.append(out)
        left = edges.join(kept, "u", "left_anti").join(out.withColumnRenamed("v", "u"), "u", "left_anti").join(out, "v", "left_anti").select("u", "v")
        new = materialize(left, "pairs")
        drop_shared(edges)
        edges = new
    drop_shared(edges)
    stay = places.withColumn("v", node)
    for out in gone:
        stay = stay.join(out, "v", "left_anti")
    return stay.drop("v")


def cone(catalogue: DataFrame, ra0: float, dec0: float, radius: float, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Rows under ``radius`` degrees from a position: a box that the scan can use, then the exact distance."""
    c, d = F.lit(float(ra0)), F.lit(float(dec0))
    return catalogue.filter(sky.in_box(F.col(ra), F.col(dec), c, d, radius)).withColumn("separation", sky.separation(F.col(ra), F.col(dec), c, d)).filter(F.col("separation") < radius)


def sky_within(left: DataFrame, right: DataFrame, radius: float, ra: str = "ra", dec: str = "dec", inclusive: bool = True, deal: bool = True) -> DataFrame:
    """Pairs of positions no further than ``radius`` degrees apart on the sphere: ``l_*``, ``r_*`` and ``separation``.

    Declination is cut into bands as high as the radius and each band into cells
    as wide at its end nearer the pole. A right row is listed in the cells that its
    circle can reach (all of a band's where it holds a pole), so rows meet by an
    equi join on band and cell; right ascensions meet across 0 = 360. Cells of many
    pairs, as at the poles, are dealt over several tasks (``deal``).
    """
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])

    def n_cells(band: Column) -> Column:
        top = F.least(F.lit(90.0), F.greatest(F.abs(band * radius), F.abs((band + 1) * radius)))
        return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(top)) / radius).cast("long"))

    def cell(at: Column, n: Column) -> Column:
        return F.floor(at / (360.0 / n)).cast("long")

    band = F.floor(F.col(f"l_{dec}") / radius).cast("long")
    turn = F.pmod(F.col(f"l_{ra}").cast("double"), F.lit(360.0))
    a = a.withColumn("_band", band).withColumn("_n", n_cells(F.col("_band"))).withColumn("_cell", F.pmod(cell(turn, F.col("_n")), F.col("_n"))).drop("_n")
    at_ra, at_dec = F.pmod(F.col(f"r_{ra}").cast("double"), F.lit(360.0)), F.col(f"r_{dec}")
    polar = F.abs(at_dec) + radius >= 90.0
    wide = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(float(radius)))) / F.cos(F.radians(at_dec))))) + 1e-9
    own = F.floor(at_dec / radius).cast("long")
    b = b.withColumn("_band", F.explode(F.sequence(own - 1, own + 1))).withColumn("_n", n_cells(F.col("_band")))
    low, high = cell(at_ra - wide, F.col("_n")), cell(at_ra + wide, F.col("_n"))
    whole = polar | (high - low + 1 >= F.col("_n"))
    reach = F.when(whole, F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).otherwise(F.transform(F.sequence(low, F.greatest(low, high)), lambda c: F.pmod(c, F.col("_n"))))
    b = b.withColumn("_cell", F.explode(reach)).drop("_n")
    apart = sky.separation(F.col(f"l_{ra}"), F.col(f"l_{dec}"), F.col(f"r_{ra}"), F.col(f"r_{dec}"))
    cell_of = ["_band", "_cell"]
    if deal:
        (a, b), cell_of = dealt(a, b, cell_of), [*cell_of, "_deal"]
        n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, as small partitions of many pairs would be joined
        a, b = a.repartition(n, *cell_of), b.repartition(n, *cell_of)
    cond = reduce(Column.__and__, [a[c] == b[c] for c in cell_of]) & (apart <= radius if inclusive else apart < radius)
    return a.join(b.hint("merge"), cond).select(*[f"l_{c}" for c in left.columns], *[f"r_{c}" for c in right.columns], apart.alias("separation"))


def sky_nearest(left: DataFrame, right: DataFrame, radius: float, id_col: str, order: Sequence[str], ra: str = "ra", dec: str = "dec") -> DataFrame:
    """For each left position with one, the nearest right one within ``radius`` degrees; ties by ``order`` of the right side.

    In crowded places in rounds, as in ``in_rounds``.
    """
    band = F.floor(F.col(dec) / radius).cast("long")
    turn = F.floor(F.pmod(F.col(ra).cast("double"), F.lit(360.0)) * F.cos(F.radians((band + 0.5) * radius)) / radius).cast("long")
    crowd = right.groupBy(band, turn).count().agg(F.max("count")).first()[0] or 0
    reach = radius if crowd <= CROWD else radius * math.sqrt(CROWD / 8 / crowd)
    rest, found = left, []
    while True:
        last = reach >= radius
        pairs = sky_within(rest, right, radius if last else reach, ra, dec, deal=last)
        best = pairs.groupBy(f"l_{id_col}").agg(F.min_by(F.struct(*[c for c in pairs.columns if c != f"l_{id_col}"]), F.struct("separation", *[f"r_{c}" for c in order])).alias("_b")).select(f"l_{id_col}", "_b.*")
        if last and not found:
            return best
        found.append(materialize(best, "nearest"))
        if last:
            break
        left_over = materialize(rest.join(found[-1].select(F.col(f"l_{id_col}").alias(id_col)), id_col, "left_anti").select(*left.columns), "rest")
        if rest is not left:
            drop_shared(rest)
        rest, reach = left_over, reach * 2
        if rest.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def sky_self_nearest(points: DataFrame, radius: float, id_col: str, ra: str = "ra", dec: str = "dec", out: str = "min_dist_arcsec") -> DataFrame:
    """Distance in arcseconds of each position to the nearest other one on the sphere, however far; null if there is no other.

    What finds a neighbour within ``radius`` degrees has its nearest; only the rest
    looks again, each round twice as far, against all. ``radius`` is best about the
    usual spacing. Rows without id or position get null; rows with an equal id are
    the same one.
    """
    own = materialize(points.select(F.col(id_col).alias("id"), F.col(ra).cast("double").alias("ra"), F.col(dec).cast("double").alias("dec")).filter("id is not null and ra is not null and dec is not null").distinct(), "positions")
    found, rest, reach = [], own, float(radius)
    while True:
        pairs = sky_within(rest, own, min(reach, 180.0), deal=reach > radius).filter("l_id <> r_id")
        near = materialize(pairs.groupBy(F.col("l_id").alias("id")).agg(F.min("separation").alias("_d")), "nearest")
        found.append(near)
        left = materialize(rest.join(near.select("id"), "id", "left_anti"), "rest")
        if rest is not own:
            drop_shared(rest)
        rest = left
        if reach >= 180.0 or rest.isEmpty():
            break
        reach *= 2
    nearest_ = found[0]
    for f in found[1:]:
        nearest_ = nearest_.union(f)
    return points.join(nearest_.select(F.col("id").alias(id_col), (F.col("_d") * 3600.0).alias(out)), id_col, "left").select(*points.columns, out)


def cut_grid(df: DataFrame, n: int, size: int, index: str = "cut") -> DataFrame:
    """Corner, centre and half size of each of n * n cuts of a square detector, numbered from 1 along x."""
    step = size // n
    i = F.col(index) - 1
    x, y = F.pmod(i, F.lit(n)) * step, F.floor(i / n).cast("int") * step
    return df.select(index, x.cast("int").alias("corner_x"), y.alias("corner_y"), (x + step / 2).cast("double").alias("centre_x"), (y + step / 2).cast("double").alias("centre_y"), F.lit(step / 2).alias("half"))


def in_polygon(x: Column, y: Column, vertices: Sequence[tuple[float, float]]) -> Column:
    """Even-odd rule: an odd number of edges to the right of the point."""
    hits = F.lit(0)
    for (x1, y1), (x2, y2) in zip(vertices, [*vertices[1:], vertices[0]]):
        crosses = (F.lit(float(y1)) > y) != (F.lit(float(y2)) > y)
        if y1 != y2:
            hits = hits + F.when(crosses & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1), 1).otherwise(0)
    return F.pmod(hits, F.lit(2)) == 1


def free_sites(points: DataFrame, width: int, height: int, step: int, spacing: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points of a grid with no point of the table under ``spacing`` away."""
    spark = points.sparkSession
    n = width // step
    grid = spark.range(n * (height // step)).select(F.col("id").alias("site"), (F.pmod(F.col("id"), F.lit(n)) * step + step / 2).alias("x"), (F.floor(F.col("id") / n) * step + step / 2).alias("y"))
    near = within(grid, points.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")), spacing, inclusive=False)
    return grid.join(near.select(F.col("l_site").alias("site")).distinct(), "site", "left_anti")
