"""Catalogue matches on the sky with a box and an error ellipse of each event's own size, and catalogues folded into one."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.operators.spatial import sky_within
from chronoloom.sources.shared import drop_shared, materialize

#: Classes of events that are matched with nothing.
UNMATCHED = ("Asteroid", "CosmicRay", "Junk")
#: Catalogue rows that the first round of ``first_in_reach`` looks at.
AHEAD = 512


def in_reach(events: DataFrame, catalogue: DataFrame, reach: Column, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Pairs of events (``l_*``) and catalogue rows (``r_*``) at most each event's own ``reach`` in degrees apart, and some up to twice as far.

    Events are told apart by the power of two above their reach; each class meets
    the catalogue in cells of its own size, so that one wide event makes no
    other's cells wider. Events without a positive reach meet nothing.
    """
    kind = F.ceil(F.log2(F.least(reach, F.lit(180.0)))).cast("int")
    sized = events.withColumn("_size", F.when(reach > 0, kind))
    kinds = [r[0] for r in sized.select("_size").filter("_size is not null").distinct().collect()]  # a number for each power of two of sizes
    parts = [sky_within(sized.filter(F.col("_size") == k).drop("_size"), catalogue, float(2.0**k), ra, dec) for k in sorted(kinds)]
    return reduce(DataFrame.unionByName, parts) if parts else sky_within(events.filter(F.lit(False)), catalogue, 1.0, ra, dec)


def first_in_reach(events: DataFrame, catalogue: DataFrame, reach: Column, id_col: str, inside: Callable[[DataFrame], DataFrame], rank: Sequence[Column], take: Column, out: str) -> DataFrame:
    """``(id, out)``: ``take`` (a column named ``r_*``) of the catalogue row, least by ``rank`` (values of the catalogue's columns, none null; unique), of each event's pairs that ``inside`` keeps.

    The catalogue is cut into tiers by rank. The first round looks at the least of
    them, each further one at as many again as all before, and only for events that
    have found nothing: what is found in an earlier tier is less than all in later
    ones. So an event meets a few rows a round, however many lie within its reach.
    """
    size = catalogue.count()
    tiers = 1 << max(0, math.ceil(size / AHEAD) - 1).bit_length()
    tiers = min(tiers, 1024)
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(rank)])
    ranked = catalogue.withColumn("_o", order)
    if tiers > 1:
        ranked = ranked.repartitionByRange(tiers, "_o").withColumn("_tier", F.spark_partition_id())
    else:
        ranked = ranked.withColumn("_tier", F.lit(0))
    ranked = materialize(ranked, "ranked")
    rest, found, low, high = events, [], 0, 1
    while True:
        pairs = inside(in_reach(rest, ranked.filter((F.col("_tier") >= low) & (F.col("_tier") < high)).drop("_tier"), reach))
        best = materialize(pairs.groupBy(F.col(f"l_{id_col}").alias(id_col)).agg(F.min_by(take, "r__o").alias(out)), "first")
        found.append(best)
        if high >= tiers:
            break
        left = materialize(rest.join(best.select(id_col), id_col, "left_anti").select(*events.columns), "rest")
        if rest is not events:
            drop_shared(rest)
        rest, low, high = left, high, high * 2
        if rest.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def _reach(sigma: float) -> Column:
    """The corner of an event's box is no further than this, with a little to spare."""
    return F.greatest("ra_err", "dec_err") * (sigma * 1.43)


def _matchable() -> Column:
    return ~F.coalesce(F.col("classification").isin(*UNMATCHED), F.lit(False))


def match_stars(events: DataFrame, stars: DataFrame, id_col: str, sigma: float = 3.0, star: str = "source", bright: Sequence[str] = ("rpmag", "gmag"), order: str = "ordinal", out: str = "gaia_id") -> DataFrame:
    """Events ``(id, ra, dec, ra_err, dec_err, classification)`` with the star in their error ellipse, '-' where there is none.

    A star is inside if both differences (right ascension across 0 = 360 and times
    the cosine of the event's declination) are under ``sigma`` errors and their
    Mahalanobis distance is at most that. The brightest by the first of ``bright`` wins,
    where no star has it by the next, else the first by ``order``; so do ties.
    """
    dra = (F.pmod(F.col("r_ra") - F.col("l_ra") + 180.0, F.lit(360.0)) - 180.0) * F.cos(F.radians(F.col("l_dec"))) / F.col("l_ra_err")
    ddec = (F.col("r_dec") - F.col("l_dec")) / F.col("l_dec_err")
    inside = lambda pairs: pairs.filter((F.abs(dra) < sigma) & (F.abs(ddec) < sigma) & (F.sqrt(dra * dra + ddec * ddec) <= sigma))
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c))
    last = F.lit(float("inf"))
    # Missing magnitudes come last; where a star has the first one, the next don't count.
    first = known(bright[0])
    rank = [F.coalesce(first, last), *[F.when(first.isNull(), F.coalesce(known(c), last)).otherwise(F.lit(0.0)) for c in bright[1:]], F.col(order)]
    placed = events.filter(_matchable()).select(id_col, "ra", "dec", "ra_err", "dec_err")
    best = first_in_reach(placed, stars.select("ra", "dec", star, order, *bright), _reach(sigma), id_col, inside, rank, F.col(f"r_{star}"), out).withColumn(out, F.col(out).cast("string"))
    return events.join(best, id_col, "left").withColumn(out, F.coalesce(out, F.lit("-")))


def match_variables(events: DataFrame, variables: DataFrame, id_col: str, sigma: float = 3.0, kind: str = "type", order: str = "ordinal") -> DataFrame:
    """Events whose box holds a variable take the type of the first by ``order`` as their classification.

    The box is that of plain differences: neither across 0 = 360 nor shortened by declination.
    """
    inside = lambda pairs: pairs.filter((F.abs(F.col("r_ra") - F.col("l_ra")) < sigma * F.col("l_ra_err")) & (F.abs(F.col("r_dec") - F.col("l_dec")) < sigma * F.col("l_dec_err")))
    placed = events.filter(_matchable()).select(id_col, "ra", "dec", "ra_err", "dec_err")
    first = first_in_reach(placed, variables.select("ra", "dec", kind, order), _reach(sigma), id_col, inside, [F.col(order)], F.struct(F.col(f"r_{kind}").alias("t")), "_t")
    return events.join(first, id_col, "left").withColumn("classification", F.when(F.col("_t").isNotNull(), F.col("_t.t")).otherwise(F.col("classification"))).drop("_t")


def fold_catalogues(catalogues: Sequence[DataFrame | None], radius: float = 2.0 / 3600) -> DataFrame | None:
    """Catalogues ``(ra, dec, ...)`` one after the other: of each the rows with none of those before within ``radius`` degrees.

    Absent catalogues (None) are passed over; columns that one lacks are null. Rows
    of one catalogue don't exclude each other.
    """
    out = None
    for c in catalogues:
        if c is None:
            continue
        if out is None:
            out = c
            continue
        near = sky_within(out.select("ra", "dec"), c.select("ra", "dec").distinct(), radius).select(F.col("r_ra").alias("ra"), F.col("r_dec").alias("dec")).distinct()
        out = out.unionByName(c.join(near, ["ra", "dec"], "left_anti").select(*c.columns), allowMissingColumns=True)
    return out
