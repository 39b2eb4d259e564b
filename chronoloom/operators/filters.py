"""Conjunctive filters over event and object tables; each option that is None adds nothing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions import sky
from chronoloom.operators.spatial import in_polygon

#: Classes that count as variable stars in event filters.
VARIABLE_CLASSES = ("VCR", "VRRLyr", "VEB", "VLPV", "VST", "VAGN", "VRM", "VMSO", "RRLyrae")
#: Those that count as variable stars in filters of objects.
VARIABLE_OBJECT_CLASSES = ("VCR", "VRRLyr", "VEB", "VLPV", "VST", "VAGN", "VRM", "VMSO")
#: Limits of a trusted fit.
FIT_LIMITS = {"delta_bic": (None, -6.0), "redchi2_region": (None, 3.0), "A_snr": (5.0, None)}


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def class_is(column: Column, wanted: str, variable: Sequence[str] = VARIABLE_CLASSES) -> Column:
    """Equality without regard to case; a leading ``!`` or ``~`` negates; ``var`` or ``variable`` means any of ``variable``."""
    negate = wanted[:1] in ("!", "~")
    name = wanted.lstrip("!~").lower()
    names = [v.lower() for v in variable] if name in ("var", "variable") else [name]
    hit = F.lower(column).isin(names)
    return ~hit if negate else hit


def latitude(column: Column, bounds: float | Sequence[float]) -> Column:
    """At least so far from the galactic plane, or between the least and greatest distance given."""
    if isinstance(bounds, (int, float)):
        return F.abs(column).between(bounds, 90)
    if not isinstance(bounds, (list, tuple)):
        raise TypeError("a number or a pair of numbers")
    return F.abs(column).between(min(map(abs, bounds)), max(map(abs, bounds)))


def in_range(column: Column, low: float | None, high: float | None, open_low: bool = False, open_high: bool = False) -> Column:
    """Within bounds, each of which may be missing or excluded."""
    out = []
    if low is not None:
        out.append(column > low if open_low else column >= low)
    if high is not None:
        out.append(column < high if open_high else column <= high)
    return all_of(out)


def out_of_range(column: Column, low: float | None, high: float | None, open_low: bool = False, open_high: bool = False) -> Column:
    """Below or above bounds (a bound itself counts if it is excluded from the range)."""
    out = F.lit(False)
    if low is not None:
        out = out | (column <= low if open_low else column < low)
    if high is not None:
        out = out | (column >= high if open_high else column > high)
    return out


def present(columns: Sequence[str]) -> Column:
    """Neither null nor NaN in any of the columns."""
    return all_of(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns)


def equals(column: Column, value) -> Column:
    """Null-safe equality: None finds nulls."""
    return column.eqNullSafe(F.lit(value))


def unmasked(column: Column, bits: int | None = None) -> Column:
    """None of ``bits`` set, or zero."""
    return (column.bitwiseAND(bits) if bits is not None else column) == 0


def filter_events(
    events: DataFrame,
    objects: DataFrame | None = None,
    star_free: bool | str | None = None,
    exclude: Sequence[str] = ("Junk",),
    source_mask_below: int | None = None,
    frame_bin: int | None = None,
    crossbins: bool | None = None,
    bad_frames: bool | None = None,
    flat: bool | None = None,
    galactic_latitude: float | Sequence[float] | None = None,
    classification: str | None = None,
    frame_duration: tuple[float | None, float | None] = (None, None),
    at_least: dict[str, float] | None = None,
    total_events: tuple[int | None, int | None] = (None, None),
    flux_sign: int | None = None,
    centroid_error: float | None = None,
    boundary_buffer: float | None = None,
    boundaries: dict[int, Sequence[int]] | None = None,
) -> DataFrame:
    """Events that pass every condition given; one filter, so that it reaches the scan.

    star_free: True keeps events without a star, "hard" also drops those of
    objects with one (a semi join), False keeps those with one. frame_duration
    bounds are in frames of the finest bin. at_least: columns and thresholds.
    boundary_buffer drops events that hold a frame as near (in frames of the finest
    bin, cut to whole ones of their own) to one of their bin's ``boundaries``.
    """
    p = [F.col("classification") != c for c in exclude]
    if star_free is not None:
        p.append(F.col("gaia_id") != "-" if star_free is False else F.col("gaia_id") == "-")
    if source_mask_below is not None:
        p.append(F.col("source_mask") < source_mask_below)
    if frame_bin is not None:
        p.append(F.col("frame_bin") == frame_bin)
    if crossbins is False:
        p.append(F.size("crossbin_ids") == 0)
    if bad_frames is False:
        p.append(F.col("bad_frame_flag") == 0)
    if flat is not None:
        p.append(F.col("lc_flat") == int(flat))
    if galactic_latitude is not None:
        p.append(latitude(F.col("gal_b"), galactic_latitude))
    if classification is not None:
        p.append(class_is(F.col("classification"), classification))
    low, high = frame_duration
    if low is not None:
        p.append(F.col("frame_duration") >= low / F.col("frame_bin"))
    if high is not None:
        p.append(F.col("frame_duration") <= high / F.col("frame_bin"))
    p += [F.col(c) >= v for c, v in (at_least or {}).items()]
    p.append(in_range(F.col("total_events"), *total_events))
    if flux_sign is not None:
        p.append(F.col("flux_sign") == flux_sign)
    if centroid_error is not None:
        p.append(F.pow("xcentroid_err", 2) + F.pow("ycentroid_err", 2) <= 2 * centroid_error**2)
    if boundary_buffer is not None:
        for size, frames in (boundaries or {}).items():
            margin = int(boundary_buffer / size)
            near = [(F.col("frame_start") <= f + margin) & (F.col("frame_end") >= f - margin) for f in frames]
            p.append((F.col("frame_bin") != size) | ~reduce(lambda a, b: a | b, near, F.lit(False)))
    out = events.filter(all_of(p))
    if star_free == "hard":
        if objects is None:
            raise ValueError("star_free 'hard' needs the table of objects")
        out = out.join(objects.filter("gaia_id = '-'").select("objid"), "objid", "left_semi")
    return out


def away_from_frames(events: DataFrame, frames: Sequence[int], margin: Column, start: str, end: str) -> DataFrame:
    """Events whose interval holds no frame within ``margin`` of the given ones (a few literals: no join is needed)."""
    touches = [(F.col(start) <= f + margin) & (F.col(end) >= f - margin) for f in frames]
    return events.filter(~reduce(lambda a, b: a | b, touches, F.lit(False)))


def quality_pass(df: DataFrame, limits: dict[str, tuple[float | None, float | None]] = FIT_LIMITS, ok: str = "fit_ok") -> Column:
    """True where a fit succeeded and all columns that exist lie within their limits; nulls fail."""
    p = [F.col(ok)] if ok in df.columns else []
    p += [in_range(F.col(c), lo, hi) for c, (lo, hi) in limits.items() if c in df.columns]
    return F.coalesce(all_of(p), F.lit(False))


def members_of(events: DataFrame, ids: DataFrame, column: str = "crossbin_ids") -> DataFrame:
    """Events whose id list shares an element with a table of ids: distinct lists are exploded to an equi join, each event once."""
    lists = events.select(column).distinct()
    hit = lists.select(column, F.explode(column).alias("id")).join(ids.select("id").distinct(), "id", "left_semi").select(column).distinct()
    return events.join(hit, column, "left_semi").select(*events.columns)


def filter_objects(
    objects: DataFrame,
    centre: tuple[float, float] | None = None,
    distance: float = 40.0,
    n_events: tuple[int | None, int | None] = (None, None),
    galactic_latitude: float | Sequence[float] | None = None,
    classification: str | None = None,
    frame_bin: int | None = None,
    flux_sign: int | None = None,
    centroid_error: float | None = None,
    at_least: dict[str, float] | None = None,
    at_most: dict[str, float] | None = None,
) -> DataFrame:
    """Objects that pass every condition given.

    centre, distance: strictly within so many arc seconds of a position in degrees.
    at_least, at_most: columns (as lc_sig_max, psf_maxsig, min_eventlength_frame,
    max_eventlength_mjd) and inclusive bounds. A null fails the condition on it.
    """
    p = [in_range(F.col("n_events"), *n_events)]
    if centre is not None:
        ra, dec = (F.lit(float(c)) for c in centre)
        away = sky.separation(F.col("ra"), F.col("dec"), ra, dec)
        p += [sky.in_box(F.col("ra"), F.col("dec"), ra, dec, distance / 3600), away < distance / 3600]
    if galactic_latitude is not None:
        p.append(latitude(F.col("gal_b"), galactic_latitude))
    if classification is not None:
        p.append(class_is(F.col("classification"), classification, VARIABLE_OBJECT_CLASSES))
    p += [F.col(c) == v for c, v in (("frame_bin", frame_bin), ("flux_sign", flux_sign)) if v is not None]
    if centroid_error is not None:
        p.append(F.pow("xcentroid_err", 2) + F.pow("ycentroid_err", 2) <= 2 * centroid_error**2)
    p += [F.col(c) >= v for c, v in (at_least or {}).items()] + [F.col(c) <= v for c, v in (at_most or {}).items()]
    return objects.filter(all_of(p))


def good_detection() -> Column:
    """A detection worth keeping: clear, round enough and without a deep hole beside it."""
    return (F.col("snr") >= 3) & (F.col("neg_extent") < 3) & (F.col("ellipticity") < 0.75)


def inside_edges(x: Column, y: Column, nx: int, ny: int, margin: int = 3) -> Column:
    """More than ``margin`` pixels from each edge of an image, strictly."""
    return (x > margin) & (x < nx - margin) & (y > margin) & (y < ny - margin)


def moving_candidates(events: DataFrame) -> DataFrame:
    """Events that may be moving objects: clear, positive, of 2 to 50 frames at the finest resolution of the table."""
    finest = events.agg(F.min("frame_bin")).scalar()
    fits = F.col("frame_duration").between(2, 50) & (F.col("lc_sig_max") >= 5) & (F.col("flux_sign") == 1) & ~F.col("classification").isin("CosmicRay", "Junk")
    return events.filter(fits & (F.col("frame_bin") == finest))


def moving_class(motion: Column, likeness: Column, classification: Column, stages: Sequence[tuple[float, float]] = ((1.0, 0.0), (0.75, 0.7), (0.5, 0.9))) -> Column:
    """'Asteroid' where any pair of least motion and least likeness of a Gaussian is met, else the class as it was."""
    met = reduce(lambda a, b: a | b, [(motion >= m) & (likeness >= g) for m, g in stages])
    return F.when(met, "Asteroid").otherwise(classification)


def filter_recovered(injected: DataFrame, equal: dict[str, str] | None = None, at_least: dict[str, float] | None = None, at_most: dict[str, float] | None = None) -> DataFrame:
    """Rows of a table of injected and recovered signals by type, outcome and ranges (all bounds inclusive)."""
    p = [F.col(c) == v for c, v in (equal or {}).items()]
    p += [F.col(c) >= v for c, v in (at_least or {}).items()] + [F.col(c) <= v for c, v in (at_most or {}).items()]
    return injected.filter(all_of(p))


def candidates_in_region(events: DataFrame, region: Sequence[tuple[float, float]], start: float, end: float, duration: float, significance: float = 0.0, whole_cuts: Sequence[int] = (), cuts: Sequence[int] | None = None) -> DataFrame:
    """Events that begin strictly between two times, are shorter than ``duration`` and more significant than ``significance``, inside a region.

    The region is a polygon of at least three corners on the detector. Cuts in
    ``whole_cuts`` lie inside it, so their events need no test; of other cuts those
    in ``cuts`` (None: all) are tested by position.
    """
    timely = (F.col("mjd_start") > start) & (F.col("mjd_start") < end) & (F.col("mjd_duration") < duration) & (F.col("lc_sig_max") > significance)
    inside = in_polygon(F.col("xccd"), F.col("yccd"), region)
    if cuts is not None:
        inside = inside & F.col("cut").isin(*cuts)
    return events.filter(timely & (F.col("cut").isin(*whole_cuts) | inside if whole_cuts else inside))


def ordered_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The columns of a fixed order that exist, then the others."""
    return df.select(*[c for c in order if c in df.columns], *[c for c in df.columns if c not in order])
