"""Plate solutions of many detectors at once: polynomials by normal equations, clipping until it settles, headers, positions of cuts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions import sky
from chronoloom.operators import robust
from chronoloom.sources.shared import drop_shared, materialize

#: Pixels that count as one while sums are taken, so that high powers stay near one.
SCALE = 1024.0

HEADER = ("crval1", "crval2", "crpix1", "crpix2", "cd11", "cd12", "cd21", "cd22")


def fit_surfaces(df: DataFrame, keys: Sequence[str], x: str, y: str, values: Mapping[str, str], order: int, scale: float = SCALE) -> DataFrame:
    """Least-squares polynomials in x and y for each group: ``(*keys, n, value, ...)``, coefficients as arrays by ``powers(order)``.

    ``values`` names each column to fit and what is held: ``"none"``; ``"constant"``
    (0); ``"x"`` or ``"y"`` (constant 0 and the linear part that coordinate itself,
    so only the bending is fitted). Rows with a null or NaN in any column used drop
    out. A group with too few rows or without a unique solution has null arrays.

    The sums of the normal equations are one aggregate, combined before the
    shuffle; a task then solves one small system for each group.
    """
    keys = list(keys)
    terms = sky.powers(order)
    plain = df.select(*keys, *[F.col(c).cast("double").alias(n) for n, c in {"_x": x, "_y": y, **{f"_{k}": c for k, c in enumerate(values)}}.items()])
    used = [c for c in plain.columns if c not in keys]
    good = F.lit(True)
    for c in used:
        good = good & F.col(c).isNotNull() & ~F.isnan(c)
    plain = plain.filter(good).withColumns({"_x": F.col("_x") / scale, "_y": F.col("_y") / scale})
    product = lambda i, j: sky.raised(F.col("_x"), i) * sky.raised(F.col("_y"), j)
    moments = sky.powers(2 * order)
    sums = [F.sum(product(i, j)) for i, j in moments]
    right = [F.sum(F.col(f"_{k}") * product(i, j)) for k in range(len(values)) for i, j in terms]
    got = plain.groupBy(*keys).agg(F.count("*").alias("n"), F.array(*sums).alias("_s"), F.array(*right).alias("_z"))
    at = {p: k for k, p in enumerate(moments)}
    holds = list(values.values())

    def coefficients(s: np.ndarray, z: np.ndarray, hold: str) -> list[float] | None:
        least = {"none": 0, "constant": 1, "x": 2, "y": 2}[hold]
        free = [k for k, (i, j) in enumerate(terms) if i + j >= least]
        out = np.zeros(len(terms))
        if hold in "xy":
            dx, dy = (1, 0) if hold == "x" else (0, 1)
            z = z - scale * np.array([s[at[i + dx, j + dy]] if i + j <= 2 * order - 1 else 0.0 for i, j in terms])
            out[terms.index((dx, dy))] = 1.0
        if free:
            a = np.array([[s[at[terms[k][0] + terms[m][0], terms[k][1] + terms[m][1]]] for m in free] for k in free])
            if s[0] < len(free) or np.linalg.matrix_rank(a, hermitian=True) < len(free):
                return None
            out[free] = np.linalg.solve(a, z[free]) / scale ** np.array([sum(terms[k]) for k in free])
        return out.tolist()

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, (name, hold) in enumerate(zip(values, holds)):
                part = slice(k * len(terms), (k + 1) * len(terms))
                b[name] = [coefficients(np.asarray(s, dtype=float), np.asarray(z, dtype=float)[part], hold) for s, z in zip(b["_s"], b["_z"])]
            yield b.drop(columns=["_s", "_z"])

    types = dict(got.dtypes)
    return got.mapInPandas(solve, ", ".join([f"`{c}` {types[c]}" for c in [*keys, "n"]] + [f"`{v}` array<double>" for v in values]))


def plate_solution(df: DataFrame, keys: Sequence[str], id_col: str, x: str, y: str, u: str, v: str, order: int, sigma: float = 3.0, rounds: int = 20) -> tuple[DataFrame, DataFrame]:
    """Polynomials from pixels (x, y about the reference pixel) to undistorted ones (u, v), refitted to what clipping leaves.

    Returns the coefficients ``(*keys, n, u, v)`` of the last fit and the rows
    ``(*keys, id, x, y, u, v, du, dv, kept)``. Each round fits the kept rows of each
    group, cuts their residuals in u until that settles, then what is left in v; it
    ends once no group loses a row, or after ``rounds``. Rows with a missing value
    are not kept. A round writes the rows to the shared folder with their flag.
    """
    keys = list(keys)
    number = [F.col(c).cast("double").alias(n) for n, c in zip(("x", "y", "u", "v"), (x, y, u, v))]
    good = F.lit(True)
    for c in ("x", "y", "u", "v"):
        good = good & F.col(c).isNotNull() & ~F.isnan(c)
    rows = materialize(df.select(*keys, F.col(id_col).alias("id"), *number).withColumn("kept", F.coalesce(good, F.lit(False))), "plate")
    n = rows.filter("kept").count()
    for last in range(1, rounds + 1):
        fits = materialize(fit_surfaces(rows.filter("kept"), keys, "x", "y", {"u": "none", "v": "none"}, order), "plate-fit")
        named = fits.select(*keys, F.col("u").alias("_cu"), F.col("v").alias("_cv"))
        off = robust._joined(rows.select(*keys, "id", "x", "y", "u", "v", "kept"), named, keys, "left")
        off = off.withColumns({"du": F.col("u") - sky.surface(F.col("_cu"), F.col("x"), F.col("y"), order), "dv": F.col("v") - sky.surface(F.col("_cv"), F.col("x"), F.col("y"), order)}).drop("_cu", "_cv")
        off = materialize(off, "plate-residuals")
        cut = off
        for d in ("du", "dv"):
            bounds = robust.sigma_cut_loop(cut.filter("kept"), keys, d, sigma).select(*keys, "centre", "reach", "strict")
            cut = robust._joined(cut, bounds, keys, "left").withColumn("kept", F.col("kept") & (robust.within_cut(F.col(d)) | F.col(d).isNull())).drop("centre", "reach", "strict")
        new = materialize(cut, "plate")
        left = new.filter("kept").count()
        drop_shared(rows, off)
        rows = new
        if left == n or last == rounds:
            return fits, rows
        n = left
        drop_shared(fits)
    raise ValueError("rounds must be 1 or more")


def inverse_surfaces(fits: DataFrame, heads: DataFrame, keys: Sequence[str], order: int, step: int = 16) -> DataFrame:
    """Polynomials back from (u, v) to (x, y): ``(*keys, x, y)``, fitted over an even grid of each detector with the constant held at 0.

    ``heads`` has the keys, ``naxis1``, ``naxis2``, ``crpix1`` and ``crpix2``. The
    grid, of ``naxis / step`` points a side from the first pixel to the last, is
    made by Spark; it doesn't grow with the stars.
    """
    keys = list(keys)
    joined = robust._joined(fits.select(*keys, "u", "v"), heads.select(*keys, "naxis1", "naxis2", "crpix1", "crpix2"), keys)

    def axis(d: DataFrame, name: str, size: str, ref: str) -> DataFrame:
        n = F.floor(F.col(size) / step).cast("int")
        at = 1 + F.col("_i") * (F.col(size) - 1) / F.greatest(n - 1, F.lit(1))
        return d.withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1))).withColumn(name, at - (F.col(ref) - 1)).drop("_i")

    grid = axis(axis(joined, "_gx", "naxis1", "crpix1"), "_gy", "naxis2", "crpix2")
    grid = grid.select(*keys, F.col("_gx").alias("x"), F.col("_gy").alias("y"), sky.surface(F.col("u"), F.col("_gx"), F.col("_gy"), order).alias("_u"), sky.surface(F.col("v"), F.col("_gx"), F.col("_gy"), order).alias("_v"))
    return fit_surfaces(grid, keys, "_u", "_v", {"x": "constant", "y": "constant"}, order).drop("n")


def coefficient_rows(fits: DataFrame, back: DataFrame, keys: Sequence[str], order: int) -> DataFrame:
    """The coefficient table, a row a term: ``(*keys, siaf_index, exponent_x, exponent_y, to_x, to_y, back_x, back_y)``."""
    keys = list(keys)
    both = robust._joined(fits.select(*keys, F.col("u").alias("_a"), F.col("v").alias("_b")), back.select(*keys, F.col("x").alias("_c"), F.col("y").alias("_d")), keys, "left")
    terms = F.array(*[F.struct(F.lit((i + j) * 10 + j).alias("siaf_index"), F.lit(i).alias("exponent_x"), F.lit(j).alias("exponent_y"), *[F.get(c, F.lit(k)).alias(n) for n, c in (("to_x", "_a"), ("to_y", "_b"), ("back_x", "_c"), ("back_y", "_d"))]) for k, (i, j) in enumerate(sky.powers(order))])
    return both.select(*keys, F.explode(terms).alias("_t")).select(*keys, "_t.*")


def updated_headers(heads: DataFrame, terms: DataFrame, keys: Sequence[str], offset: bool = True, rotation: bool = True, distortion: bool = True) -> DataFrame:
    """Headers with what the coefficient table says: the constants move the reference pixel, the linear part turns the matrix, the rest are distortion keys.

    ``heads`` has the columns of ``HEADER`` and may have a map ``sip`` of older
    distortion keys, all of which are replaced: ``A_i_j``, ``B_i_j`` (forward),
    ``AP_i_j``, ``BP_i_j`` (back) for i + j >= 2, and the four ``_ORDER``. Detectors
    without coefficients keep their header.
    """
    keys = list(keys)
    degree = F.col("exponent_x") + F.col("exponent_y")
    at = lambda value, i, j: F.max(F.when((F.col("exponent_x") == i) & (F.col("exponent_y") == j), F.col(value)))
    name = lambda p: F.concat(F.lit(f"{p}_"), F.col("exponent_x").cast("string"), F.lit("_"), F.col("exponent_y").cast("string"))
    pairs = {"A": "to_x", "B": "to_y", "AP": "back_x", "BP": "back_y"}
    entries = F.flatten(F.collect_list(F.when(degree >= 2, F.array(*[F.struct(name(p).alias("k"), F.col(c).alias("v")) for p, c in pairs.items()]))))
    top = F.max(F.when(degree >= 2, degree)).cast("double")
    orders = F.array(*[F.struct(F.lit(f"{p}_ORDER").alias("k"), F.col("_top").alias("v")) for p in pairs])
    made = terms.groupBy(*keys).agg(*[at(c, i, j).alias(f"_{c}{i}{j}") for c in ("to_x", "to_y") for i, j in ((0, 0), (1, 0), (0, 1))], entries.alias("_e"), top.alias("_top"))
    made = made.withColumn("_sip", F.when(F.col("_top").isNotNull(), F.map_from_entries(F.array_sort(F.concat("_e", orders)))))
    out = robust._joined(heads, made, keys, "left")
    moved = {}
    if offset:
        moved |= {"crpix1": F.col("crpix1") + F.coalesce("_to_x00", F.lit(0.0)), "crpix2": F.col("crpix2") + F.coalesce("_to_y00", F.lit(0.0))}
    if rotation:
        m11, m12, m21, m22 = (F.coalesce(c, F.lit(d)) for c, d in (("_to_x10", 1.0), ("_to_x01", 0.0), ("_to_y10", 0.0), ("_to_y01", 1.0)))
        for k in (1, 2):
            a, b = F.col(f"cd{k}1"), F.col(f"cd{k}2")
            moved |= {f"cd{k}1": a * m11 + b * m21, f"cd{k}2": a * m12 + b * m22}
    if distortion:
        moved["sip"] = F.coalesce("_sip", "sip") if "sip" in heads.columns else F.col("_sip")
    return out.withColumns(moved).drop(*[c for c in made.columns if c not in keys])


def cut_corners(cuts: DataFrame, n: int, overlap: int = 0, margin: int = 44, size: int = 2048, index: str = "cut") -> DataFrame:
    """Lower corner, centre and half width of each of n * n cuts, numbered from 1 along x, of a detector whose pixels start ``margin`` columns in.

    With an overlap, inner cuts start half of it (rounded down) early and the last
    ones all of it; every cut is wider by it.
    """
    i = F.col(index) - 1
    col, row = F.pmod(i, F.lit(n)), F.floor(i / n)
    early = lambda k: F.when(k == n - 1, overlap).when(k == 0, 0).otherwise(overlap // 2)
    x, y = (F.floor(start + k * (size / n)).cast("long") - early(k) for start, k in ((margin, col), (0, row)))
    half = -(-(-(-size // n)) // 2) + overlap // 2
    return cuts.select(index, x.alias("corner_x"), y.alias("corner_y"), (x + half).cast("double").alias("centre_x"), (y + half).cast("double").alias("centre_y"), F.lit(float(half)).alias("half"))


def cut_shifts(stars: DataFrame, cuts: DataFrame, keys: Sequence[str], width: float, x: str = "x_seen", y: str = "y_seen", px: str = "x", py: str = "y") -> DataFrame:
    """Median shift of each cut between where its stars are seen and where the header puts them: ``(*keys, cut, dx, dy, n)``, 0 without stars.

    Stars lie strictly inside the cut, ``width`` wide. Cuts overlap by less than
    their width, so a star meets the cuts of the cells that its place touches.
    """
    keys = list(keys)
    cell = lambda c: F.floor(c / width).cast("long")
    listed = cuts.select(*keys, "cut", "corner_x", "corner_y", F.explode(F.array(*[F.struct((cell(F.col("corner_x")) + i).alias("_i"), (cell(F.col("corner_y")) + j).alias("_j")) for i in (0, 1) for j in (0, 1)])).alias("_c")).select("*", "_c._i", "_c._j").drop("_c")
    seen = stars.select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y"), F.col(px).alias("_px"), F.col(py).alias("_py")).withColumns({"_i": cell(F.col("_x")), "_j": cell(F.col("_y"))})
    inside = (F.col("_x") > F.col("corner_x")) & (F.col("_x") < F.col("corner_x") + width) & (F.col("_y") > F.col("corner_y")) & (F.col("_y") < F.col("corner_y") + width)
    met = seen.join(listed, [*keys, "_i", "_j"]).filter(inside).select(*keys, "cut", (F.col("_x") - F.col("_px")).alias("_dx"), (F.col("_y") - F.col("_py")).alias("_dy"))
    large = robust.has_large(met, [*keys, "cut"], "_dx")
    shift = robust.quantile(met, [*keys, "cut"], "_dx", out="dx", large=large).join(robust.quantile(met, [*keys, "cut"], "_dy", out="dy", count="_n", large=large).drop("_n"), [*keys, "cut"])
    zero = lambda c, t: F.coalesce(c, F.lit(0).cast(t)).alias(c)
    return robust._joined(cuts.select(*keys, "cut"), shift, [*keys, "cut"], "left").select(*keys, "cut", zero("dx", "double"), zero("dy", "double"), zero("n", "long"))


def sky_to_cut(ra: Column, dec: Column, head: Column, cut: Column, order: int = 0) -> tuple[Column, Column]:
    """Position in a cut, a struct ``corner_x corner_y dx dy``: the detector's pixel less the corner plus the cut's shift."""
    x, y = sky.sky_to_pixel(ra, dec, head, order)
    return x - cut["corner_x"] + cut["dx"], y - cut["corner_y"] + cut["dy"]


def cut_to_sky(x: Column, y: Column, head: Column, cut: Column, order: int = 0) -> tuple[Column, Column]:
    """The inverse of ``sky_to_cut``."""
    return sky.pixel_to_sky(x + cut["corner_x"] - cut["dx"], y + cut["corner_y"] - cut["dy"], head, order)
