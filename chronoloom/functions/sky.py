"""Positions on the sky as column expressions (degrees)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    a = F.pow(F.sin(F.radians(dec2 - dec1) / 2), 2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), a))))


def in_box(ra: Column, dec: Column, centre_ra: Column, centre_dec: Column, radius: float) -> Column:
    """A box that holds the cone: declination first (it reaches the scan), then right ascension, safe at 0 = 360 and at the poles."""
    wide = radius / F.greatest(F.cos(F.radians(F.least(F.abs(centre_dec) + radius, F.lit(89.9)))), F.lit(1e-6))
    off = F.abs(F.pmod(ra - centre_ra + 180.0, F.lit(360.0)) - 180.0)
    return dec.between(centre_dec - radius, centre_dec + radius) & ((off <= wide) | (F.abs(centre_dec) + radius > 89.0))


def tangent_plane(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """Gnomonic projection about (ra0, dec0), in degrees; null a quarter of the sky away and beyond."""
    d, d0, da = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    cos_c = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(da)
    front = F.when(cos_c > 0, cos_c)
    x = F.cos(d) * F.sin(da) / front
    y = (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(da)) / front
    return F.degrees(x), F.degrees(y)


def from_tangent_plane(x: Column, y: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """The inverse of ``tangent_plane``."""
    u, v, d0 = F.radians(x), F.radians(y), F.radians(dec0)
    ra = ra0 + F.degrees(F.atan2(u, F.cos(d0) - v * F.sin(d0)))
    dec = F.atan2((F.sin(d0) + v * F.cos(d0)) * F.cos(F.radians(ra - ra0)), F.cos(d0) - v * F.sin(d0))
    return F.pmod(ra, F.lit(360.0)), F.degrees(dec)


def polynomial(x: Column, y: Column, coefficients: dict[tuple[int, int], float]) -> Column:
    """A distortion polynomial: the sum of c * x^i * y^j."""
    return sum((c * F.pow(x, i) * F.pow(y, j) for (i, j), c in sorted(coefficients.items())), F.lit(0.0))


def sexagesimal(degrees: Column, hours: bool, digits: int = 2) -> Column:
    """``HH:MM:SS.ss`` or ``+DD:MM:SS.ss``; the sign is the number's own, also between -1 and 0."""
    scale = 10**digits
    units = F.abs(F.pmod(degrees, F.lit(360.0)) / 15.0 if hours else degrees) * 3600.0
    ticks = F.floor(units * scale + 0.5).cast("long")
    ticks = F.pmod(ticks, F.lit(24 * 3600 * scale)) if hours else ticks
    whole, rest = F.floor(ticks / scale).cast("long"), F.pmod(ticks, F.lit(scale))
    h, m, s = F.floor(whole / 3600), F.pmod(F.floor(whole / 60), F.lit(60)), F.pmod(whole, F.lit(60))
    two = lambda c: F.lpad(c.cast("long").cast("string"), 2, "0")
    body = F.concat(two(h), F.lit(":"), two(m), F.lit(":"), two(s), F.lit("."), F.lpad(rest.cast("string"), digits, "0"))
    return body if hours else F.concat(F.when(degrees < 0, "-").otherwise("+"), body)


def degrees_of(text: Column, hours: bool) -> Column:
    """The inverse; plain numbers are degrees already."""
    parts = F.split(F.regexp_replace(text, "^[+-]", ""), ":")
    part = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)).cast("double"), F.lit(0.0))
    sign = F.when(text.startswith("-"), -1.0).otherwise(1.0)
    return F.when(text.contains(":"), sign * (part(1) + part(2) / 60 + part(3) / 3600) * (15.0 if hours else 1.0)).otherwise(sign * part(1))


def catalogue_name(ra: Column, dec: Column, day: Column | None = None, prefix: str = "EVT") -> Column:
    """``EVT HHMMSS.ss+DDMMSS.ss``, with ``T`` and the whole day if one is given."""
    body = F.concat(F.lit(prefix + " "), F.replace(sexagesimal(ra, True), F.lit(":"), F.lit("")), F.replace(sexagesimal(dec, False), F.lit(":"), F.lit("")))
    return body if day is None else F.concat(body, F.lit("T"), F.floor(day).cast("long").cast("string"))


#: The rotation from equatorial (ICRS) to galactic axes.
GALACTIC = ((-0.0548755604162154, -0.8734370902348850, -0.4838350155487132), (0.4941094278755837, -0.4448296299600112, 0.7469822444972189), (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669))


def galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    """Galactic longitude in [0, 360) and latitude."""
    v = (F.cos(F.radians(dec)) * F.cos(F.radians(ra)), F.cos(F.radians(dec)) * F.sin(F.radians(ra)), F.sin(F.radians(dec)))
    x, y, z = (sum((m * c for m, c in zip(row, v)), F.lit(0.0)) for row in GALACTIC)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z))))


def survey(dec: Column) -> Column:
    """The picture survey that covers a declination."""
    return F.when(dec > -28, "PS1").otherwise("SkyMapper")


def circle(ra0: Column, dec0: Column, radius: float, n: int) -> Column:
    """An array of ``n`` vertices (ra, dec) of an error circle, as an ellipse in right ascension."""
    def vertex(i: Column) -> Column:
        a = 2 * F.pi() * i / n
        return F.struct((ra0 + radius * F.cos(a) / F.cos(F.radians(dec0))).alias("ra"), (dec0 + radius * F.sin(a)).alias("dec"))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), vertex)


def powers(order: int, least: int = 0) -> list[tuple[int, int]]:
    """Exponents (i, j) of x^i y^j by degree from ``least`` to ``order``, x first within a degree."""
    return [(n - j, j) for n in range(least, order + 1) for j in range(n + 1)]


def raised(c: Column, n: int) -> Column:
    """A small whole power by multiplication."""
    out = F.lit(1.0) if n == 0 else c
    for _ in range(n - 1):
        out = out * c
    return out


def surface(coefficients: Column, x: Column, y: Column, order: int, least: int = 0) -> Column:
    """Value of a polynomial whose coefficients are an array column by ``powers(order)``; terms under degree ``least`` are left out."""
    return sum((F.get(coefficients, F.lit(k)) * raised(x, i) * raised(y, j) for k, (i, j) in enumerate(powers(order)) if i + j >= least), F.lit(0.0))


def times_cd(x: Column, y: Column, head: Column) -> tuple[Column, Column]:
    """Pixels from the reference pixel to degrees of the tangent plane, by the matrix ``cd11 cd12 cd21 cd22`` of a header."""
    return head["cd11"] * x + head["cd12"] * y, head["cd21"] * x + head["cd22"] * y


def over_cd(xi: Column, eta: Column, head: Column) -> tuple[Column, Column]:
    """The inverse of ``times_cd``; null where the matrix has none."""
    det = head["cd11"] * head["cd22"] - head["cd12"] * head["cd21"]
    det = F.when(det != 0, det)
    return (head["cd22"] * xi - head["cd12"] * eta) / det, (head["cd11"] * eta - head["cd21"] * xi) / det


def undistorted(ra: Column, dec: Column, head: Column) -> tuple[Column, Column]:
    """Where a position falls, in pixels from the reference pixel and before any distortion."""
    return over_cd(*tangent_plane(ra, dec, head["crval1"], head["crval2"]), head)


def pixel_to_sky(x: Column, y: Column, head: Column, order: int = 0) -> tuple[Column, Column]:
    """Position of a pixel counted from 0. ``head`` is a struct with ``crval1 crval2 crpix1 crpix2 cd11 cd12 cd21 cd22`` and, if ``order`` is 2 or more, the distortion's arrays ``a`` and ``b`` by ``powers(order)``."""
    u, v = x - (head["crpix1"] - 1), y - (head["crpix2"] - 1)
    if order >= 2:
        u, v = u + surface(head["a"], u, v, order, 2), v + surface(head["b"], u, v, order, 2)
    return from_tangent_plane(*times_cd(u, v, head), head["crval1"], head["crval2"])


def sky_to_pixel(ra: Column, dec: Column, head: Column, order: int = 0, rounds: int = 20) -> tuple[Column, Column]:
    """The inverse of ``pixel_to_sky``: the distortion is taken off in rounds, which settle where it bends less than it spans."""
    f, g = undistorted(ra, dec, head)
    if order >= 2:
        start = F.struct(f.alias("u"), g.alias("v"))
        step = lambda s, _: F.struct((f - surface(head["a"], s["u"], s["v"], order, 2)).alias("u"), (g - surface(head["b"], s["u"], s["v"], order, 2)).alias("v"))
        s = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
        f, g = s["u"], s["v"]
    return f + (head["crpix1"] - 1), g + (head["crpix2"] - 1)
