"""Fluxes, magnitudes and light-curve profiles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chronoloom.functions.values import known


def scale_of_zeropoint(zp: Column) -> Column:
    return F.pow(F.lit(10.0), 0.4 * zp)


def zeropoint_of_scale(scale: Column) -> Column:
    return F.when(scale > 0, 2.5 * F.log10(scale))


def convert_flux(flux: Column, error: Column, zp: Column, unit: Column) -> tuple[Column, Column]:
    """Counts in ``unit`` (counts, Jy, mJy, muJy, mag) by an AB zeropoint: value and error.

    A magnitude that isn't detected (flux not above its error) is the upper limit
    from the error, with no error. Without a zeropoint counts stay counts.
    """
    u = F.lower(F.regexp_replace(unit, "[µμ]", "mu"))
    u = F.when(zp.isNull(), "counts").otherwise(u)
    jy = F.when(u == "jy", 1.0).when(u == "mjy", 1e3).when(u.isin("mujy", "ujy"), 1e6) * 3631.0 / scale_of_zeropoint(zp)
    seen = flux > error
    mag = zp - 2.5 * F.log10(F.when(seen, flux).otherwise(F.when(error > 0, error)))
    value = F.when(u == "counts", flux).when(u == "mag", mag).otherwise(flux * jy)
    err = F.when(u == "counts", error).when(u == "mag", F.when(seen, 2.5 / F.log(F.lit(10.0)) * error / flux)).otherwise(error * jy)
    return value, err


def flux_to_mag(flux: Column, error: Column, zp: Column, limit_sigma: float | None = None) -> tuple[Column, Column]:
    """Magnitude and error; below ``limit_sigma`` the limit at that many sigmas, without an error."""
    f, e = known(flux), known(error)
    mag = F.when(f > 0, zp - 2.5 * F.log10(f))
    err = F.when(f > 0, 2.5 / F.log(F.lit(10.0)) * e / f)
    if limit_sigma is None:
        return mag, err
    seen = f / F.when(e > 0, e) >= limit_sigma
    return F.when(seen, mag).when(e > 0, zp - 2.5 * F.log10(limit_sigma * e)), F.when(seen, err)


def colour(a: Column, a_err: Column, b: Column, b_err: Column) -> tuple[Column, Column]:
    """Difference of two bands and its error, where both errors are known."""
    return a - b, F.sqrt(a_err * a_err + b_err * b_err)


def aperture_zeropoint(zp: Column, fraction: Column) -> Column:
    """Zeropoint for an aperture that holds ``fraction`` of the light."""
    return F.when(fraction > 0, zp + 2.5 * F.log10(fraction))


def detection_limit(zp: Column, sigma: Column, n: float, factor: Column) -> Column:
    """Magnitude of a source n sigmas above the background."""
    return F.when(sigma * factor > 0, zp - 2.5 * F.log10(n * sigma * factor))


def gaussian(t: Column, height: Column, centre: Column, sigma: Column, offset: Column) -> Column:
    return height * F.exp(-0.5 * F.pow((t - centre) / sigma, 2)) + offset


def bazin(t: Column, height: Column, t0: Column, rise: Column, fall: Column, offset: Column) -> Column:
    """Exponential rise and fall; exponents are kept within ±50."""

    def clip(x: Column) -> Column:
        return F.greatest(F.lit(-50.0), F.least(F.lit(50.0), x))

    return height * F.exp(clip(-(t - t0) / fall)) / (1.0 + F.exp(clip(-(t - t0) / rise))) + offset


def bazin_exposed(t: Column, exposure: Column, height: Column, t0: Column, rise: Column, fall: Column, offset: Column, samples: int = 7) -> Column:
    """The profile averaged over an exposure around t, at ``samples`` evenly spaced instants from its beginning to its end; without an exposure that at t."""
    at_t = bazin(t, height, t0, rise, fall, offset)
    if samples < 2:
        return at_t
    steps = [i / (samples - 1) - 0.5 for i in range(samples)]
    return F.when(exposure > 0, sum((bazin(t + s * exposure, height, t0, rise, fall, offset) for s in steps), F.lit(0.0)) / samples).otherwise(at_t)


def localisation_error(snr: Column, a: float, b: float, c: float) -> Column:
    """Position error of a source of a signal-to-noise ratio: a power law above a floor."""
    return F.sqrt(F.pow(a * F.pow(snr, -b), 2) + c * c)


def flux_of_snr(snr: Column, background: Column, pixels: Column, exposure: Column) -> Column:
    """Flux (a second) whose ratio to its own noise over the exposure and the background's is ``snr`` (the positive root)."""
    own = snr * snr / exposure
    return (own + F.sqrt(own * own + 4 * snr * snr * pixels * background * background)) / 2


def centroid_error(e: Column, wcs: Column) -> Column:
    """Fit and pointing errors together; half a pixel where the latter isn't known."""
    return F.when(known(wcs).isNull(), 0.5).otherwise(F.sqrt(e * e + wcs * wcs) * 1.136)


def shape(a: Column, b: Column) -> tuple[Column, Column]:
    """Ellipticity and full width at half maximum from the two axes' deviations."""
    return 1.0 - b / a, 2.0 * F.sqrt(2.0 * F.log(F.lit(2.0))) * F.sqrt(a * b)


def sinusoid(t: Column, height: Column, period: Column, phase: Column) -> Column:
    return height * F.sin(2 * F.pi() * t / period + phase)


def star_class(psf_minus_kron: Column) -> Column:
    """2 for a galaxy unless the colour difference is under 0.1; 1 under 0.05; later rules win."""
    return F.when(psf_minus_kron < 0.05, 1).when(psf_minus_kron < 0.1, 2).otherwise(0)


def star_class_by_probability(star: Column) -> Column:
    """0 above 0.9, 2 below 0.7, else 1."""
    return F.when(star > 0.9, 0).when(star < 0.7, 2).otherwise(1)


def star_class_by_flags(*extended: Column) -> Column:
    """Of one flag a band: 0 (galaxy) if any is 3, else 1 (star) if any is 1, else 2; missing flags say nothing."""
    has = lambda n: F.array_contains(F.array_compact(F.array(*extended)), n)
    return F.when(has(3), 0).when(has(1), 1).otherwise(2)


def star_class_by_score(score: Column) -> Column:
    """1 from 0.9 up, 2 between 0.7 and 0.9, 0 below and where it is missing."""
    return F.when(score >= 0.9, 1).when(score > 0.7, 2).otherwise(0)


def unit_label(unit: Column) -> Column:
    return F.when(unit == "counts", "Counts (e/s)").when(unit == "mag", "AB magnitude").otherwise(F.concat(F.lit("Flux ("), unit, F.lit(")")))
