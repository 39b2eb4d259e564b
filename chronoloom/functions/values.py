"""Values: missing numbers, rounding, ranges of angles, dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def known(c: Column) -> Column:
    """NaN as null, so that aggregates leave it out and comparisons with it aren't true."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def round_half_up(c: Column) -> Column:
    """The integer nearest to c, halves upward (also below zero)."""
    return F.floor(c + 0.5).cast("long")


def wrap_degrees(c: Column) -> Column:
    """An angle's difference in [-180, 180)."""
    return F.pmod(c + 180.0, F.lit(360.0)) - 180.0


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def hex_to_int(c: Column) -> Column:
    """``0x1f`` as a number."""
    return F.conv(F.regexp_replace(F.lower(c), "^0x", ""), 16, 10).cast("long")


def microseconds(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without time zone (read as UTC)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def mjd(ts: Column) -> Column:
    """Modified Julian date in days."""
    return microseconds(ts) / 86400e6 + 40587.0


def iso_of_mjd(days: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.fff`` (UTC) of a modified Julian date, to the nearest millisecond (a double holds about a microsecond)."""
    whole = F.lit(86_400_000)
    millis = F.round((days - 40587.0) * 86400e3).cast("long")
    rest = F.pmod(millis, whole)
    day = F.date_add(F.lit("1970-01-01").cast("date"), ((millis - rest) / whole).cast("int"))
    part = lambda size, most: F.pmod(F.floor(rest / size), F.lit(most)).cast("int")
    return F.format_string("%sT%02d:%02d:%02d.%03d", day.cast("string"), part(3_600_000, 24), part(60_000, 60), part(1000, 60), part(1, 1000))


def mjd_of_stamp(c: Column) -> Column:
    """Modified Julian date of ``YYYYDDDHHMMSS`` (year, day of the year, time)."""
    days = F.datediff(F.make_date(F.substring(c, 1, 4).cast("int"), F.lit(1), F.lit(1)), F.lit("1970-01-01").cast("date"))
    seconds = F.substring(c, 8, 2).cast("int") * 3600 + F.substring(c, 10, 2).cast("int") * 60 + F.substring(c, 12, 2).cast("int")
    return days + F.substring(c, 5, 3).cast("int") - 1 + seconds / 86400.0 + 40587.0


def bin_seconds(c: Column) -> Column:
    """Seconds of a time bin such as ``10min``, ``2hr``, ``200sec`` or ``1day``; plurals too; null for anything else."""
    unit = F.regexp_extract(F.lower(c), r"^\s*([0-9.]+)\s*([a-z]+?)s?\s*$", 2)
    value = F.regexp_extract(F.lower(c), r"^\s*([0-9.]+)\s*([a-z]+?)s?\s*$", 1)
    scale = F.when(unit == "sec", 1.0).when(unit == "min", 60.0).when(unit.isin("hr", "hour"), 3600.0).when(unit == "day", 86400.0)
    return F.when(value != "", F.try_to_number(value, F.lit("999999.999")).cast("double")) * scale


def frames_in_bin(seconds: Column, cadence_seconds: Column, at_least_one: bool) -> Column:
    """Frames of a bin: rounded half up and possibly none, or half to even and at least one."""
    n = seconds / cadence_seconds
    return F.greatest(F.lit(1), F.bround(n).cast("int")) if at_least_one else F.floor(n + 0.5).cast("int")


#: The published rational approximations of the normal quantile (AS 241), numerators and denominators from the constant up.
NORMAL_QUANTILE = {
    "middle": ((3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125, 45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727), (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610)),
    "tail": ((1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504, 1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4), (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9)),
    "far": ((6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230, 0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7), (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)),
}


def horner(coefficients, x):
    """A polynomial's value, coefficients from the constant up."""
    out = coefficients[-1]
    for c in coefficients[-2::-1]:
        out = out * x + c
    return out


def tail_depth(p: Column) -> Column:
    """How far out a share lies, as ``normal_quantile`` measures it."""
    return F.sqrt(-F.ln(F.least(p, 1 - p)))


def normal_quantile(p: Column, depth: Column | None = None) -> Column:
    """The standard normal value below which a share ``p`` lies; null outside 0 < p < 1. A column that holds ``tail_depth(p)`` keeps the expression short."""
    q = p - 0.5
    r = tail_depth(p) if depth is None else depth
    ratio = lambda part, x: horner(NORMAL_QUANTILE[part][0], x) / horner(NORMAL_QUANTILE[part][1], x)
    tail = F.when(r <= 5, ratio("tail", r - 1.6)).otherwise(ratio("far", r - 5))
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, q * ratio("middle", 0.180625 - q * q)).otherwise(F.signum(q) * tail))
