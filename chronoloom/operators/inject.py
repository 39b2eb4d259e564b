"""Synthetic truth: profiles added to frames, and light curves to recover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def flare(frame: Column, start: Column, peak: Column, decay: Column) -> Column:
    """A sharp rise at ``start`` and an exponential decay."""
    return F.when(frame >= start, peak * F.exp(-(frame - start) / decay)).otherwise(0.0)


def light_curves(injections: DataFrame, frames: int) -> DataFrame:
    """A row for each injection and frame: flux of a flare, of a negative flare or of a sinusoid.

    ``injections (injid, event_type, start, height, scale)``.
    """
    rows = injections.withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(frames - 1))))
    burst = flare(F.col("frame"), F.col("start"), F.col("height"), F.col("scale"))
    wave = F.col("height") * F.sin(2 * F.pi() * (F.col("frame") - F.col("start")) / F.col("scale"))
    flux = F.when(F.col("event_type") == "negative", -burst).when(F.col("event_type") == "sinusoid", wave).otherwise(burst)
    return rows.select("injid", "frame", flux.alias("flux"))


def add_to_pixels(pixels: DataFrame, curves: DataFrame, places: DataFrame, sigma: float, reach: int = 2) -> DataFrame:
    """``pixels (frame, x, y, flux)`` with each curve's light spread by a Gaussian around its place ``(injid, x, y)``."""
    steps = F.array(*[F.lit(i) for i in range(-reach, reach + 1)])
    spread = places.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
    weight = F.exp(-(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")) / (2 * sigma * sigma))
    spread = spread.select("injid", (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"), weight.alias("w"))
    total = spread.groupBy("injid").agg(F.sum("w").alias("total"))
    light = curves.join(spread.join(total, "injid"), "injid").select("frame", "x", "y", (F.col("flux") * F.col("w") / F.col("total")).alias("add"))
    light = light.groupBy("frame", "x", "y").agg(F.sum("add").alias("add"))
    return pixels.join(light, ["frame", "x", "y"], "left").select("frame", "x", "y", (F.col("flux") + F.coalesce("add", F.lit(0.0))).alias("flux"))
