"""Display data: decimated rasters, stretch limits, histograms, clouds seen aslant, first rows and first occurrences."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stats


def decimate(cells: DataFrame, value: str, factor: int) -> DataFrame:
    """The average of each block of factor x factor cells, nulls left out."""
    block = lambda c: F.expr(f"{c} div {factor}").cast("int").alias(c)
    return cells.groupBy(block("row"), block("col")).agg(F.avg(stats.finite(F.col(value))).alias(value))


def stretch(cells: DataFrame, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Limits of a display stretch: the known values' quantiles."""
    return stats.quantiles(cells, F.col(value), {"low": low, "high": high})


def histogram(cells: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """bin and n of equal-width bins over the known values' range, the last one closed; empty bins have n = 0."""
    v = cells.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    ends = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("_one", F.lit(1))
    place = F.coalesce(F.try_divide((F.col("v") - F.col("lo")) * bins, F.col("hi") - F.col("lo")), F.lit(bins / 2))
    n = v.withColumn("_one", F.lit(1)).join(F.broadcast(ends), "_one").groupBy(F.least(F.floor(place), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = cells.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(n, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def from_origin(points: DataFrame, axes: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """points with their axes counted from the smallest value of each."""
    least = points.agg(*[F.min(c).alias(f"_{c}") for c in axes]).withColumn("_one", F.lit(1))
    t = points.withColumn("_one", F.lit(1)).join(F.broadcast(least), "_one")
    return t.withColumns({c: F.col(c) - F.col(f"_{c}") for c in axes}).drop("_one", *[f"_{c}" for c in axes])


def oblique(points: DataFrame, azimuth: float = 45.0, tilt: float = 35.0) -> DataFrame:
    """Adds screen_x, screen_y and depth of x, y, z seen aslant; sorted by falling depth, far points are drawn first."""
    a, t = math.radians(azimuth), math.radians(tilt)
    p = from_origin(points)
    p = p.withColumn("depth", F.col("x") * math.sin(a) + F.col("y") * math.cos(a))
    return p.withColumns({"screen_x": F.col("x") * math.cos(a) - F.col("y") * math.sin(a), "screen_y": F.col("depth") * math.sin(t) + F.col("z") * math.cos(t)})


def painters_order(points: DataFrame, *ties: str) -> DataFrame:
    return points.orderBy(F.col("depth").desc(), *ties)


def hex_colour(red: Column, green: Column, blue: Column) -> Column:
    """#rrggbb of three bands of 0 to 255."""
    return F.lower(F.concat(F.lit("#"), *[F.lpad(F.hex(c.cast("int")), 2, "0") for c in (red, green, blue)]))


def sorted_values(df: DataFrame, value: str) -> DataFrame:
    return df.select(value).distinct().orderBy(value)


def first_of_each(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; partial limits come before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_n", place).filter(F.col("_n") <= n).drop("_n")


def first_occurrences(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each combination of keys once, with the place where it first stands, in that order."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(*keys, "_first.*").orderBy(*order)
