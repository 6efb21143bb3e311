"""Validation checks over cells: one row of figures and a status each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stats

#: Limits of the checks, in metres or shares.
BELOW_M, FEW_BELOW, SOME_BELOW = -0.5, 0.02, 0.05
TALL_M, TALL_SHARE, MEDIAN_GAP_M = 2.5, 0.5, 1.0
COLOUR_R, COLOUR_R_WARN = 0.95, 0.8


def surface_over_ground(cells: DataFrame, height: Column) -> DataFrame:
    """Share of known heights that lie below ground; without any, the check fails at 1."""
    height = stats.finite(height)
    share = F.coalesce(F.avg((height < BELOW_M).cast("int")), F.lit(1.0)).alias("negative_fraction")
    t = stats.beside(cells.agg(share), stats.quantiles(cells, height, {"median_difference_m": 0.5}))
    n = F.col("negative_fraction")
    return t.withColumn("status", F.when(n < FEW_BELOW, "pass").when(n < SOME_BELOW, "warn").otherwise("fail"))


def buildings_are_tall(cells: DataFrame, height: Column, building: Column) -> DataFrame:
    """Medians of known heights inside and outside footprints, and the share of tall ones inside."""
    inside, outside = (F.when(x, stats.finite(height)) for x in (building, ~building))
    medians = [stats.quantiles(cells, inside, {"median_inside_m": 0.5}), stats.quantiles(cells, outside, {"median_outside_m": 0.5})]
    t = stats.beside(*medians, cells.agg(F.avg((inside > TALL_M).cast("int")).alias("tall_fraction")))
    missing = F.col("median_inside_m").isNull() | F.col("median_outside_m").isNull()
    good = (F.col("median_inside_m") > F.col("median_outside_m") + MEDIAN_GAP_M) & (F.col("tall_fraction") > TALL_SHARE)
    return t.withColumn("status", F.when(missing, "unavailable").when(good, "pass").otherwise("fail"))


def colours_agree(points: DataFrame, rgb: list[Column], reference: list[Column]) -> DataFrame:
    """Correlation of red, mean absolute difference over all channels, and points without colour."""
    apart = sum((F.abs(a - b) for a, b in zip(rgb, reference, strict=True)), F.lit(0.0)) / len(rgb)
    t = points.agg(F.count("*").alias("points"), F.count_if(sum(rgb, F.lit(0)) == 0).alias("unsampled_points"), F.corr(rgb[0], reference[0]).alias("red_correlation"), F.avg(apart).alias("mean_abs_difference"))
    r = F.col("red_correlation")
    return t.withColumn("status", F.when((F.col("unsampled_points") == 0) & (r > COLOUR_R), "pass").when(r > COLOUR_R_WARN, "warn").otherwise("fail"))
