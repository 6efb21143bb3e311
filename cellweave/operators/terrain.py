"""Terrain stencils over a dense cell relation (row, col, z).

Stencils are separable: one window along the rows, one along the columns, so each takes two shuffles on
keys with as many values as the grid has rows or columns, and no task holds more than a line of cells at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import finite

FLAT = 1e-4


def gradients(cells: DataFrame, cell_size: float, z: str = "z", shape: tuple[int, int] | None = None) -> DataFrame:
    """Adds dz_dx and dz_dy by Horn's 3x3 weights with replicated edges; a missing neighbour gives null.

    A neighbour is missing where its value is null or NaN or its cell is not there. The edge is where shape (rows,
    columns) says, or without it where a line of cells begins or ends."""
    v = finite(F.col(z).cast("double"))
    along = Window.partitionBy("row").orderBy("col")
    down = Window.partitionBy("col").orderBy("row")

    def at(c: Column, n: int, w) -> Column:
        """The cell before (n = 1) or after (-1); the cell's own value beyond the edge."""
        line, size = ("col", 1) if w is along else ("row", 0)
        there = F.lag(line, n).over(w)
        edge = F.lit(True) if shape is None else F.col(line) == (0 if n > 0 else shape[size] - 1)
        return F.when(there.isNull(), F.when(edge, c)).when(there == F.col(line) - n, F.lag(c, n).over(w))

    t = cells.withColumns({"_w": at(v, 1, along), "_e": at(v, -1, along)})
    t = t.withColumns({"_h": F.col("_e") - F.col("_w"), "_s": F.col("_w") + 2 * v + F.col("_e")})
    h_up, h_down = at(F.col("_h"), 1, down), at(F.col("_h"), -1, down)
    s_up, s_down = at(F.col("_s"), 1, down), at(F.col("_s"), -1, down)
    dx, dy = (h_up + 2 * F.col("_h") + h_down) / (8 * cell_size), (s_down - s_up) / (8 * cell_size)
    return t.withColumns({"dz_dx": dx, "dz_dy": dy}).drop("_w", "_e", "_h", "_s")


def slope_deg(dx: Column, dy: Column) -> Column:
    return F.degrees(F.atan(F.hypot(dx, dy)))


def slope_percent(dx: Column, dy: Column) -> Column:
    return F.hypot(dx, dy) * 100


def aspect_deg(dx: Column, dy: Column) -> Column:
    """Downslope bearing; null where it is flat."""
    return F.when(F.hypot(dx, dy) >= FLAT, F.pmod(F.degrees(F.atan2(-dx, dy)), F.lit(360.0)))


def hillshade(dx: Column, dy: Column, azimuth: float = 315.0, altitude: float = 45.0, z_factor: float = 1.0) -> Column:
    """Lambert shade of 0 to 255."""
    slope, facing = F.atan(F.hypot(dx, dy) * z_factor), F.atan2(-dx, dy)
    zen = F.radians(F.lit(90.0 - altitude))
    shade = F.cos(zen) * F.cos(slope) + F.sin(zen) * F.sin(slope) * F.cos(F.radians(F.lit(azimuth)) - facing)
    return F.least(F.greatest(shade, F.lit(0.0)), F.lit(1.0)) * 255


def relief(cells: DataFrame, window_cells: int = 5, z: str = "z") -> DataFrame:
    """Adds relief: largest less smallest value of an odd square window, nulls ignored, null where the centre is."""
    r = window_cells // 2
    a = Window.partitionBy("row").orderBy("col").rangeBetween(-r, r)
    b = Window.partitionBy("col").orderBy("row").rangeBetween(-r, r)
    v = finite(F.col(z))
    t = cells.withColumns({"_hi": F.max(v).over(a), "_lo": F.min(v).over(a)})
    t = t.withColumns({"_hi": F.max("_hi").over(b), "_lo": F.min("_lo").over(b)})
    return t.withColumn("relief", F.when(v.isNotNull(), F.col("_hi") - F.col("_lo"))).drop("_hi", "_lo")


def normalised(dsm: Column, dem: Column, low: float = 0.0, high: float | None = None) -> Column:
    """Height above ground, clipped; null if either is."""
    dsm, dem = finite(dsm), finite(dem)
    d = F.greatest(dsm - dem, F.lit(low))
    return F.when(dsm.isNotNull() & dem.isNotNull(), d if high is None else F.least(d, F.lit(high)))


def point_density(points: DataFrame, cells: DataFrame, row: Column, col: Column) -> DataFrame:
    """cells with n_points, zero where none; points outside the cells are left out."""
    n = points.groupBy(row.alias("row"), col.alias("col")).agg(F.count("*").alias("n_points"))
    return cells.join(n, ["row", "col"], "left").withColumn("n_points", F.coalesce("n_points", F.lit(0)).cast("long"))
