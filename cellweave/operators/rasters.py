"""Rasters as a cell relation and its grid: sampling with a check of the system, regridding, points from surfaces."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..settings import CrsError, NoDataError, ResourceError, UnsupportedError
from . import sampling
from .stats import finite


@dataclass(frozen=True)
class Raster:
    """cells(row, col, values...) on a grid."""

    cells: DataFrame
    grid: geo.Grid

    def check(self, crs: str) -> None:
        """Points of another system are refused rather than sampled at the wrong place."""
        if not self.grid.crs:
            raise CrsError("the raster names no coordinate system")
        if self.grid.crs != crs:
            raise CrsError(f"the points are in {crs}, the raster is in {self.grid.crs}; transform them first")


def mask_values(points: DataFrame, mask: DataFrame, grid: geo.Grid, value: str, x: Column, y: Column) -> DataFrame:
    """points with the value of their cell, points beyond the grid with that of the nearest cell at its edge."""
    row, col = grid.cell_of(x, y)
    clip = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1))
    return sampling.nearest(points, mask, clip(row, grid.height), clip(col, grid.width), value)


def sample(points: DataFrame, raster: Raster, value: str, key: str, crs: str, method: str = "nearest") -> DataFrame:
    """points(key, x, y, ...) with the raster's value, null outside."""
    raster.check(crs)
    if method == "nearest":
        row, col = raster.grid.cell_of(F.col("x"), F.col("y"))
        return sampling.nearest(points, raster.cells.withColumn(value, finite(F.col(value))), row, col, value)
    if method != "bilinear":
        raise UnsupportedError(f"sampling is nearest or bilinear, not {method}")
    row, col = raster.grid.place_of(F.col("x"), F.col("y"))
    known = raster.cells.select("row", "col", finite(F.col(value)).alias(value))
    got = sampling.bilinear(points, known, key, row, col, value)
    inside = geo.in_box(F.col("x"), F.col("y"), (raster.grid.min_x, raster.grid.min_y, raster.grid.max_x, raster.grid.max_y), closed=True)
    return points.join(got, key, "left").withColumn(value, F.when(inside, F.col(value)))


def point_window(points: DataFrame, grid: geo.Grid, pad: int = 1) -> DataFrame:
    """One row row_min, row_max, col_min, col_max (the last ones left out) of the cells around the points inside the
    grid; null where none is."""
    row, col = grid.cell_of(F.col("x"), F.col("y"))
    t = points.select(row.alias("row"), col.alias("col")).filter(F.col("row").between(0, grid.height - 1) & F.col("col").between(0, grid.width - 1))
    ends = [f(F.min(c) - pad, F.lit(0)) if f is F.greatest else f(F.max(c) + pad + 1, F.lit(n)) for c, n in (("row", grid.height), ("col", grid.width)) for f in (F.greatest, F.least)]
    some = F.count("*") > 0
    return t.agg(*[F.when(some, e).cast("int").alias(n) for e, n in zip(ends, ("row_min", "row_max", "col_min", "col_max"), strict=True)])


def in_window(cells: DataFrame, window: DataFrame) -> DataFrame:
    """The cells of a window of one row, which is small whatever the cells are."""
    near = cells["row"].between(F.col("row_min"), F.col("row_max") - 1) & cells["col"].between(F.col("col_min"), F.col("col_max") - 1)
    return cells.join(F.broadcast(window), near, "left_semi")


def as_colour(c: Column) -> Column:
    """0 to 255; 0 where unknown."""
    return F.least(F.greatest(F.rint(F.coalesce(finite(c.cast("double")), F.lit(0.0))), F.lit(0.0)), F.lit(255.0)).cast("short")


def sample_rgb(points: DataFrame, raster: Raster, crs: str) -> DataFrame:
    """points with red, green and blue of the cell they stand in; black outside."""
    raster.check(crs)
    row, col = raster.grid.cell_of(F.col("x"), F.col("y"))
    bands = ["red", "green", "blue"]
    packed = raster.cells.select("row", "col", F.struct(*bands).alias("_rgb"))
    t = sampling.nearest(points, packed, row, col, "_rgb")
    return t.withColumns({b: as_colour(F.col(f"_rgb.{b}")) for b in bands}).drop("_rgb")


def regrid(source: Raster, target: geo.Grid, value: str, method: str = "nearest") -> DataFrame:
    """row, col and value of every target cell. nearest and bilinear look the target's centres up in the source;
    average, min, max and mode gather the source's centres by target cell."""
    src = source.grid
    spark = source.cells.sparkSession
    if method in ("nearest", "bilinear"):
        cells = target.cells(spark)
        x, y = geo.transform(F.col("x"), F.col("y"), target.crs, src.crs)
        t = cells.select("row", "col", x.alias("x"), y.alias("y"))
        t = t.withColumnsRenamed({"row": "_trow", "col": "_tcol"}).withColumn("_key", F.col("_trow").cast("long") * target.width + F.col("_tcol"))
        got = sample(t, source, value, "_key", src.crs, method)
        return got.select(F.col("_trow").alias("row"), F.col("_tcol").alias("col"), value)
    gather = {"average": F.avg, "min": F.min, "max": F.max, "mode": lambda c: F.mode(c, True)}
    if method not in gather:
        raise UnsupportedError(f"unknown resampling {method}")
    x = F.lit(src.min_x) + (F.col("col") + 0.5) * src.resolution
    y = F.lit(src.max_y) - (F.col("row") + 0.5) * src.resolution
    row, col = target.cell_of(*geo.transform(x, y, src.crs, target.crs))
    binned = source.cells.select(row.alias("row"), col.alias("col"), finite(F.col(value)).alias(value)).groupBy("row", "col").agg(gather[method](F.col(value)).alias(value))
    return target.cells(spark).select("row", "col").join(binned, ["row", "col"], "left")


def choose_surface(wanted: str, dem: Raster | None, dsm: Raster | None) -> tuple[str, Raster]:
    """dsm or dem by name; auto takes the surface model where there is one."""
    have = {"dsm": dsm, "dem": dem}
    name = wanted if wanted != "auto" else ("dsm" if dsm is not None else "dem")
    if name not in have:
        raise UnsupportedError(f"a surface is auto, dsm or dem, not {wanted}")
    if have[name] is None:
        raise NoDataError(f"there is no {name}")
    return name, have[name]


def point_cloud(surface: Raster, colours: Raster | None, grid: geo.Grid, most: int, value: str = "z") -> DataFrame:
    """x, y, z, red, green, blue of each cell of a grid whose height is known: z bilinear, colours of the cell."""
    if grid.width * grid.height > most:
        raise ResourceError(f"{grid.width * grid.height} points are more than the {most} allowed")
    cells = grid.cells(surface.cells.sparkSession).withColumn("idx", F.col("row").cast("long") * grid.width + F.col("col"))
    t = sample(cells.select("idx", "x", "y"), surface, value, "idx", grid.crs, "bilinear").filter(F.col(value).isNotNull())
    if colours is None:
        return t.withColumns({c: F.lit(0).cast("short") for c in ("red", "green", "blue")})
    return sample_rgb(t, colours, grid.crs)


def tile_members(cells: DataFrame, height: int, width: int, tile: int, overlap: int) -> DataFrame:
    """cells in every tile of an overlapping cover, with the tile's origin and the place in it; up to four times each."""
    from .learning import tile_origins

    def starts(c: str, size: int) -> Column:
        every = F.array(*[F.lit(v) for v in tile_origins(size, tile, overlap)])
        return F.explode(F.filter(every, lambda o: (o <= F.col(c)) & (F.col(c) < o + tile)))

    t = cells.withColumn("tile_row", starts("row", height)).withColumn("tile_col", starts("col", width))
    return t.withColumns({"row_in": F.col("row") - F.col("tile_row"), "col_in": F.col("col") - F.col("tile_col")})


def once(value: Column, f) -> Column:
    """f(value), with the value worked out once however often f uses it; inside lambdas nothing else shares it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def clip_ring(ring: Column, box: geo.Box) -> Column:
    """A closed ring of struct<x, y> cut to a box, side by side; closed again, or empty if nothing is left."""

    def cut(points: Column, inside, meet) -> Column:
        return once(points, lambda p: cut_once(p, inside, meet))

    def cut_once(points: Column, inside, meet) -> Column:
        edges = F.zip_with(points, F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        none = F.slice(points, 1, 0)

        def told(e: Column) -> Column:
            a, b = e["a"], e["b"]
            return F.when(inside(a) & inside(b), F.array(b)).when(inside(a), F.array(meet(a, b))).when(inside(b), F.array(meet(a, b), b)).otherwise(none)

        return F.flatten(F.transform(edges, told))

    def at(axis: str, v: float):
        other = "y" if axis == "x" else "x"

        def meet(a: Column, b: Column) -> Column:
            t = (F.lit(v) - a[axis]) / (b[axis] - a[axis])
            value = {axis: F.lit(float(v)), other: a[other] + t * (b[other] - a[other])}
            return F.struct(value["x"].alias("x"), value["y"].alias("y"))

        return meet

    out = once(ring, lambda r: F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))))
    for axis, v, over in (("x", box[0], True), ("y", box[1], True), ("x", box[2], False), ("y", box[3], False)):
        out = cut(out, (lambda p, axis=axis, v=v: p[axis] >= v) if over else (lambda p, axis=axis, v=v: p[axis] <= v), at(axis, v))
    return once(out, lambda p: F.when(F.size(p) >= 3, F.concat(p, F.slice(p, 1, 1))).otherwise(F.slice(p, 1, 0)))
