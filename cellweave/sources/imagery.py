"""Pixels of decoded images, mosaics of tiles, map layers cut to a region, and sources chosen by configuration."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators.rasters import Raster, clip_ring, once
from ..settings import ConfigurationError, UnsupportedError
from .readers import TILE

BANDS = ("red", "green", "blue")


def image_pixels(images: DataFrame) -> DataFrame:
    """origin, row, col, red, green, blue of what spark.read.format("image") gives; one band stands for all three.

    An image's pixels are made inside an array, so its bytes are not copied for each of them."""
    byte = lambda k: f"cast(conv(hex(substr(image.data, p * image.nChannels + {k} + 1, 1)), 16, 10) AS int)"
    band = lambda k: f"IF(image.nChannels = 1, {byte(0)}, {byte(k)})"
    pixel = f"named_struct('row', cast(p div image.width AS int), 'col', cast(p % image.width AS int), 'red', {band(2)}, 'green', {band(1)}, 'blue', {band(0)})"
    t = images.filter("image.width > 0 AND image.height > 0")
    return t.select(F.col("image.origin").alias("origin"), F.explode(F.expr(f"transform(sequence(0, image.width * image.height - 1), p -> {pixel})")).alias("px")).select("origin", "px.*")


def with_validity(pixels: DataFrame) -> DataFrame:
    """Adds valid: true where any band of an image without a mask of its own is not 0."""
    return pixels.withColumn("valid", F.coalesce(F.greatest(*BANDS), F.lit(0)) > 0)


def tiles_asked(box: tuple[int, int, int, int], most: int) -> int:
    """How many tiles a range (first x, first y, last x, last y) has; more than `most` are refused."""
    n = (box[2] - box[0] + 1) * (box[3] - box[1] + 1)
    if n > most:
        raise UnsupportedError(f"{n} tiles are asked for, the limit is {most}; take a smaller region or zoom")
    return n


def whole_mosaic(tiles: DataFrame, box: tuple[int, int, int, int], most: int, values: tuple[str, ...] = ("z",), fill: Any = None, size: int = TILE) -> DataFrame:
    """row, col, the values and valid of every pixel of a range of tiles; pixels of absent tiles hold `fill` and are not
    valid, so that black ones of present tiles stay. Only the numbers of the tiles are shuffled."""
    n, wide = tiles_asked(box, most), box[2] - box[0] + 1
    inside = tiles.filter(F.col("tile_x").between(box[0], box[2]) & F.col("tile_y").between(box[1], box[3]))
    every = tiles.sparkSession.range(n).select((box[0] + F.col("id") % wide).alias("tile_x"), (box[1] + F.expr(f"id div {wide}")).alias("tile_y"))
    gone = every.join(inside.select("tile_x", "tile_y").distinct(), ["tile_x", "tile_y"], "left_anti")
    empty = gone.select("tile_x", "tile_y", F.explode(F.sequence(F.lit(0), F.lit(size * size - 1))).alias("_p"))
    empty = empty.withColumns({"row": F.expr(f"_p div {size}"), "col": F.col("_p") % size, **{v: F.lit(fill).cast(tiles.schema[v].dataType) for v in values}})
    at = [((F.col(f"tile_{a}") - low) * size + F.col(b)).cast("int").alias(b) for a, b, low in (("y", "row", box[1]), ("x", "col", box[0]))]
    return inside.select(*at, *values, F.lit(True).alias("valid")).unionByName(empty.select(*at, *values, F.lit(False).alias("valid")))


def mosaic_counts(tiles: DataFrame, box: tuple[int, int, int, int], most: int) -> DataFrame:
    """tiles_requested and tiles_returned of a range."""
    n = tiles_asked(box, most)
    inside = tiles.filter(F.col("tile_x").between(box[0], box[2]) & F.col("tile_y").between(box[1], box[3]))
    return inside.agg(F.lit(n).cast("long").alias("tiles_requested"), F.count_distinct("tile_x", "tile_y").alias("tiles_returned"))


def clip_line(line: Column, box: geo.Box) -> Column:
    """The parts of a line of struct<x, y> inside a box, segment by segment; empty if nothing is left."""
    def segments(nodes: Column) -> Column:
        n = F.greatest(F.size(nodes) - 1, F.lit(0))
        return F.zip_with(F.slice(nodes, 1, n), F.slice(nodes, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def cut(s: Column) -> Column:
        first, last, fits = [F.lit(0.0)], [F.lit(1.0)], F.lit(True)
        for axis, low, high in (("x", box[0], box[2]), ("y", box[1], box[3])):
            a, d = s["a"][axis], s["b"][axis] - s["a"][axis]
            ends = [F.try_divide(F.lit(float(v)) - a, d) for v in (low, high)]  # null where the segment runs along the axis
            first.append(F.coalesce(F.least(*ends), F.lit(0.0)))
            last.append(F.coalesce(F.greatest(*ends), F.lit(1.0)))
            fits = fits & ((d != 0) | a.between(low, high))
        t0, t1 = F.greatest(*first), F.least(*last)
        at = lambda t: F.struct(*[(s["a"][c] + t * (s["b"][c] - s["a"][c])).alias(c) for c in "xy"])
        return F.when(fits & (t0 < t1), F.array(at(t0), at(t1)))

    return F.filter(F.transform(once(line, segments), cut), lambda p: p.isNotNull())


def layer(elements: DataFrame, crs: str, box: geo.Box) -> DataFrame:
    """Map elements with `shapes`: their rings in a projected system cut to a region's box, polygons as rings and lines as
    parts; elements of which nothing is left go."""

    def placed(node: Column) -> Column:
        x, y = geo.transform(node["lon"], node["lat"], geo.GEOGRAPHIC, crs)
        return F.struct(x.alias("x"), y.alias("y"))

    rings = F.transform("rings", lambda r: F.transform(r, placed))
    areas = F.filter(F.transform(rings, lambda r: clip_ring(r, box)), lambda r: F.size(r) > 0)
    lines = F.flatten(F.transform(rings, lambda r: clip_line(r, box)))
    return elements.withColumn("shapes", F.when(F.col("kind") == "polygon", areas).otherwise(lines)).filter(F.size("shapes") > 0)


def read_raster(spark: SparkSession, path: str) -> Raster:
    """What api.write_raster wrote: the cells and, from beside them, the grid."""
    from ..settings import read_json

    grid = read_json(f"{path.rstrip('/')}.grid.json")
    if grid is None:
        raise ConfigurationError(f"{path} has no grid beside it")
    return Raster(spark.read.parquet(path), geo.Grid(**grid))


def read_window(raster: Raster, box: geo.Box) -> DataFrame:
    """The cells that a box covers; the filter reaches the row groups of a written raster."""
    r0, r1, c0, c1 = raster.grid.window(box)
    return raster.cells.filter(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))


def point_classes(points: DataFrame) -> DataFrame | None:
    """The class column of a point table, or None where it has none."""
    return points.select("classification") if "classification" in points.columns else None


def read_points(points: DataFrame, most: int | None = None, seed: int = 42, key: str = "id") -> DataFrame:
    """A written point table with colours in 8 bits again; of more than `most` points, that many by a seeded sample."""
    from ..operators.sampling import exact_sample

    points = points.withColumns({c: F.floor(F.col(c) / 257).cast("int") for c in BANDS if c in points.columns})
    return points if most is None else exact_sample(points, most, key, seed)


def elevation(kind: str, source: Mapping[str, Any], grid: geo.Grid, providers: Mapping[str, Callable[[Mapping[str, Any], geo.Grid], Raster]],
              stored: Raster | None = None, overwrite: bool = False) -> tuple[Raster, dict[str, Any]]:
    """The raster of a kind (dem or dsm) by the configured provider, and how it came. A stored raster on the same grid is
    used again. Provider `none` is an error of the configuration; surfaces made from tiles never count as true lidar."""
    if stored is not None and not overwrite and stored.grid.matches(grid):
        return stored, {"kind": kind, "provider": "stored", "reused": True}
    name = source.get("provider", "none")
    if name == "none":
        raise ConfigurationError(f"no {kind} source is configured; there are {', '.join(sorted(providers))}")
    if name not in providers:
        raise UnsupportedError(f"unknown provider {name!r} of {kind}; there are {', '.join(sorted(providers))}")
    lidar = bool(source.get("is_true_lidar")) and name != "gsi_tile"
    return providers[name](source, grid), {"kind": kind, "provider": name, "reused": False, "is_true_lidar": lidar}
