"""The fusion of all modalities into one row per cell, its statistics and its table."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import rules, stats, terrain
from ..operators.rasters import Raster, as_colour
from ..operators.stats import finite
from ..settings import NoDataError

#: Columns of a fused cell and their types.
COLUMNS = {
    "x": "double", "y": "double", "z": "float", "red": "short", "green": "short", "blue": "short", "elevation": "float", "object_height": "float", "slope": "float",
    "aspect": "float", "relief": "float", "image_class": "short", "image_confidence": "float", "in_building": "boolean", "on_road": "boolean", "in_water": "boolean",
    "building_height_osm": "float", "fused_class": "short", "rule": "short",
}


@dataclass
class Scene:
    """What is known of an area. Rasters on the elevation's grid are merged by cell, others are looked up by the cell's
    centre. Masks are relations (row, col) of the cells that are set, or boolean values of a raster; building_heights
    has row, col and height."""

    elevation: Raster
    rasters: dict[str, Raster] = field(default_factory=dict)
    masks: dict[str, DataFrame] = field(default_factory=dict)
    building_heights: DataFrame | None = None


def merged(base: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """base(row, col, ...) with the columns of all layers, each of them unique by cell, in one shuffle."""
    every = base.withColumn("_base", F.lit(True))
    for layer in layers:
        every = every.unionByName(layer, allowMissingColumns=True)
    keep = [c for c in every.columns if c not in ("row", "col", "_base")]
    one = every.groupBy("row", "col").agg(F.max("_base").alias("_base"), *[F.first(c, ignorenulls=True).alias(c) for c in keep])
    return one.filter("_base").drop("_base")


def on_grid(raster: Raster, grid: geo.Grid, like: DataFrame) -> DataFrame:
    """The raster's values at the centres of the grid's cells."""
    raster.check(grid.crs)
    values = [c for c in raster.cells.columns if c not in ("row", "col")]
    if raster.grid.matches(grid):
        return raster.cells.select("row", "col", *values)
    x = F.lit(grid.min_x) + (F.col("row") * 0 + F.col("col") + 0.5) * grid.resolution
    y = F.lit(grid.max_y) - (F.col("row") + 0.5) * grid.resolution
    row, col = raster.grid.cell_of(x, y)
    at = like.select("row", "col", row.alias("_r"), col.alias("_c"))
    there = raster.cells.select(F.col("row").alias("_r"), F.col("col").alias("_c"), *values)
    return at.join(there, ["_r", "_c"]).select("row", "col", *values)


def frame(scene: Scene, value: str = "z") -> DataFrame:
    """row, col and the columns of COLUMNS for each cell whose elevation is known.

    rasters may be named colours (red, green, blue), object_height, slope, aspect, relief, image_class and
    image_confidence; what is absent is null, or for colours and masks 0 and false."""
    grid = scene.elevation.grid
    base = scene.elevation.cells.select("row", "col", finite(F.col(value)).alias("z")).filter("z IS NOT NULL")
    layers = [on_grid(r, grid, base) for r in scene.rasters.values()]
    layers += [m.select("row", "col", F.lit(True).alias(name)) for name, m in scene.masks.items()]
    if scene.building_heights is not None:
        layers.append(scene.building_heights.select("row", "col", F.col("height").alias("building_height_osm")))
    t = merged(base, layers)
    have = set(t.columns)
    known = lambda c: finite(F.col(c).cast("double")) if c in have else F.lit(None).cast("double")
    made: dict[str, Column] = {c: known(c) for c in ("object_height", "slope", "aspect", "relief", "building_height_osm")}
    made |= {c: as_colour(F.col(c)) if c in have else F.lit(0) for c in ("red", "green", "blue")}
    made |= {c: F.coalesce(F.col(c), F.lit(False)) if c in have else F.lit(False) for c in ("in_building", "on_road", "in_water")}
    made |= {c: F.coalesce(known(c), F.lit(0.0)).cast(COLUMNS[c]) for c in ("image_class", "image_confidence")}
    x = F.lit(grid.min_x) + (F.col("col") + 0.5) * grid.resolution
    y = F.lit(grid.max_y) - (F.col("row") + 0.5) * grid.resolution
    t = t.withColumns(made | {"x": x, "y": y, "elevation": F.col("z")})
    plan = rules.plan("object_height" in have, bool(have & {"in_building", "on_road", "in_water"}))
    t = t.withColumn("_f", rules.fused(plan)).select("*", "_f.*")
    return t.select("row", "col", *[F.col(c).cast(kind).alias(c) for c, kind in COLUMNS.items()], "count_key")


def statistics(fused: DataFrame, cell_size: float) -> dict[str, Any]:
    """Cells, area, class shares and how often each rule decided; of bounded size. Nothing fused is an error."""
    counts = fused.groupBy("fused_class", "count_key").count().collect()
    n = sum(r["count"] for r in counts)
    if not n:
        raise NoDataError("no cell has an elevation")
    of_class = {c: sum(r["count"] for r in counts if r["fused_class"] == c) for c in rules.FUSED}
    of_rule: dict[str, int] = {}
    for r in counts:
        of_rule[r["count_key"]] = of_rule.get(r["count_key"], 0) + r["count"]
    return {"cells": n, "cell_size_m": cell_size, "area_m2": n * cell_size**2, "class_fractions": {rules.FUSED[c]: k / n for c, k in of_class.items()}, "rule_counts": of_rule}


def write(fused: DataFrame, path: str) -> None:
    """The fusion table: the 19 columns, zstd, in files of neighbouring cells."""
    fused.repartitionByRange("row", "col").sortWithinPartitions("row", "col").select(*COLUMNS).write.mode("overwrite").option("compression", "zstd").parquet(path)


def build(scene: Scene, path: str | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """The fused cells, written first where a path is given, and their statistics with what was skipped or missing."""
    fused = frame(scene)
    told = statistics(fused, scene.elevation.grid.resolution)
    wanted = ["colours", "object_height", "slope", "aspect", "relief", "image_class", "image_confidence"]
    told["modalities"] = {n: "available" if n in scene.rasters else "unavailable" for n in wanted}
    told["skipped_conditions"] = rules.skipped("object_height" in scene.rasters)
    if path:
        write(fused, path)
        fused = fused.sparkSession.read.parquet(path)
    return fused, told


def terrain_summary(cells: DataFrame, cell_size: float, mask: Column | None = None) -> DataFrame:
    """One row of figures for z, slope, aspect and, where there, relief, object_height and n_points, of the masked cells."""
    t = cells if mask is None else cells.filter(mask)
    parts = [t.agg(F.count("*").alias("cells"), (F.count("*") * cell_size**2).alias("area_m2"), stats.coverage(F.col("z")).alias("coverage"))]
    for c in ("z", "slope", "relief", "object_height", "n_points"):
        if c in cells.columns:
            s = stats.summary(t, F.col(c))
            parts.append(s.select(*[F.col(k).alias(f"{c}_{k}") for k in s.columns]))
    if "aspect" in cells.columns:
        parts.append(t.agg(stats.circular_mean(finite(F.col("aspect"))).alias("aspect_mean")))
    if "n_points" in cells.columns:
        parts.append(t.agg(F.try_divide(F.sum("n_points"), F.count("*") * cell_size**2).alias("points_per_m2")))
    return stats.beside(*parts)


def terrain_layers(cells: DataFrame, cell_size: float, z: str = "z", dsm: str | None = None, counts: DataFrame | None = None, tallest: float | None = None) -> DataFrame:
    """The terrain stage: every cell with slope, aspect, hillshade and relief, with ndsm where there is a surface and
    n_points where there are point counts(row, col, n_points). The stencils share the line and column windows."""
    t = terrain.relief(terrain.gradients(cells, cell_size, z), z=z)
    dx, dy = F.col("dz_dx"), F.col("dz_dy")
    t = t.withColumns({"slope": terrain.slope_deg(dx, dy), "aspect": terrain.aspect_deg(dx, dy), "hillshade": terrain.hillshade(dx, dy)}).drop("dz_dx", "dz_dy")
    if dsm is not None:
        t = t.withColumn("ndsm", terrain.normalised(F.col(dsm), F.col(z), 0.0, tallest))
    if counts is not None:
        t = t.join(counts, ["row", "col"], "left").withColumn("n_points", F.coalesce("n_points", F.lit(0)).cast("long"))
    return t


def negative_fraction(cells: DataFrame, z: str = "z", dsm: str = "dsm", below: float = -0.5) -> DataFrame:
    """The share of cells known in both whose surface lies further below the ground than noise explains."""
    h = finite(F.col(dsm)) - finite(F.col(z))
    return cells.agg(F.coalesce(F.avg(F.when(h.isNotNull(), (h < below).cast("int"))), F.lit(0.0)).alias("negative_fraction"))


def subregion(cells: DataFrame, grid: geo.Grid, box: geo.Box, geographic: bool = False) -> DataFrame:
    """terrain_summary of the whole cells that a box covers; a box beside the grid is an error."""
    if geographic:
        box = geo.transform_bounds(box, geo.GEOGRAPHIC, grid.crs)
    r0, r1, c0, c1 = grid.window(box)
    return terrain_summary(cells, grid.resolution, F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
