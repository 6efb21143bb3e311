"""Raster sampling as joins, rasterisation as bucketed joins, voxel and tile sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest(points: DataFrame, raster: DataFrame, row: Column, col: Column, value: str, fill: object = None) -> DataFrame:
    """points with the value of the cell they stand in; `fill` outside. Cells are binned by floor."""
    got = raster.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value))
    t = points.withColumns({"_row": row, "_col": col}).join(got, (F.col("_row") == F.col("_r")) & (F.col("_col") == F.col("_c")), "left").drop("_row", "_col", "_r", "_c")
    return t if fill is None else t.withColumn(value, F.coalesce(value, F.lit(fill)))


def bilinear(points: DataFrame, raster: DataFrame, key: str, row_f: Column, col_f: Column, value: str) -> DataFrame:
    """key and value: the four cells around fractional (row, col) by weight, null cells left out and weights made up for."""
    r0, c0 = F.floor(row_f), F.floor(col_f)
    fr, fc = row_f - r0, col_f - c0
    corner = lambda dr, dc, w: F.struct((r0 + dr).cast("int").alias("row"), (c0 + dc).cast("int").alias("col"), w.alias("w"))
    four = F.array(corner(0, 0, (1 - fr) * (1 - fc)), corner(0, 1, (1 - fr) * fc), corner(1, 0, fr * (1 - fc)), corner(1, 1, fr * fc))
    t = points.select(key, F.inline(F.filter(four, lambda x: x["w"] > 0)))
    t = t.join(raster.select("row", "col", F.col(value).alias("_v")), ["row", "col"], "left")
    known = F.col("_v").isNotNull()
    return t.groupBy(key).agg(F.try_divide(F.sum(F.when(known, F.col("w") * F.col("_v"))), F.sum(F.when(known, F.col("w")))).alias(value))


def rasterize_boxes(cells: DataFrame, boxes: DataFrame, block: int, x: Column, y: Column) -> DataFrame:
    """For each cell whose centre (x, y) lies in a box(min_x, min_y, max_x, max_y, height, seq): row, col and the height of the last.

    Boxes and cells meet on square blocks of `block` units, so it is an equi-join with a residual."""
    key = lambda c: F.floor(c / block)
    span = lambda a, b: F.explode(F.sequence(key(F.col(a)), key(F.col(b))))
    b = boxes.withColumn("_bx", span("min_x", "max_x")).withColumn("_by", span("min_y", "max_y"))
    c = cells.select("row", "col", x.alias("_x"), y.alias("_y")).withColumns({"_bx": key(F.col("_x")), "_by": key(F.col("_y"))})
    inside = c.join(b, ["_bx", "_by"]).filter((F.col("_x") > F.col("min_x")) & (F.col("_x") < F.col("max_x")) & (F.col("_y") > F.col("min_y")) & (F.col("_y") < F.col("max_y")))
    return inside.groupBy("row", "col").agg(F.max_by("height", "seq").alias("height"))


def ring_contains(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test of a point against a closed ring of struct<x, y>."""
    edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])
    return F.size(F.filter(edges, crosses)) % 2 == 1


def line_within(x: Column, y: Column, line: Column, radius: float) -> Column:
    """True where a point is no farther than radius from a polyline of struct<x, y>."""
    edges = F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    def near(e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        t = F.least(F.greatest(F.coalesce(F.try_divide((x - e["a"]["x"]) * dx + (y - e["a"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
        return F.hypot(x - e["a"]["x"] - t * dx, y - e["a"]["y"] - t * dy) <= radius
    return F.exists(edges, near)


def rasterize_shapes(cells: DataFrame, shapes: DataFrame, block: int, x: Column, y: Column, radius: float | None = None) -> DataFrame:
    """For each cell whose centre (x, y) lies in a shape(points, height, seq): row, col and the height of the last.

    points are a closed ring of struct<x, y>, or with a radius a line that reaches that far. Cells meet the shapes'
    bounding boxes on blocks as in rasterize_boxes; then the shape itself decides."""
    key = lambda c: F.floor(c / block)
    reach = radius or 0.0
    span = lambda c: F.explode(F.sequence(key(F.array_min(F.col(f"points.{c}")) - reach), key(F.array_max(F.col(f"points.{c}")) + reach)))
    s = shapes.withColumn("_bx", span("x")).withColumn("_by", span("y"))
    c = cells.select("row", "col", x.alias("_x"), y.alias("_y")).withColumns({"_bx": key(F.col("_x")), "_by": key(F.col("_y"))})
    at = (F.col("_x"), F.col("_y"), F.col("points"))
    inside = c.join(s, ["_bx", "_by"]).filter(ring_contains(*at) if radius is None else line_within(*at, radius))
    return inside.groupBy("row", "col").agg(F.max_by("height", "seq").alias("height"))


def voxel_first(points: DataFrame, size: float, order: list[str], xyz: tuple[str, str, str] = ("x", "y", "z")) -> DataFrame:
    """The first point of each voxel in the given order, found by a partial aggregate rather than a sort."""
    if size <= 0:
        raise ValueError("the voxel size must be positive")
    keys = [F.floor(F.col(c) / size).alias(f"_k{i}") for i, c in enumerate(xyz)]
    rest = [c for c in points.columns if c not in order]
    best = points.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_p"))
    return best.select("_p.*")


def exact_sample(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """n rows, the same for the same seed however the data is partitioned."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def tile_counts(points: DataFrame, tile: float, least: int) -> DataFrame:
    """tile_y, tile_x, n of tiles with enough points, from the data's own origin, with a dense tile_id."""
    origin = points.agg(F.min("x").alias("x0"), F.min("y").alias("y0")).withColumn("_one", F.lit(1))
    t = points.withColumn("_one", F.lit(1)).join(F.broadcast(origin), "_one")
    t = t.groupBy(F.floor((F.col("y") - F.col("y0")) / tile).alias("tile_y"), F.floor((F.col("x") - F.col("x0")) / tile).alias("tile_x")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return t.withColumn("tile_id", (F.row_number().over(Window.orderBy("tile_y", "tile_x")) - 1).cast("long"))


def majority(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The most frequent value of each group; the lowest of equal ones."""
    n = df.groupBy(*group, value).agg(F.count("*").alias("n"))
    return n.groupBy(*group).agg(F.max(F.struct("n", (-F.col(value)).alias("v"))).alias("_m")).select(*group, (-F.col("_m.v")).alias(value), F.col("_m.n").alias("n"))


def class_shares(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Share of each value within its group."""
    n = df.groupBy(*group, value).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*group))).drop("n")
