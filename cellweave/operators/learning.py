"""Inputs for learning: point features, fixed-size tile samples, class probabilities, blended tiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scales of the input channels.
Z_SCALE, SLOPE_SCALE, RELIEF_SCALE, HEIGHT_SCALE = 50.0, 90.0, 20.0, 30.0
FEATURE_SETS = ["xyz", "xyz_rgb", "xyz_rgb_terrain", "xyz_rgb_terrain_semantic"]


def feature_dimension(feature_set: str, n_classes: int) -> int:
    return [3, 6, 12, 14 + n_classes][FEATURE_SETS.index(feature_set)]


def features(points: DataFrame, feature_set: str, tile: list[str], x0: Column, y0: Column, tile_size: float, n_classes: int) -> DataFrame:
    """points with an array of input channels; unknown terrain counts as 0, z is above the tile's lowest point."""
    half = tile_size / 2
    known = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
    channels = [(F.col("x") - (x0 + half)) / half, (F.col("y") - (y0 + half)) / half, (F.col("z") - F.min("z").over(Window.partitionBy(*tile))) / Z_SCALE]
    if feature_set != "xyz":
        channels += [F.col(c) / 255.0 for c in ("red", "green", "blue")]
    if feature_set in FEATURE_SETS[2:]:
        aspect, has = F.radians(known("aspect")), F.col("object_height").isNotNull() & ~F.isnan("object_height")
        channels += [known("slope") / SLOPE_SCALE, F.sin(aspect), F.cos(aspect), known("relief") / RELIEF_SCALE, known("object_height") / HEIGHT_SCALE, has.cast("double")]
    if feature_set == FEATURE_SETS[3]:
        channels += [F.when(F.col("image_class") == i, known("image_confidence")).otherwise(F.lit(0.0)) for i in range(n_classes)]
        channels += [F.col(c).cast("double") for c in ("in_building", "on_road")]
    return points.withColumn("features", F.array(*[c.cast("float") for c in channels]))


def fixed_sample(points: DataFrame, tile: list[str], n: int, order: list[Column]) -> DataFrame:
    """n points of each tile with their draw, the first in the given order; a tile with fewer gives its points again in turn."""
    w = Window.partitionBy(*tile)
    t = points.withColumns({"_k": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count("*").over(w)}).filter(F.col("_k") < n)
    draws = F.sequence(F.col("_k"), F.lit(n - 1), F.least("_n", F.lit(n)).cast("int"))
    return t.withColumn("draw", F.explode(draws)).drop("_k", "_n")


def project_classes(scores: DataFrame, cell: list[str], source: str, p: str, mapping: dict[int, int]) -> DataFrame:
    """cell, class_id and confidence: probabilities summed over the source classes of each project class, the lowest class of equal ones."""
    to = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    t = scores.groupBy(*cell, F.coalesce(F.try_element_at(to, F.col(source)), F.lit(0)).alias("class_id")).agg(F.sum(p).alias("confidence"))
    best = t.groupBy(*cell).agg(F.max(F.struct("confidence", (-F.col("class_id")).alias("c"))).alias("_b"))
    return best.select(*cell, (-F.col("_b.c")).alias("class_id"), F.col("_b.confidence").alias("confidence"))


def tile_origins(size: int, tile: int, overlap: int) -> list[int]:
    """Starts of windows over `size`; the last is drawn back to end at the edge."""
    last = max(0, size - tile)
    return sorted({*range(0, last + 1, max(1, tile - overlap)), last})


def blend_weight(row: Column, col: Column, tile: int, taper: int, floor: float = 0.05) -> Column:
    """Separable cosine taper towards a tile's edges; the product of both axes is not below `floor`."""
    reach = min(taper, tile // 2)

    def along(c: Column) -> Column:
        steps = F.least(c, F.lit(tile - 1) - c) + 1
        return F.when(steps <= reach, (1 - F.cos(math.pi * steps / (reach + 1))) / 2).otherwise(F.lit(1.0))

    return F.greatest(along(row) * along(col), F.lit(floor))


def blended(scores: DataFrame, cell: list[str], group: str, p: str, weight: Column) -> DataFrame:
    """cell, group and the weighted mean of p over the tiles that overlap in a cell."""
    return scores.groupBy(*cell, group).agg((F.sum(F.col(p) * weight) / F.greatest(F.sum(weight), F.lit(1e-6))).alias(p))


#: Words by which a segmentation model's labels are told to belong to a class.
LABEL_GROUPS = {
    "building": ["building", "edifice", "house", "skyscraper", "hovel", "hut", "shack", "tower", "booth", "kiosk", "tent", "shelter"],
    "road": ["road", "route", "path", "sidewalk", "pavement", "runway", "bridge", "viaduct", "crosswalk", "street"],
    "vegetation": ["forest", "agriculture", "agricultural", "farmland", "woodland", "tree", "grass", "plant", "flora", "flower", "field", "palm", "bush", "hedge", "shrub"],
    "bare_soil": ["barren", "bare", "bare land", "barren land", "earth", "ground", "sand", "dirt track", "land", "soil", "hill", "mountain", "mount", "rock", "stone", "gravel"],
    "water": ["water", "sea", "river", "lake", "pool", "swimming pool", "waterfall", "falls", "pond"],
}


def normalise_label(label: Column) -> Column:
    """The words of a compound label: cut at `;`, `,` and `/`, trimmed, lower case, blanks left out."""
    return F.array_distinct(F.filter(F.transform(F.split(label, "[;,/]"), lambda x: F.lower(F.trim(x))), lambda x: x != ""))


def class_mapping(labels: DataFrame, classes: list[str], groups: dict[str, list[str]] | None = None) -> DataFrame:
    """labels(source_id, label) with the class_id of the first project class, by number, that one of the label's words
    belongs to; 0 if none does."""
    known = [(w.lower(), classes.index(name)) for name, words in (groups or LABEL_GROUPS).items() if name in classes for w in words]
    to = F.create_map(*[F.lit(v) for pair in known for v in pair]) if known else F.create_map().cast("map<string,int>")
    hits = F.filter(F.transform(normalise_label(F.col("label")), lambda w: F.try_element_at(to, w)), lambda v: v.isNotNull())
    return labels.withColumn("class_id", F.coalesce(F.array_min(hits), F.lit(0)))


def mapping_summary(mapped: DataFrame, classes: list[str]) -> DataFrame:
    """class_id, class_name and the labels mapped to each project class, none too."""
    dim = mapped.sparkSession.range(len(classes)).select(F.col("id").cast("int").alias("class_id"), F.element_at(F.array(*map(F.lit, classes)), (F.col("id") + 1).cast("int")).alias("class_name"))
    got = mapped.groupBy("class_id").agg(F.sort_array(F.collect_list("label")).alias("labels"))
    return dim.join(got, "class_id", "left").withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


def sample_batches(points: DataFrame, tile: list[str], order: str = "draw", features: str = "features") -> DataFrame:
    """The feature rows of each tile in the order of their draw, as one array; a tile has a fixed number of them."""
    rows = F.sort_array(F.collect_list(F.struct(order, features)))
    return points.groupBy(*tile).agg(F.transform(rows, lambda r: r[features]).alias("batch"))
