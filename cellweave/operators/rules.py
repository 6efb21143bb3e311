"""Fusion rules: a first-match cascade that names the class, the rule and the count key of every cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import finite

#: Classes, thresholds and image vocabulary.
FUSED = {0: "unknown", 1: "building", 2: "road", 3: "tall_vegetation", 4: "low_vegetation", 5: "bare_soil", 6: "water", 7: "other"}
IMAGE = {"unknown": 0, "building": 1, "road": 2, "vegetation": 3, "water": 4, "bare_soil": 5}
CONFIDENT, BUILDING_M, TALL_M, ROAD_M = 0.35, 2.5, 3.0, 1.0


def plan(has_height: bool = True, has_gis: bool = True, vocabulary: dict[str, int] | None = None) -> list[tuple[Column, int, int, str]]:
    """(predicate, fused class, rule, count key) in order; what a missing modality or class rules out is left out."""
    names = IMAGE if vocabulary is None else vocabulary
    conf = F.col("image_confidence") >= F.lit(CONFIDENT).cast("float")
    seen = lambda name: (F.col("image_class") == names[name]) & conf if name in names else F.lit(False)
    gis = lambda c: F.coalesce(F.col(c), F.lit(False))
    h = finite(F.col("object_height"))  # NaN is no height; Spark would order it above all others
    known = h.isNotNull()
    out = [(seen("water"), 6, 1, "image_water")]
    if has_gis:
        out.append((gis("in_water"), 6, 1, "gis_water"))
    if has_height:
        out.append((seen("building") & known & (h >= BUILDING_M), 1, 2, "image_building_tall"))
    out.append((seen("building") & ~known if has_height else seen("building"), 1, 3, "image_building_no_height"))
    if has_gis:
        out.append((gis("in_building"), 1, 4, "gis_building"))
    if has_height:
        out.append((seen("vegetation") & known & (h >= TALL_M), 3, 5, "image_vegetation_tall"))
        out.append((seen("vegetation") & known, 4, 6, "image_vegetation_low"))
    out.append((seen("vegetation"), 4, 7, "image_vegetation_no_height"))
    if has_height:
        out.append((seen("road") & known & (h <= ROAD_M), 2, 8, "image_road_low"))
    out.append((seen("road") & ~known if has_height else seen("road"), 2, 9, "image_road_no_height"))
    if has_gis:
        out.append((gis("on_road"), 2, 10, "gis_road"))
    out.append((seen("bare_soil"), 5, 11, "image_bare_soil"))
    out.append((F.col("image_confidence") > 0, 7, 12, "image_other_low_confidence"))
    return out


#: What a pass without heights leaves out.
SKIPPED = ["image_building_tall: no object height", "image_vegetation_tall: no object height", "image_road_low: no object height"]


def skipped(has_height: bool = True) -> list[str]:
    """The conditions that a plan leaves out, and why, for the run's record."""
    return [] if has_height else list(SKIPPED)


def fused(rules: list[tuple[Column, int, int, str]]) -> Column:
    """struct<fused_class, rule, count_key> of the first rule that holds."""
    made = lambda c, r, k: F.struct(F.lit(c).cast("short").alias("fused_class"), F.lit(r).cast("short").alias("rule"), F.lit(k).alias("count_key"))
    out = made(0, 0, "unassigned")
    for when, c, r, k in reversed(rules):
        out = F.when(when, made(c, r, k)).otherwise(out)
    return out
