"""Readers of elevation tiles, XYZ grids and map elements, as relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stats import finite
from ..settings import UnsupportedError

#: Stretches of an axis in which its distinct coordinates are put in order.
STRETCHES = 4096

#: Tags by which a closed way is an area, and tags that become columns.
AREA_KEYS = ["building", "landuse", "leisure", "natural", "amenity", "area"]
PROMOTED = ["name", "building", "building:levels", "height", "highway", "surface", "landuse", "leisure", "natural", "waterway", "railway", "amenity"]
NODES = "array<struct<lon: double, lat: double>>"
MEMBERS = f"array<struct<role: string, geometry: {NODES}>>"
ELEMENTS = f"struct<elements: array<struct<type: string, id: bigint, tags: map<string, string>, geometry: {NODES}, members: {MEMBERS}>>>"
TILE = 256


def elevation_tile(lines: DataFrame, text: str = "value", line_no: str = "line_no", nodata: str = "e", size: int | None = None) -> DataFrame:
    """row, col, z of a tile given as numbered comma-separated lines; the token, and NaN, are null.

    With a size, a line of another number of values, or beyond that many lines, is an error when it is read."""
    row, parts = F.col(line_no).cast("int"), F.split(text, ",")
    if size is not None:
        fits = (F.size(parts) == size) & row.between(0, size - 1)
        said = F.concat(F.lit("a tile is not "), F.lit(f"{size} x {size}"), F.lit(": line "), row.cast("string"), F.lit(" has "), F.size(parts).cast("string"), F.lit(" values"))
        parts = F.when(fits, parts).otherwise(F.raise_error(said).cast("array<string>"))
    t = lines.select(row.alias("row"), F.posexplode(parts).alias("col", "_v"))
    return t.select("row", "col", finite(F.when(F.trim("_v") != nodata, F.expr("try_cast(trim(_v) AS float)"))).alias("z"))


def standard_tile(lines: DataFrame, text: str = "value", line_no: str = "line_no", nodata: str = "e") -> DataFrame:
    """An elevation tile of the usual TILE x TILE values; any other shape is an error."""
    return elevation_tile(lines, text, line_no, nodata, TILE)


def xyz_points(lines: DataFrame, text: str = "value") -> DataFrame:
    """x, y, z of text lines; `#` starts a comment, white space or commas divide."""
    v = F.split(F.trim(text), r"[,\s]+")
    part = lambda i: F.try_element_at(v, F.lit(i)).try_cast("double")
    t = lines.filter(~F.trim(text).startswith("#") & (F.trim(text) != ""))
    return t.select(part(1).alias("x"), part(2).alias("y"), finite(part(3)).alias("z")).filter("x IS NOT NULL AND y IS NOT NULL")


def xyz_grid(points: DataFrame, order: str) -> DataFrame:
    """row, col, z on the grid of least spacing; the last point in `order` wins a cell. Without two different
    coordinates on some axis there is no spacing, which is an error when the grid is read."""
    def step(c: str) -> DataFrame:
        # neighbours are sought among the distinct coordinates of a stretch; the first of each stretch also stands,
        # as its end, in the one before
        d = points.select(F.round(c, 6).alias(c)).distinct().withColumn("_one", F.lit(1))
        ends = d.groupBy("_one").agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
        d = d.join(F.broadcast(ends), "_one").withColumn("s", F.floor(F.coalesce(F.try_divide((F.col(c) - F.col("lo")) * STRETCHES, F.col("hi") - F.col("lo")), F.lit(0.0))))
        inner = d.select(c, "s", (F.col(c) - F.lag(c).over(Window.partitionBy("s").orderBy(c))).alias("d")).agg(F.min("d").alias("d"))
        edge = d.groupBy("s").agg(F.min(c).alias("a"), F.max(c).alias("b"))
        outer = edge.select((F.col("a") - F.lag("b").over(Window.orderBy("s"))).alias("d")).agg(F.min("d").alias("d"))
        return inner.union(outer).agg(F.min("d").alias(f"d{c}"))

    ext = points.agg(F.min("x").alias("x0"), F.max("y").alias("y1")).withColumn("_one", F.lit(1))
    s = step("x").withColumn("_one", F.lit(1)).join(step("y").withColumn("_one", F.lit(1)), "_one").withColumn("s", F.least("dx", "dy"))
    s = s.withColumn("s", F.coalesce("s", F.raise_error(F.lit("a grid needs points at two different coordinates")).cast("double")))
    t = points.withColumn("_one", F.lit(1)).join(F.broadcast(ext.join(s, "_one")), "_one")
    t = t.select(F.rint((F.col("y1") - F.col("y")) / F.col("s")).cast("int").alias("row"), F.rint((F.col("x") - F.col("x0")) / F.col("s")).cast("int").alias("col"), "z", order)
    return t.groupBy("row", "col").agg(F.max_by("z", order).alias("z"))


def is_area(tags: Column, closed: Column) -> Column:
    has = F.exists(F.array(*map(F.lit, AREA_KEYS)), lambda k: F.map_contains_key(tags, k))
    return closed & has & (F.coalesce(F.try_element_at(tags, F.lit("area")), F.lit("")) != "no")


def way_kind(geometry: Column, tags: Column) -> Column:
    """polygon, line or null, by whether the nodes close and the tags make an area."""
    closed = (F.size(geometry) >= 4) & (F.try_element_at(geometry, F.lit(1)) == F.try_element_at(geometry, F.lit(-1)))
    return F.when(F.size(geometry) >= 2, F.when(is_area(tags, closed), "polygon").otherwise("line"))


def map_elements(payloads: DataFrame, text: str = "value") -> DataFrame:
    """osm_id, osm_type, kind, rings (arrays of nodes), a column for each promoted tag, and tags, of the ways and
    relations in JSON payloads. A relation is the polygons of its outer members that close by themselves; members that
    only close together are left out, as are nodes and elements without a geometry."""
    t = payloads.select(F.explode(F.from_json(text, ELEMENTS)["elements"]).alias("e")).select("e.*").filter("type IN ('way', 'relation')")
    tags = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    way = way_kind(F.col("geometry"), tags)
    closed = lambda g: (F.size(g) >= 4) & (F.try_element_at(g, F.lit(1)) == F.try_element_at(g, F.lit(-1)))
    outer = F.filter("members", lambda m: F.coalesce(m["role"], F.lit("")).isin("outer", "") & closed(m["geometry"]))
    rings = F.when(F.col("type") == "way", F.array("geometry")).otherwise(F.transform(outer, lambda m: m["geometry"]))
    kind = F.when(F.col("type") == "way", way).when(F.size(outer) > 0, "polygon")
    t = t.select("*", rings.alias("rings"), kind.alias("kind")).filter("kind IS NOT NULL")
    promoted = [F.try_element_at(tags, F.lit(k)).alias(k.replace(":", "_")) for k in PROMOTED]
    return t.select(F.concat_ws("/", "type", "id").alias("osm_id"), F.col("type").alias("osm_type"), "kind", "rings", *promoted, F.to_json(tags).alias("tags"))


#: What each layer asks the map service for.
LAYERS = {
    "building": ['way["building"]', 'relation["building"]'],
    "road": ['way["highway"]'],
    "water": ['way["natural"="water"]', 'way["waterway"]', 'relation["natural"="water"]'],
    "landuse": ['way["landuse"]', 'way["leisure"]', 'relation["landuse"]'],
    "railway": ['way["railway"]'],
}


def layer_request(layer: str, bounds: tuple[float, float, float, float], timeout_s: float) -> str:
    """The request for a layer inside (west, south, east, north)."""
    if layer not in LAYERS:
        raise UnsupportedError(f"no request is known for layer {layer!r}, only for {', '.join(sorted(LAYERS))}")
    west, south, east, north = bounds
    parts = "\n".join(f"{x}({south},{west},{north},{east});" for x in LAYERS[layer])
    return f"[out:json][timeout:{int(timeout_s)}];\n({parts}\n);\nout geom;"


def building_height(height: Column, levels: Column, level_m: float = 3.0) -> tuple[Column, Column]:
    """Height and where it is from: the first run of digits of `height`, else of `levels` times a storey."""
    number = lambda c: F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    h, n = number(height), number(levels)
    return F.coalesce(h, n * level_m), F.when(h.isNotNull(), "height").when(n.isNotNull(), "levels")


def json_reply(text: Column) -> Column:
    """The JSON object of a model's reply: thoughts dropped, a fenced block first, else from the first { to the last }; null if none."""
    bare = F.regexp_replace(text, r"(?s)<think>.*?</think>", "")
    # the first block of a fence that begins and ends as an object
    fenced = F.regexp_extract(bare, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    loose = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    body = F.when(fenced != "", fenced).otherwise(loose)
    return F.when(F.try_parse_json(body).isNotNull(), body)


def reply_status(text: Column) -> Column:
    """ok, or why json_reply gives nothing: empty, no object, or unparsed."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?s)<think>.*?</think>", ""))
    return F.when(json_reply(text).isNotNull(), "ok").when(bare == "", "empty").when(~bare.rlike(r"(?s)\{.*\}"), "no object").otherwise("unparsed")


def as_list(value: Column) -> Column:
    """An array of strings from a JSON value: null gives none, a scalar one, an array its elements; blanks are left out."""
    v = F.try_parse_json(value)
    # what isn't JSON is a plain string
    many = F.coalesce(F.from_json(value, "array<string>"), F.array(value))
    one = F.when(F.trim(value).startswith('"'), F.array(F.try_variant_get(v, "$", "string"))).otherwise(F.array(value))
    got = F.when(value.isNull() | (F.trim(value) == "null"), F.array().cast("array<string>")).when(F.trim(value).startswith("["), many).otherwise(one)
    return F.filter(got, lambda x: x.isNotNull() & (F.trim(x) != ""))


def fill_missing(primary: DataFrame, fallbacks: list[DataFrame], value: str = "z") -> DataFrame:
    """primary(row, col, value) with each fallback in turn filling the cells still missing; `source` is the number of the dataset, null where none has a value."""
    t = primary.withColumn(value, finite(F.col(value))).withColumn("source", F.when(F.col(value).isNotNull(), 0))
    for n, more in enumerate(fallbacks, 1):
        # a fallback that has a cell twice counts once, by its smallest value
        more = more.groupBy("row", "col").agg(F.min(finite(F.col(value))).alias("_v"))
        t = t.join(more, ["row", "col"], "left")
        t = t.withColumn("source", F.coalesce("source", F.when(F.col("_v").isNotNull(), n))).withColumn(value, F.coalesce(value, "_v")).drop("_v")
    return t


def mosaic(tiles: DataFrame, x_min: int, y_min: int, size: int = 256) -> DataFrame:
    """Pixels (tile_x, tile_y, row, col, z) placed on the mosaic's rows and columns; absent tiles have no rows."""
    return tiles.select(((F.col("tile_y") - y_min) * size + F.col("row")).cast("int").alias("row"), ((F.col("tile_x") - x_min) * size + F.col("col")).cast("int").alias("col"), "z")
