"""Queries of the terrain stage, mosaics, windows, clipping, order and display."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import display, rasters
from ..sources import imagery
from . import fusion
from .queries import CELLS, ORACLE_SQL, SURFACE, W, cells, query, r6, read, with_surface

SIDE = 10
MOST_TILES = 1 << 24


@query(
    "ter_08_terrain_stage",
    f"""WITH a AS ({ORACLE_SQL["ter_01_03_slope_aspect"]}), b AS ({ORACLE_SQL["ter_05_hillshade"]}), c AS ({ORACLE_SQL["ter_04_relief"]}),
{SURFACE}, n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT row, col, slope, aspect, shade AS hillshade, relief, CASE WHEN dsm IS NOT NULL THEN round(least(greatest(dsm - z, 0), 10), 6) END AS ndsm,
 coalesce(n, 0) AS n_points FROM surface JOIN a USING (row, col) JOIN b USING (row, col) JOIN c USING (row, col) LEFT JOIN n ON l_orderkey = o_orderkey""",
)
def ter_08(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("l_orderkey")
    counts = read(spark, d, "lineitem").groupBy(F.expr(f"cast(l_orderkey div {W} as int)").alias("row"), (key % W).cast("int").alias("col")).agg(F.count("*").alias("n_points"))
    t = fusion.terrain_layers(with_surface(spark, d), 5.0, dsm="dsm", counts=counts, tallest=10.0)
    return t.select("row", "col", r6(F.col("slope"), "slope"), r6(F.col("aspect"), "aspect"), F.round("hillshade", 4).alias("hillshade"), r6(F.col("relief"), "relief"), r6(F.col("ndsm"), "ndsm"), "n_points")


def tiles(spark: SparkSession, d: str) -> tuple[DataFrame, tuple[int, int, int, int]]:
    """Cells as tiles of SIDE x SIDE, every fourth one absent, and the range of all."""
    rows = int(read(spark, d, "orders").agg(F.max("o_orderkey")).first()[0]) // W + 1
    place = [F.expr(f"{c} div {SIDE}").cast("int").alias(f"tile_{a}") for a, c in (("x", "col"), ("y", "row"))]
    t = cells(spark, d).select(*place, (F.col("row") % SIDE).alias("row"), (F.col("col") % SIDE).alias("col"), "z")
    return t.filter((F.col("tile_x") + F.col("tile_y")) % 4 != 0), (0, 0, W // SIDE - 1, (rows - 1) // SIDE)


TILES = f"""{CELLS}, p AS (SELECT *, col // {SIDE} AS tx, row // {SIDE} AS ty FROM cells WHERE (col // {SIDE} + row // {SIDE}) % 4 <> 0),
every AS (SELECT x AS tx, y AS ty FROM range({W // SIDE}) a(x), (SELECT unnest(range((SELECT max(row) // {SIDE} + 1 FROM cells))) AS y))"""


@query(
    "src_02_mosaic",
    f"""WITH {TILES}, gone AS (SELECT * FROM every EXCEPT SELECT tx, ty FROM p)
SELECT row, col, round(z, 6) AS z, true AS valid FROM p
UNION ALL SELECT (ty * {SIDE} + r)::INT, (tx * {SIDE} + c)::INT, NULL, false FROM gone, range({SIDE}) a(r), range({SIDE}) b(c)""",
)
def src_02(spark: SparkSession, d: str) -> DataFrame:
    t, box = tiles(spark, d)
    return imagery.whole_mosaic(t, box, MOST_TILES, size=SIDE).withColumn("z", F.round("z", 6))


@query("src_02_tile_counts", f"WITH {TILES} SELECT (SELECT count(*) FROM every) AS tiles_requested, (SELECT count(*) FROM (SELECT DISTINCT tx, ty FROM p)) AS tiles_returned")
def src_02_counts(spark: SparkSession, d: str) -> DataFrame:
    return imagery.mosaic_counts(*tiles(spark, d), MOST_TILES)


@query(
    "join_05_window",
    f"""WITH {CELLS}, k AS (SELECT floor(40 - (5 + p_partkey % 20 + 0.25))::INT AS r, floor(3 + p_size / 4.0)::INT AS c FROM part),
w AS (SELECT greatest(min(r) - 2, 0) AS r0, least(max(r) + 3, 40) AS r1, greatest(min(c) - 2, 0) AS c0, least(max(c) + 3, {W}) AS c1 FROM k)
SELECT row, col, round(z, 6) AS z FROM cells, w WHERE row >= r0 AND row < r1 AND col >= c0 AND col < c1""",
)
def join_05(spark: SparkSession, d: str) -> DataFrame:
    points = read(spark, d, "part").select((3 + F.col("p_size") / 4.0).alias("x"), (5 + F.col("p_partkey") % 20 + 0.25).alias("y"))
    window = rasters.point_window(points, geo.Grid(0, 0, W, 40, 1), 2)
    return rasters.in_window(cells(spark, d), window).select("row", "col", r6(F.col("z"), "z"))


CLIP = (10.5, 10.25, 30.5, 30.75)
SHAPES = "s AS (SELECT p_partkey, p_partkey % 46 AS x0, p_size AS y0 FROM part)"


def node(x, y):
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


@query(
    "join_09_clip_areas",
    f"""WITH {SHAPES}, a AS (SELECT p_partkey, (least(x0 + 3, {CLIP[2]}) - greatest(x0, {CLIP[0]})) AS w, (least(y0 + 4, {CLIP[3]}) - greatest(y0, {CLIP[1]})) AS h FROM s)
SELECT p_partkey, round((w * h)::DOUBLE, 6) AS area FROM a WHERE w > 0 AND h > 0""",
)
def join_09(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("p_partkey") % 46, F.col("p_size")
    ring = F.array(node(x, y), node(x + 3, y), node(x + 3, y + 4), node(x, y + 4), node(x, y))
    t = read(spark, d, "part").select("p_partkey", rasters.clip_ring(ring, CLIP).alias("ring")).filter(F.size("ring") > 0)
    turns = F.zip_with(F.col("ring"), F.slice("ring", 2, F.greatest(F.size("ring") - 1, F.lit(0))), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    area = rasters.once(turns, lambda v: F.abs(F.aggregate(v, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))) / 2)
    return t.select("p_partkey", F.round(area, 6).alias("area")).filter("area > 0")


@query(
    "join_09_clip_lines",
    f"""WITH {SHAPES}, t AS (SELECT p_partkey, greatest(0, ({CLIP[0]} - x0) / 3.0, ({CLIP[1]} - y0) / 4.0) AS t0, least(1, ({CLIP[2]} - x0) / 3.0, ({CLIP[3]} - y0) / 4.0) AS t1 FROM s)
SELECT p_partkey, round((5 * (t1 - t0))::DOUBLE, 6) AS length FROM t WHERE t0 < t1""",
)
def join_09_lines(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("p_partkey") % 46, F.col("p_size")
    line = F.array(node(x, y), node(x + 1.5, y + 2), node(x + 3, y + 4))
    t = read(spark, d, "part").select("p_partkey", imagery.clip_line(line, CLIP).alias("parts")).filter(F.size("parts") > 0)
    step = lambda p: F.hypot(p[1]["x"] - p[0]["x"], p[1]["y"] - p[0]["y"])
    return t.select("p_partkey", F.round(F.aggregate("parts", F.lit(0.0), lambda s, p: s + step(p)), 6).alias("length"))


@query("srt_02_sorted_values", "SELECT DISTINCT p_brand FROM part ORDER BY 1")
def srt_02(spark: SparkSession, d: str) -> DataFrame:
    return display.sorted_values(read(spark, d, "part"), "p_brand")


FIRST = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("srt_03_first_features", f"SELECT l_returnflag, {', '.join(FIRST)} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY {', '.join(FIRST)}) <= 3000")
def srt_03(spark: SparkSession, d: str) -> DataFrame:
    return display.first_of_each(read(spark, d, "lineitem").select("l_returnflag", *FIRST), ["l_returnflag"], FIRST, 3000)


@query("ded_01_first_occurrences", "SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) = 1")
def ded_01(spark: SparkSession, d: str) -> DataFrame:
    return display.first_occurrences(read(spark, d, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber"])


CLOUD = "p AS (SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS x, l_quantity AS y, l_discount * 100 AS z FROM lineitem), o AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0 FROM p)"


@query(
    "viz_04_oblique",
    f"""WITH {CLOUD}, q AS (SELECT *, (x - x0) * sin(radians(45)) + (y - y0) * cos(radians(45)) AS depth FROM p, o)
SELECT l_orderkey, l_linenumber, round((x - x0) * cos(radians(45)) - (y - y0) * sin(radians(45)), 4) AS screen_x,
 round(depth * sin(radians(35)) + (z - z0) * cos(radians(35)), 4) AS screen_y, round(depth, 4) AS depth FROM q""",
)
def viz_04(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 1000).alias("x"), F.col("l_quantity").alias("y"), (F.col("l_discount") * 100).alias("z"))
    return display.oblique(p).select("l_orderkey", "l_linenumber", *[F.round(c, 4).alias(c) for c in ("screen_x", "screen_y", "depth")])


@query("viz_05_hex_colours", "SELECT l_orderkey, l_linenumber, printf('#%02x%02x%02x', (l_partkey % 256)::INT, (l_suppkey % 256)::INT, (l_orderkey % 256)::INT) AS colour FROM lineitem")
def viz_05(spark: SparkSession, d: str) -> DataFrame:
    bands = [F.col(c) % 256 for c in ("l_partkey", "l_suppkey", "l_orderkey")]
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", display.hex_colour(*bands).alias("colour"))


@query("agg_22_negative_share", f"WITH {SURFACE} SELECT round(avg((dsm - (z + 12.5) < -0.5)::INT), 6) AS negative_fraction FROM surface WHERE dsm IS NOT NULL")
def agg_22_share(spark: SparkSession, d: str) -> DataFrame:
    t = with_surface(spark, d).withColumn("z", F.col("z") + 12.5)
    return fusion.negative_fraction(t).select(r6(F.col("negative_fraction"), "negative_fraction"))
