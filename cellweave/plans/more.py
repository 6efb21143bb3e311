"""Further spatial queries over the generic tables: systems and tiles, regridding, the fusion frame, statistics, learning."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import contrast, learning, rasters, sampling, stats, terrain, validation
from ..operators.rasters import Raster
from ..sources import readers
from . import fusion
from .queries import CELLS, EVIDENCE, HORN, SURFACE, W, cells, evidence, fuse, query, r6, read, with_surface

PLACES = "p AS (SELECT c_custkey, 134.0 + (c_custkey % 200) / 100.0 AS lon, 33.5 + (c_custkey % 170) / 50.0 AS lat FROM customer)"
N = geo.GRS80_F / (2 - geo.GRS80_F)


def places(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, d, "customer").select("c_custkey", (134.0 + (k % 200) / 100.0).alias("lon"), (33.5 + (k % 170) / 50.0).alias("lat"))


def _tm_sql() -> str:
    """Krueger's series in SQL, with constants worked out here."""
    _, a, e = geo._krueger()
    al = [N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16, 13 * N**2 / 48 - 3 * N**3 / 5, 61 * N**3 / 240]
    lat0, lon0 = geo.ZONES["EPSG:6673"]
    origin = geo._origin(lat0, al, e)
    sinh, cosh, atanh = "((exp({0}) - exp(-({0}))) / 2)", "((exp({0}) + exp(-({0}))) / 2)", "(ln((1 + {0}) / (1 - {0})) / 2)"
    north = " + ".join(["xi", *[f"{c!r} * sin({2 * j} * xi) * " + cosh.format(f"{2 * j} * eta") for j, c in enumerate(al, 1)]])
    east = " + ".join(["eta", *[f"{c!r} * cos({2 * j} * xi) * " + sinh.format(f"{2 * j} * eta") for j, c in enumerate(al, 1)]])
    t = sinh.format("(" + atanh.format("s") + f" - {e!r} * " + atanh.format(f"({e!r} * s)") + ")")
    return f"""WITH {PLACES}, a AS (SELECT *, sin(radians(lat)) AS s, radians(lon - {lon0!r}) AS dl FROM p), b AS (SELECT *, {t} AS t FROM a),
c AS (SELECT *, atan2(t, cos(dl)) AS xi, {atanh.format("(sin(dl) / sqrt(1 + t * t))")} AS eta FROM b)
SELECT c_custkey, round(({east}) * {a * 0.9999!r}, 3) AS x, round((({north}) - {origin!r}) * {a * 0.9999!r}, 3) AS y FROM c"""


@query("crs_02_plane", _tm_sql())
def crs_02_plane(spark: SparkSession, d: str) -> DataFrame:
    x, y = geo.transform(F.col("lon"), F.col("lat"), geo.GEOGRAPHIC, "EPSG:6673")
    return places(spark, d).select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("crs_03_round_trip", f"WITH {PLACES} SELECT c_custkey, round(lon, 7) AS lon, round(lat, 7) AS lat FROM p")
def crs_03(spark: SparkSession, d: str) -> DataFrame:
    t = geo.transform_points(places(spark, d), geo.GEOGRAPHIC, "EPSG:6673", "lon", "lat")
    t = geo.transform_points(t, "EPSG:6673", geo.MERCATOR, "lon", "lat")
    t = geo.transform_points(t, geo.MERCATOR, geo.GEOGRAPHIC, "lon", "lat")
    return t.select("c_custkey", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


_SPAN = 2 * geo.HALF_WORLD / 32768


@query("til_03_bounds", f"SELECT c_custkey, round(x / 32768 * 360 - 180, 6) AS lon, round(degrees(atan((exp(m) - exp(-m)) / 2)), 6) AS lat, round(x * {_SPAN!r} - {geo.HALF_WORLD}, 3) AS west, round({geo.HALF_WORLD} - (y + 1) * {_SPAN!r}, 3) AS south FROM (SELECT c_custkey, x, y, pi() * (1 - 2 * y / 32768) AS m FROM (SELECT c_custkey, c_custkey % 32768 AS x, c_custkey * 7 % 32768 AS y FROM customer))")
def til_03(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 32768).alias("x"), (F.col("c_custkey") * 7 % 32768).alias("y"))
    lon, lat = geo.tile_to_lonlat(F.col("x"), F.col("y"), 15)
    west, south, _, _ = geo.tile_bounds_mercator(F.col("x"), F.col("y"), 15)
    return t.select("c_custkey", r6(lon, "lon"), r6(lat, "lat"), F.round(west, 3).alias("west"), F.round(south, 3).alias("south"))


@query("til_07_08_tiles", f"WITH {CELLS} SELECT row // 7 AS tile_row, col // 9 AS tile_col, count(*) AS n FROM cells GROUP BY ALL")
def til_07(spark: SparkSession, d: str) -> DataFrame:
    # rows count from the south here, so a cell's row is its y
    grid = geo.Grid(0, 0, W, 1 << 20, 1.0)
    row, col = grid.tile_key(F.col("row") + 0.5, F.col("row") + 0.5, 7)[0], grid.tile_key(F.col("col") + 0.5, F.lit(0), 9)[1]
    return cells(spark, d).groupBy(row.cast("long").alias("tile_row"), col.cast("long").alias("tile_col")).agg(F.count("*").alias("n"))


# rasters of which cells are absent, NaN or null
HOLES = f"{CELLS}, holed AS (SELECT row, col, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE z END AS z FROM cells WHERE o_orderkey % 11 > 0)"


def holed(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    t = cells(spark, d, "o_orderkey").filter(k % 11 > 0)
    return t.select("row", "col", F.when(k % 26 == 0, F.lit(float("nan"))).when(k % 13 > 0, F.col("z")).alias("z"))


@query("agg_01_05_holes", f"WITH {HOLES} SELECT count(z) AS count, round(avg(z), 6) AS mean, round(quantile_cont(z, 0.5), 6) AS p50, round(quantile_cont(z, 0.95), 6) AS p95, round(count(z) / count(*), 6) AS coverage FROM holed")
def agg_01_holes(spark: SparkSession, d: str) -> DataFrame:
    t = holed(spark, d)
    both = stats.beside(stats.summary(t, F.col("z")), t.agg(stats.coverage(F.col("z")).alias("coverage")))
    return both.select("count", *[r6(F.col(c), c) for c in ("mean", "p50", "p95", "coverage")])


@query("ter_01_holes", f"WITH {HOLES}, m AS (SELECT (max(o_orderkey) // {W})::INT AS mr, {W - 1} AS mc FROM orders), n AS (SELECT a.row, a.col, dr, dc, b.z AS v FROM holed a, (SELECT unnest([-1,0,1]) AS dr), (SELECT unnest([-1,0,1]) AS dc), m LEFT JOIN holed b ON b.row = least(greatest(a.row + dr, 0), mr) AND b.col = least(greatest(a.col + dc, 0), mc)), g AS (SELECT row, col, sum(v * dc * (CASE WHEN dr = 0 THEN 2 ELSE 1 END)) / 40 AS dx, sum(v * dr * (CASE WHEN dc = 0 THEN 2 ELSE 1 END)) / 40 AS dy FROM n GROUP BY row, col HAVING count(v) = 9) SELECT row, col, round(dx + 1e-9, 4) AS dz_dx, round(dy + 1e-9, 4) AS dz_dy FROM g")
def ter_01_holes(spark: SparkSession, d: str) -> DataFrame:
    rows = int(read(spark, d, "orders").agg(F.max("o_orderkey")).first()[0]) // W + 1
    t = terrain.gradients(holed(spark, d), 5.0, shape=(rows, W)).filter("dz_dx IS NOT NULL AND dz_dy IS NOT NULL AND z IS NOT NULL AND NOT isnan(z)")
    return t.select("row", "col", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("dz_dx", "dz_dy")])


@query("agg_03_sectors", f"WITH {HORN}, a AS (SELECT (degrees(atan2(-dx, dy)) + 360) % 360 AS a FROM g WHERE sqrt(dx * dx + dy * dy) >= 1e-4 AND col < 3 AND row < 2), k AS (SELECT floor(((a + 22.5) % 360) / 45)::INT AS sector, count(*) AS n FROM a GROUP BY 1), d(sector, name) AS (VALUES (0, 'N'), (1, 'NE'), (2, 'E'), (3, 'SE'), (4, 'S'), (5, 'SW'), (6, 'W'), (7, 'NW')) SELECT sector, name, coalesce(n, 0) AS n, round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (), 6) AS fraction FROM d LEFT JOIN k USING (sector)")
def agg_03(spark: SparkSession, d: str) -> DataFrame:
    t = terrain.gradients(cells(spark, d), 5.0).filter("col < 3 AND row < 2")
    return stats.aspect_distribution(t, terrain.aspect_deg(F.col("dz_dx"), F.col("dz_dy"))).withColumn("fraction", F.round("fraction", 6))


@query("ras_01_regrid", f"WITH {CELLS}, s AS (SELECT row, col, z FROM cells WHERE row < 20), g AS (SELECT r::INT AS row, c::INT AS col FROM range(6) a(r), range(17) b(c)), k AS (SELECT floor((row + 0.5) / 3)::INT AS row, floor((col + 0.5) / 3)::INT AS col, avg(z) AS average, min(z) AS low, max(z) AS high FROM s GROUP BY ALL), n AS (SELECT g.row, g.col, s.z AS nearest FROM g LEFT JOIN s ON s.row = floor(g.row * 3 + 1.5)::INT AND s.col = floor(g.col * 3 + 1.5)::INT) SELECT g.row, g.col, round(nearest, 6) AS nearest, round(average, 6) AS average, round(low, 6) AS low, round(high, 6) AS high FROM g LEFT JOIN n USING (row, col) LEFT JOIN k USING (row, col)")
def ras_01(spark: SparkSession, d: str) -> DataFrame:
    source = Raster(cells(spark, d).filter("row < 20").select("row", "col", "z"), geo.Grid(0, 0, W, 20, 1.0))
    target = geo.Grid(0, 2, 51, 20, 3.0)
    out = rasters.regrid(source, target, "z").withColumnRenamed("z", "nearest")
    for name, method in (("average", "average"), ("low", "min"), ("high", "max")):
        out = out.join(rasters.regrid(source, target, "z", method).withColumnRenamed("z", name), ["row", "col"])
    return out.select("row", "col", *[r6(F.col(c), c) for c in ("nearest", "average", "low", "high")])


@query("ras_01_bilinear", f"WITH {CELLS}, s AS (SELECT row, col, z FROM cells WHERE row < 20), g AS (SELECT r::INT AS row, c::INT AS col, (r + 0.5) * 0.5 - 0.5 AS fr, (c + 0.5) * 0.5 - 0.5 AS fc FROM range(40) a(r), range(100) b(c)), q AS (SELECT g.row, g.col, z, (CASE WHEN dr = 0 THEN 1 - (fr - floor(fr)) ELSE fr - floor(fr) END) * (CASE WHEN dc = 0 THEN 1 - (fc - floor(fc)) ELSE fc - floor(fc) END) AS w FROM g, (SELECT unnest([0, 1]) AS dr), (SELECT unnest([0, 1]) AS dc) JOIN s ON s.row = floor(fr) + dr AND s.col = floor(fc) + dc) SELECT row, col, round(sum(w * z) / sum(w) + 1e-9, 4) AS z FROM q GROUP BY ALL")
def ras_01_bilinear(spark: SparkSession, d: str) -> DataFrame:
    source = Raster(cells(spark, d).filter("row < 20").select("row", "col", "z"), geo.Grid(0, 0, W, 20, 1.0))
    return rasters.regrid(source, geo.Grid(0, 0, W, 20, 0.5), "z", "bilinear").withColumn("z", F.round(F.col("z") + 1e-9, 4))


@query("join_01_mask", f"WITH {CELLS}, p AS (SELECT c_custkey, c_custkey % 80 - 10.5 AS x, c_custkey % 60 - 20.5 AS y FROM customer) SELECT c_custkey, row, col, o_orderkey % 3 = 0 AS mask FROM p JOIN cells ON row = least(greatest(floor(20 - y)::INT, 0), 19) AND col = least(greatest(floor(x)::INT, 0), {W - 1})")
def join_01(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    p = read(spark, d, "customer").select("c_custkey", (k % 80 - 10.5).alias("x"), (k % 60 - 20.5).alias("y"))
    mask = cells(spark, d, "o_orderkey").filter("row < 20").withColumn("mask", F.struct("row", "col", (F.col("o_orderkey") % 3 == 0).alias("mask")))
    return rasters.mask_values(p, mask.select("row", "col", "mask"), geo.Grid(0, 0, W, 20, 1.0), "mask", F.col("x"), F.col("y")).select("c_custkey", "mask.*")


_RELIEF = "hi AS (SELECT row, col, z, max(z) OVER w AS hi, min(z) OVER w AS lo FROM cells WINDOW w AS (PARTITION BY row ORDER BY col RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)), rel AS (SELECT row, col, max(hi) OVER w - min(lo) OVER w AS relief FROM hi WINDOW w AS (PARTITION BY col ORDER BY row RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING))"
_HEIGHTS = "bh AS (SELECT row, col, arg_max(p_retailprice, p_partkey) AS height FROM cells JOIN (SELECT p_partkey, p_partkey % 50 - 0.4 AS x0, p_partkey % 50 + 1.7 AS x1, p_size - 0.4 AS y0, p_size + 1.7 AS y1, p_retailprice FROM part) b ON col + 0.5 > x0 AND col + 0.5 < x1 AND row + 0.5 > y0 AND row + 0.5 < y1 GROUP BY ALL)"
_CASE = " ".join([
    "WHEN ic = 4 AND k THEN '6|1'", "WHEN w THEN '6|1'", "WHEN ic = 1 AND k AND h >= 2.5 THEN '1|2'", "WHEN ic = 1 AND k AND h IS NULL THEN '1|3'", "WHEN b THEN '1|4'",
    "WHEN ic = 3 AND k AND h >= 3.0 THEN '3|5'", "WHEN ic = 3 AND k AND h IS NOT NULL THEN '4|6'", "WHEN ic = 3 AND k THEN '4|7'", "WHEN ic = 2 AND k AND h <= 1.0 THEN '2|8'",
    "WHEN ic = 2 AND k AND h IS NULL THEN '2|9'", "WHEN r THEN '2|10'", "WHEN ic = 5 AND k THEN '5|11'", "WHEN conf > 0 THEN '7|12'",
])
_MAX_Y = 1 << 20
FRAME = f"""WITH {EVIDENCE}{HORN[len(CELLS):]}, {_RELIEF}, {_HEIGHTS},
f AS (SELECT e.*, CASE {_CASE} ELSE '0|0' END AS told FROM (SELECT *, conf >= 0.35::FLOAT AS k FROM evidence) e)
SELECT (f.col + 0.5)::DOUBLE AS x, ({_MAX_Y} - f.row - 0.5)::DOUBLE AS y, round(f.z::FLOAT::DOUBLE, 2) AS z, least(o.o_custkey % 300, 255)::INT AS red, (CASE WHEN o.o_orderkey % 7 = 0 THEN 0 ELSE o.o_orderkey % 200 END)::INT AS green, 7 AS blue,
 round(f.z::FLOAT::DOUBLE, 2) AS elevation, round(f.h::FLOAT::DOUBLE, 2) AS object_height, round(degrees(atan(sqrt(g.dx * g.dx + g.dy * g.dy)))::FLOAT::DOUBLE, 2) AS slope, CASE WHEN sqrt(g.dx * g.dx + g.dy * g.dy) >= 1e-4 THEN round(((degrees(atan2(-g.dx, g.dy)) + 360) % 360)::FLOAT::DOUBLE, 1) END AS aspect, round(rel.relief::FLOAT::DOUBLE, 2) AS relief,
 f.ic::INT AS image_class, round(f.conf::DOUBLE, 4) AS image_confidence, f.b AS in_building, f.r AS on_road, f.w AS in_water, round(bh.height::FLOAT::DOUBLE, 1) AS building_height_osm, split_part(told, '|', 1)::INT AS fused_class, split_part(told, '|', 2)::INT AS rule
FROM f JOIN g USING (row, col) JOIN rel USING (row, col) JOIN cells o USING (row, col) LEFT JOIN bh USING (row, col)"""


def scene(spark: SparkSession, d: str) -> fusion.Scene:
    grid = geo.Grid(0, 0, W, _MAX_Y, 1.0)
    t = cells(spark, d, "o_custkey", "o_orderkey")
    k = F.col("o_orderkey")
    dem = Raster(t.select("row", "col", "z"), grid)
    colours = t.select("row", "col", (F.col("o_custkey") % 300 + 0.2).alias("red"), F.when(k % 7 > 0, (k % 200).cast("double")).otherwise(float("nan")).alias("green"), F.lit(7.0).alias("blue"))
    g = terrain.relief(terrain.gradients(t.select("row", "col", "z"), 5.0))
    dx, dy = F.col("dz_dx"), F.col("dz_dy")
    relief = g.select("row", "col", terrain.slope_deg(dx, dy).alias("slope"), terrain.aspect_deg(dx, dy).alias("aspect"), "relief")
    seen = evidence(spark, d).drop("z")
    boxes = read(spark, d, "part").select(*[F.expr(x) for x in ("p_partkey % 50 - 0.4D AS min_x", "p_partkey % 50 + 1.7D AS max_x", "p_size - 0.4D AS min_y", "p_size + 1.7D AS max_y", "p_retailprice AS height", "p_partkey AS seq")])
    heights = sampling.rasterize_boxes(t, boxes, 8, F.col("col") + 0.5, F.col("row") + 0.5)
    known = {"colours": Raster(colours, grid), "slope": Raster(relief, grid), "object_height": Raster(seen, grid)}
    return fusion.Scene(dem, known, building_heights=heights)


@query("prj_02_fusion_frame", FRAME)
def prj_02(spark: SparkSession, d: str) -> DataFrame:
    t = fusion.frame(scene(spark, d))
    digits = {"z": 2, "elevation": 2, "object_height": 2, "slope": 2, "aspect": 1, "relief": 2, "image_confidence": 4, "building_height_osm": 1}
    told = {c: F.round(F.col(c).cast("double"), digits[c]) for c in digits}
    return t.select(*fusion.COLUMNS).withColumns(told | {c: F.col(c).cast("int") for c in ("red", "green", "blue", "image_class", "fused_class", "rule")})


@query("agg_04_terrain_summary", f"WITH {HORN}, s AS (SELECT z, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope FROM g WHERE col < 25) SELECT count(*) AS cells, count(*) * 25.0 AS area_m2, round(avg(z) + 1e-9, 4) AS z_mean, round(quantile_cont(z, 0.95) + 1e-9, 4) AS z_p95, round(avg(slope) + 1e-9, 4) AS slope_mean, round(quantile_cont(slope, 0.5) + 1e-9, 4) AS slope_p50 FROM s")
def agg_04(spark: SparkSession, d: str) -> DataFrame:
    t = terrain.gradients(cells(spark, d), 5.0).select("row", "col", "z", terrain.slope_deg(F.col("dz_dx"), F.col("dz_dy")).alias("slope"))
    s = fusion.terrain_summary(t, 5.0, F.col("col") < 25)
    return s.select("cells", F.col("area_m2").cast("double").alias("area_m2"), *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("z_mean", "z_p95", "slope_mean", "slope_p50")])


@query("agg_11_moments", f"WITH {SURFACE} SELECT 'z' AS name, count(z) AS count, round(avg(z), 3) AS mean, round(stddev_pop(z), 3) AS std FROM surface UNION ALL SELECT 'dsm', count(dsm), round(avg(dsm), 3), round(stddev_pop(dsm), 3) FROM surface")
def agg_11(spark: SparkSession, d: str) -> DataFrame:
    return validation.moments(with_surface(spark, d), ["z", "dsm"])


@query("agg_21_land_cover", f"WITH {EVIDENCE}, k AS (SELECT ic::INT AS class_id, count(*) AS n FROM evidence WHERE row BETWEEN 5 AND 14 AND col BETWEEN 10 AND 29 GROUP BY 1), d AS (SELECT r::INT AS class_id FROM range(6) a(r)) SELECT class_id, coalesce(n, 0) AS n, round(coalesce(n, 0) / 200, 6) AS fraction FROM d LEFT JOIN k USING (class_id)")
def agg_21(spark: SparkSession, d: str) -> DataFrame:
    grid = geo.Grid(0, 0, W, 1000, 1.0)
    r0, r1, c0, c1 = grid.window((10.2, 984.9, 30.1, 995.2))
    e = evidence(spark, d).filter(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
    return stats.shares(e, "image_class", {i: str(i) for i in range(6)}).select("class_id", "n", r6(F.col("fraction"), "fraction"))


@query("prj_06_class_mapping", "WITH w(word, class_id) AS (VALUES ('house', 1), ('tower', 1), ('road', 2), ('path', 2), ('tree', 3), ('pond', 5)), l AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Tree; palm ' WHEN 1 THEN 'path,House' WHEN 2 THEN ' POND / sea' WHEN 3 THEN 'car' ELSE ' ; ,' END AS label FROM part), x AS (SELECT p_partkey, lower(trim(unnest(regexp_split_to_array(label, '[;,/]')))) AS word FROM l), m AS (SELECT p_partkey, min(class_id) AS class_id FROM x JOIN w USING (word) GROUP BY 1) SELECT p_partkey, label, coalesce(class_id, 0)::INT AS class_id FROM l LEFT JOIN m USING (p_partkey)")
def prj_06(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    label = F.when(k == 0, "Tree; palm ").when(k == 1, "path,House").when(k == 2, " POND / sea").when(k == 3, "car").otherwise(" ; ,")
    return learning.class_mapping(read(spark, d, "part").select("p_partkey", label.alias("label")), ["other", "building", "road", "vegetation", "bare_soil", "water"])


@query("prj_11_tile_members", f"WITH {CELLS}, o AS (SELECT unnest([0, 12, 24, 36, 34]) AS c), oc AS (SELECT unnest([0, 12, 24, 34]) AS tile_col), orow AS (SELECT unnest([0, 4]) AS tile_row) SELECT tile_row::INT AS tile_row, tile_col::INT AS tile_col, count(*) AS n, round(avg(z), 6) AS z FROM cells, oc, orow WHERE row < 20 AND row >= tile_row AND row < tile_row + 16 AND col >= tile_col AND col < tile_col + 16 GROUP BY ALL")
def prj_11(spark: SparkSession, d: str) -> DataFrame:
    t = rasters.tile_members(cells(spark, d).filter("row < 20"), 20, W, 16, 4)
    return t.groupBy("tile_row", "tile_col").agg(F.count("*").alias("n"), r6(F.avg("z"), "z"))


@query("prj_13_point_cloud", f"WITH {HOLES}, s AS (SELECT row, col, z FROM holed WHERE row < 20), g AS (SELECT r AS row, c AS col, (r + 0.5) * 2 - 0.5 AS fr, (c + 0.5) * 2 - 0.5 AS fc FROM range(10) a(r), range(25) b(c)), q AS (SELECT g.row, g.col, z, 0.25 AS w FROM g, (SELECT unnest([0, 1]) AS dr), (SELECT unnest([0, 1]) AS dc) JOIN s ON s.row = floor(fr) + dr AND s.col = floor(fc) + dc WHERE z IS NOT NULL) SELECT col * 2 + 1.0 AS x, 20 - row * 2 - 1.0 AS y, round(sum(w * z) / sum(w) + 1e-9, 4) AS z, 255 AS red, 0 AS green FROM q GROUP BY row, col")
def prj_13(spark: SparkSession, d: str) -> DataFrame:
    grid = geo.Grid(0, 0, W, 20, 1.0)
    colours = cells(spark, d).filter("row < 20").select("row", "col", F.lit(300.0).alias("red"), F.lit(float("nan")).alias("green"), F.lit(0.0).alias("blue"))
    _, surface = rasters.choose_surface("auto", Raster(holed(spark, d).filter("row < 20"), grid), None)
    t = rasters.point_cloud(surface, Raster(colours, grid), geo.Grid(0, 0, W, 20, 2.0), 1000)
    return t.select("x", "y", F.round(F.col("z") + 1e-9, 4).alias("z"), F.col("red").cast("int").alias("red"), F.col("green").cast("int").alias("green"))


@query("src_16_areas", "SELECT event_id, CASE WHEN event_id % 4 < 3 AND event_id % 5 IN (0, 1, 2) THEN 'polygon' ELSE 'line' END AS kind FROM events")
def src_16(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    node = lambda x, y: F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat"))
    corners = [node(0, 0), node(1, 0), node(1, 1)]
    ring = F.when(k % 4 < 3, F.array(*corners, node(0, 0))).otherwise(F.array(*corners, node(0, 1)))
    tag = lambda *kv: F.create_map(*map(F.lit, kv))
    tags = F.when(k % 5 == 0, tag("building", "yes")).when(k % 5 == 1, tag("area", "yes")).when(k % 5 == 2, tag("leisure", "park", "area", "yes")).when(k % 5 == 3, tag("water", "lake")).otherwise(tag("building", "yes", "area", "no"))
    return read(spark, d, "events").select("event_id", readers.way_kind(ring, tags).alias("kind"))


@query("smp_04_05_tile_batches", "WITH p AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_extendedprice, l_partkey) - 1 AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem), s AS (SELECT l_orderkey, unnest(generate_series(k, 3, least(n, 4))) AS draw, l_quantity FROM p WHERE k < 4) SELECT l_orderkey, string_agg(l_quantity::INT::VARCHAR, ',' ORDER BY draw) AS batch FROM s GROUP BY 1")
def smp_04(spark: SparkSession, d: str) -> DataFrame:
    order = [F.col(c) for c in ("l_quantity", "l_extendedprice", "l_partkey")]
    t = learning.fixed_sample(read(spark, d, "lineitem"), ["l_orderkey"], 4, order).withColumn("features", F.col("l_quantity").cast("int").cast("string"))
    return learning.sample_batches(t, ["l_orderkey"]).withColumn("batch", F.array_join("batch", ","))


@query("ml_02_nt_xent", "WITH f AS (SELECT vec_id // 16 AS batch, vec_id * 2 AS i, embedding::DOUBLE[] AS v FROM embeddings UNION ALL SELECT vec_id // 16, vec_id * 2 + 1, list_transform(embedding::DOUBLE[], lambda x: x + 0.05) FROM embeddings), s AS (SELECT a.batch, a.i, b.i AS j, list_cosine_similarity(a.v, b.v) / 0.1 AS s FROM f a JOIN f b ON a.batch = b.batch AND a.i <> b.i), l AS (SELECT batch, i, ln(sum(exp(s))) - sum(CASE WHEN i // 2 = j // 2 THEN s END) AS loss FROM s GROUP BY ALL) SELECT batch, round(avg(loss), 6) AS loss FROM l GROUP BY 1")
def ml_02(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "embeddings").select("vec_id", F.expr("vec_id div 16").alias("batch"), F.col("embedding").cast("array<double>").alias("a"))
    return contrast.nt_xent(e.withColumn("b", F.transform("a", lambda x: x + 0.05)), "batch", "vec_id", "a", "b").withColumn("loss", F.round("loss", 6))


@query("ml_05_silhouette", "WITH d AS (SELECT a.vec_id, a.label, b.label AS c, sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS s, count(*) AS n FROM embeddings a, embeddings b WHERE a.label IS NOT NULL AND b.label IS NOT NULL GROUP BY ALL), e AS (SELECT vec_id, max(CASE WHEN label = c THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN label <> c THEN s / n END) AS b, max(CASE WHEN label = c THEN n END) AS n FROM d GROUP BY 1) SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM e")
def ml_05(spark: SparkSession, d: str) -> DataFrame:
    return contrast.silhouette(read(spark, d, "embeddings").filter("label IS NOT NULL"), "vec_id").withColumn("silhouette", F.round("silhouette", 6))


@query("agg_19_cluster_sizes", "SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def agg_19(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"))


@query("ml_12_as_list", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN event_type WHEN 2 THEN event_type || '+x' ELSE '' END AS items FROM events")
def ml_12(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 4
    value = F.when(k == 1, F.concat(F.lit('"'), "event_type", F.lit('"'))).when(k == 2, F.concat(F.lit('["'), "event_type", F.lit('", " ", "x"]'))).when(k == 3, F.lit('"  "'))
    return read(spark, d, "events").select("event_id", F.array_join(readers.as_list(value), "+").alias("items"))


@query("srt_01_tile_order", f"WITH {CELLS} SELECT row // 5 AS tile_row, col // 5 AS tile_col, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS members FROM cells GROUP BY ALL")
def srt_01(spark: SparkSession, d: str) -> DataFrame:
    t = cells(spark, d, "o_orderkey").groupBy(F.expr("cast(row div 5 as int)").alias("tile_row"), F.expr("cast(col div 5 as int)").alias("tile_col"))
    return t.agg(F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",").alias("members"))





@query("join_07_polygons", f"WITH {CELLS}, t AS (SELECT p_partkey, p_retailprice, p_partkey % 46 AS x0, p_size * 0.9 + 0.03 AS y0 FROM part) SELECT row, col, arg_max(p_retailprice, p_partkey) AS height FROM cells JOIN t ON row + 0.5 > y0 AND (row + 0.5 - y0) * 2 < (col + 0.5 - x0) * 3 AND (row + 0.5 - y0) * 2 < (x0 + 4 - col - 0.5) * 3 GROUP BY ALL")
def join_07_polygons(spark: SparkSession, d: str) -> DataFrame:
    x0, y0 = F.col("p_partkey") % 46, F.col("p_size") * 0.9 + 0.03
    node = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(node(x0, y0), node(x0 + 4, y0), node(x0 + 2, y0 + 3), node(x0, y0))
    shapes = read(spark, d, "part").select(ring.alias("points"), F.col("p_retailprice").alias("height"), F.col("p_partkey").alias("seq"))
    return sampling.rasterize_shapes(cells(spark, d), shapes, 8, F.col("col") + 0.5, F.col("row") + 0.5)


@query("join_07_roads", f"WITH {CELLS}, t AS (SELECT p_partkey, p_retailprice, p_partkey % 46 AS x0, p_size AS y0 FROM part), s AS (SELECT c.row, c.col, p_partkey, p_retailprice, least(greatest(((col + 0.5 - x0) * 3 + (row + 0.5 - y0) * 4) / 25.0, 0), 1) AS u, x0, y0 FROM cells c JOIN t ON row BETWEEN y0 - 2 AND y0 + 6 AND col BETWEEN x0 - 2 AND x0 + 5) SELECT row, col, arg_max(p_retailprice, p_partkey) AS height FROM s WHERE sqrt((col + 0.5 - x0 - u * 3) ** 2 + (row + 0.5 - y0 - u * 4) ** 2) <= 1.3 GROUP BY ALL")
def join_07_roads(spark: SparkSession, d: str) -> DataFrame:
    x0, y0 = F.col("p_partkey") % 46, F.col("p_size")
    node = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    shapes = read(spark, d, "part").select(F.array(node(x0, y0), node(x0 + 3, y0 + 4)).alias("points"), F.col("p_retailprice").alias("height"), F.col("p_partkey").alias("seq"))
    return sampling.rasterize_shapes(cells(spark, d), shapes, 8, F.col("col") + 0.5, F.col("row") + 0.5, 1.3)


