"""The spatial queries over the generic tables, each with the SQL that must give the same rows.

orders are the cells of a grid 50 wide, lineitem lines are points and object heights, parts are
footprints, customers are places. Floats are rounded alike on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import checks, display, learning, rules, sampling, stats, terrain
from ..sources import readers

W = 50
#: Cells each way in which agg_09 looks for a shift, as the reference does.
MOST_SHIFT = 5
Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c: Column, name: str) -> Column:
    return F.round(c, 6).alias(name)


def cells(spark: SparkSession, d: str, *more: str) -> DataFrame:
    t = read(spark, d, "orders")
    return t.select(F.expr(f"cast(o_orderkey div {W} as int)").alias("row"), (F.col("o_orderkey") % W).cast("int").alias("col"), (F.col("o_totalprice") / 1000.0).alias("z"), *more)


def with_surface(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """cells with dsm; null where an order has no lines."""
    q = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"))
    return cells(spark, d, "o_orderkey", *more).join(q, "o_orderkey", "left").withColumn("dsm", F.col("z") + F.col("q") / 10.0).drop("q")


def evidence(spark: SparkSession, d: str) -> DataFrame:
    t = with_surface(spark, d, "o_custkey", "o_orderpriority")
    return t.select(
        "row", "col", "z", (F.col("o_custkey") % 6).cast("short").alias("image_class"), ((F.col("o_orderkey") % 101) / 100.0).cast("float").alias("image_confidence"), (F.col("dsm") - F.col("z") - 12).alias("object_height"),
        (F.col("o_orderpriority") == "1-URGENT").alias("in_building"), (F.col("o_orderpriority") == "5-LOW").alias("on_road"), (F.col("o_orderkey") % 17 == 0).alias("in_water"),
    )


CELLS = f"cells AS (SELECT (o_orderkey // {W})::INT AS row, (o_orderkey % {W})::INT AS col, o_totalprice / 1000.0 AS z, * FROM orders)"
SURFACE = f"{CELLS}, surface AS (SELECT c.*, z + q / 10.0 AS dsm FROM cells c LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"
EVIDENCE = f"""{SURFACE}, evidence AS (SELECT row, col, z, (o_custkey % 6)::SMALLINT AS ic, ((o_orderkey % 101) / 100.0)::FLOAT AS conf, dsm - z - 12 AS h,
 o_orderpriority = '1-URGENT' AS b, o_orderpriority = '5-LOW' AS r, o_orderkey % 17 = 0 AS w FROM surface)"""
HORN = f"""{CELLS}, n AS (SELECT a.row, a.col, a.z, dr, dc, b.z AS v FROM cells a, (SELECT unnest([-1,0,1]) AS dr), (SELECT unnest([-1,0,1]) AS dc), (SELECT max(row) AS mr, max(col) AS mc FROM cells) m
 JOIN cells b ON b.row = least(greatest(a.row + dr, 0), mr) AND b.col = least(greatest(a.col + dc, 0), mc)),
g AS (SELECT row, col, any_value(z) AS z, sum(v * dc * (CASE WHEN dr = 0 THEN 2 ELSE 1 END)) / (8 * 5.0) AS dx, sum(v * dr * (CASE WHEN dc = 0 THEN 2 ELSE 1 END)) / (8 * 5.0) AS dy FROM n GROUP BY row, col)"""

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        ORACLE_SQL[name] = sql
        return f

    return put


_case = " ".join([
    "WHEN ic = 4 AND c THEN '6|1|image_water'", "WHEN w THEN '6|1|gis_water'", "WHEN ic = 1 AND c AND h >= 2.5 THEN '1|2|image_building_tall'", "WHEN ic = 1 AND c AND h IS NULL THEN '1|3|image_building_no_height'",
    "WHEN b THEN '1|4|gis_building'", "WHEN ic = 3 AND c AND h >= 3.0 THEN '3|5|image_vegetation_tall'", "WHEN ic = 3 AND c AND h IS NOT NULL THEN '4|6|image_vegetation_low'", "WHEN ic = 3 AND c THEN '4|7|image_vegetation_no_height'",
    "WHEN ic = 2 AND c AND h <= 1.0 THEN '2|8|image_road_low'", "WHEN ic = 2 AND c AND h IS NULL THEN '2|9|image_road_no_height'", "WHEN r THEN '2|10|gis_road'", "WHEN ic = 5 AND c THEN '5|11|image_bare_soil'", "WHEN conf > 0 THEN '7|12|image_other_low_confidence'",
])
FUSED = f"{EVIDENCE}, f AS (SELECT *, CASE {_case} ELSE '0|0|unassigned' END AS told FROM (SELECT *, conf >= 0.35::FLOAT AS c FROM evidence))"


def fuse(spark: SparkSession, d: str) -> DataFrame:
    return evidence(spark, d).withColumn("_f", rules.fused(rules.plan())).select("*", "_f.*").drop("_f")


@query("rul_01_fusion_cells", f"WITH {FUSED} SELECT row, col, round(z, 6) AS z, split_part(told, '|', 1)::INT AS fused_class, split_part(told, '|', 2)::INT AS rule, split_part(told, '|', 3) AS count_key FROM f")
def rul_01(spark: SparkSession, d: str) -> DataFrame:
    return fuse(spark, d).select("row", "col", r6(F.col("z"), "z"), F.col("fused_class").cast("int").alias("fused_class"), F.col("rule").cast("int").alias("rule"), "count_key")


@query("agg_07_rule_counts", f"WITH {FUSED} SELECT split_part(told, '|', 3) AS count_key, count(*) AS n FROM f GROUP BY 1")
def agg_07(spark: SparkSession, d: str) -> DataFrame:
    return fuse(spark, d).groupBy("count_key").agg(F.count("*").alias("n"))


_names = ", ".join(f"({i}, '{n}')" for i, n in rules.FUSED.items())


@query("agg_06_class_fractions", f"WITH {FUSED}, d(class_id, class_name) AS (VALUES {_names}), k AS (SELECT split_part(told, '|', 1)::INT AS class_id, count(*) AS n FROM f GROUP BY 1) SELECT class_id, class_name, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT count(*) FROM f), 6) AS fraction FROM d LEFT JOIN k USING (class_id)")
def agg_06(spark: SparkSession, d: str) -> DataFrame:
    return stats.shares(fuse(spark, d), "fused_class", rules.FUSED).withColumn("fraction", F.round("fraction", 6))


@query("ter_01_03_slope_aspect", f"WITH {HORN} SELECT row, col, round(degrees(atan(sqrt(dx * dx + dy * dy))), 6) AS slope, CASE WHEN sqrt(dx * dx + dy * dy) >= 1e-4 THEN round((degrees(atan2(-dx, dy)) + 360) % 360, 6) END AS aspect FROM g")
def ter_01(spark: SparkSession, d: str) -> DataFrame:
    t = terrain.gradients(cells(spark, d), 5.0)
    dx, dy = F.col("dz_dx"), F.col("dz_dy")
    return t.select("row", "col", r6(terrain.slope_deg(dx, dy), "slope"), r6(terrain.aspect_deg(dx, dy), "aspect"))


@query("ter_05_hillshade", f"WITH {HORN}, s AS (SELECT row, col, atan(sqrt(dx * dx + dy * dy)) AS s, atan2(-dx, dy) AS a FROM g) SELECT row, col, round(255 * least(greatest(cos(radians(45)) * cos(s) + sin(radians(45)) * sin(s) * cos(radians(315) - a), 0), 1), 4) AS shade FROM s")
def ter_05(spark: SparkSession, d: str) -> DataFrame:
    t = terrain.gradients(cells(spark, d), 5.0)
    return t.select("row", "col", F.round(terrain.hillshade(F.col("dz_dx"), F.col("dz_dy")), 4).alias("shade"))


@query("ter_04_relief", f"WITH {CELLS}, a AS (SELECT row, col, z, max(z) OVER w AS hi, min(z) OVER w AS lo FROM cells WINDOW w AS (PARTITION BY row ORDER BY col RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)) SELECT row, col, round(max(hi) OVER w - min(lo) OVER w, 6) AS relief FROM a WINDOW w AS (PARTITION BY col ORDER BY row RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def ter_04(spark: SparkSession, d: str) -> DataFrame:
    return terrain.relief(cells(spark, d)).select("row", "col", r6(F.col("relief"), "relief"))


@query("ter_06_ndsm", f"WITH {SURFACE} SELECT row, col, CASE WHEN dsm IS NOT NULL THEN round(least(greatest(dsm - z - 12, 0), 10), 6) END AS ndsm FROM surface")
def ter_06(spark: SparkSession, d: str) -> DataFrame:
    return with_surface(spark, d).select("row", "col", r6(terrain.normalised(F.col("dsm"), F.col("z") + 12, 0.0, 10.0), "ndsm"))


@query("ter_07_point_density", "WITH p AS (SELECT floor(l_quantity / 5)::INT AS row, floor(l_extendedprice / 5000)::INT AS col FROM lineitem), g AS (SELECT r::INT AS row, c::INT AS col FROM range(12) a(r), range(25) b(c)) SELECT g.row, g.col, count(p.row) AS n_points FROM g LEFT JOIN p ON g.row = p.row AND g.col = p.col GROUP BY ALL")
def ter_07(spark: SparkSession, d: str) -> DataFrame:
    grid = geo.Grid(0, 0, 25, 12, 1).cells(spark).select("row", "col")
    return terrain.point_density(read(spark, d, "lineitem").select("l_quantity", "l_extendedprice"), grid, F.floor(F.col("l_quantity") / 5).cast("int"), F.floor(F.col("l_extendedprice") / 5000).cast("int"))


@query("agg_01_describe", f"WITH {CELLS} SELECT count(z) AS count, round(min(z), 6) AS min, round(avg(z), 6) AS mean, round(max(z), 6) AS max, round(stddev_pop(z), 6) AS std, {', '.join(f'round(quantile_cont(z, {p / 100}), 6) AS p{p}' for p in (5, 25, 50, 75, 95))} FROM cells")
def agg_01(spark: SparkSession, d: str) -> DataFrame:
    t = stats.summary(cells(spark, d), F.col("z"))
    return t.select("count", *[F.round(c, 6).alias(c) for c in t.columns if c != "count"])


@query("agg_02_03_aspect_sectors", f"WITH {HORN}, a AS (SELECT (degrees(atan2(-dx, dy)) + 360) % 360 AS a FROM g WHERE sqrt(dx * dx + dy * dy) >= 1e-4) SELECT floor(((a + 22.5) % 360) / 45)::INT AS sector, count(*) AS n, round((degrees(atan2(avg(sin(radians(a))), avg(cos(radians(a))))) + 360) % 360, 4) AS mean_aspect FROM a GROUP BY 1")
def agg_02(spark: SparkSession, d: str) -> DataFrame:
    a = terrain.gradients(cells(spark, d), 5.0).select(terrain.aspect_deg(F.col("dz_dx"), F.col("dz_dy")).alias("a")).filter("a IS NOT NULL")
    return a.groupBy(stats.sector(F.col("a")).alias("sector")).agg(F.count("*").alias("n"), F.round(stats.circular_mean(F.col("a")), 4).alias("mean_aspect"))


@query("agg_08_mask_agreement", "SELECT round(count_if(p AND r) / count_if(p OR r), 6) AS iou, round(count_if(p AND r) / count_if(r), 6) AS recall, round(count_if(p AND r) / count_if(p), 6) AS precision, round(count_if(p) / count(*), 6) AS predicted_fraction, round(count_if(r) / count(*), 6) AS reference_fraction FROM (SELECT quality = 1 AS p, toxic = 1 AS r FROM labels)")
def agg_08(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "labels").agg(*stats.agreement(F.col("quality") == 1, F.col("toxic") == 1))
    return t.select(*[F.round(c, 6).alias(c) for c in t.columns])


@query("agg_09_best_shift", f"WITH {CELLS}, h AS (SELECT max(row) + 1 AS h FROM cells), p AS (SELECT row, col FROM cells WHERE o_orderkey % 7 = 0), r AS (SELECT (row + 2) % h AS row, (col + 49) % {W} AS col FROM p, h), o AS (SELECT a AS d_row, b AS d_col FROM range(-3, 4) x(a), range(-3, 4) y(b)) SELECT d_row::INT AS d_row, d_col::INT AS d_col, count(r.row) AS score FROM o CROSS JOIN p CROSS JOIN h LEFT JOIN r ON r.row = (p.row + d_row + h) % h AND r.col = (p.col + d_col + {W}) % {W} GROUP BY ALL ORDER BY score DESC, d_row, d_col LIMIT 1")
def agg_09(spark: SparkSession, d: str) -> DataFrame:
    t = cells(spark, d, "o_orderkey").select("row", "col", (F.col("o_orderkey") % 7 == 0).alias("p"))
    height = t.agg((F.max("row") + 1).alias("h")).first()["h"]
    back = F.pmod(F.col("row") - 2, F.lit(height)) * W + F.pmod(F.col("col") + 1, F.lit(W))
    return stats.best_shift(t.withColumn("r", back % 7 == 0), "p", "r", height, W, MOST_SHIFT)


@query("agg_10_block_majority", f"WITH {CELLS}, m AS (SELECT max(row) + 1 AS h FROM cells) SELECT row // 4 AS row, col // 4 AS col, avg((z > 150)::INT) > 0.5 AS mask FROM cells, m WHERE row < h // 4 * 4 AND col < {W // 4 * 4} GROUP BY ALL")
def agg_10(spark: SparkSession, d: str) -> DataFrame:
    t = cells(spark, d).withColumn("mask", F.col("z") > 150)
    return stats.block_majority(t, "mask", 4, t.agg((F.max("row") + 1).alias("h")).first()["h"], W)


@query("agg_17_dominant_class", f"WITH {FUSED}, k AS (SELECT row // 5 AS tile_row, col // 5 AS tile_col, split_part(told, '|', 1)::INT AS fused_class, count(*) AS n FROM f GROUP BY ALL) SELECT tile_row, tile_col, fused_class, n FROM k QUALIFY row_number() OVER (PARTITION BY tile_row, tile_col ORDER BY n DESC, fused_class) = 1")
def agg_17(spark: SparkSession, d: str) -> DataFrame:
    t = fuse(spark, d).select(F.expr("row div 5").cast("int").alias("tile_row"), F.expr("col div 5").cast("int").alias("tile_col"), F.col("fused_class").cast("int").alias("fused_class"))
    return sampling.majority(t, ["tile_row", "tile_col"], "fused_class")


@query("agg_22_negative_fraction", f"WITH {SURFACE} SELECT round(avg((dsm - z - 12 < -0.5)::INT), 6) AS negative_fraction, round(median(dsm - z - 12), 6) AS median_height FROM surface WHERE dsm IS NOT NULL")
def agg_22(spark: SparkSession, d: str) -> DataFrame:
    h = with_surface(spark, d).select((F.col("dsm") - F.col("z") - 12).alias("h")).filter("h IS NOT NULL")
    share = h.agg(r6(F.avg((F.col("h") < -0.5).cast("int")), "negative_fraction"))
    return stats.beside(share, stats.quantiles(h, F.col("h"), {"median_height": 0.5}).select(r6(F.col("median_height"), "median_height")))


@query("til_02_tiles", "WITH p AS (SELECT c_custkey, (c_custkey * 37 % 360) - 180 AS lon, (c_custkey * 17 % 160) - 80 AS lat FROM customer) SELECT c_custkey, least(greatest(trunc((lon + 180) / 360 * 32768)::INT, 0), 32767) AS tile_x, least(greatest(trunc((1 - asinh(tan(radians(lat))) / pi()) / 2 * 32768)::INT, 0), 32767) AS tile_y, round(40075016.68 / 32768 / 256 * cos(radians(lat)), 6) AS metres, 'https://t.example/std/15/' || tile_x || '/' || tile_y || '.png' AS url FROM p")
def til_02(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") * 37 % 360) - 180).cast("double").alias("lon"), ((F.col("c_custkey") * 17 % 160) - 80).cast("double").alias("lat"))
    x, y = geo.lonlat_to_tile(F.col("lon"), F.col("lat"), 15)
    t = t.select("c_custkey", x.alias("tile_x"), y.alias("tile_y"), r6(geo.ground_resolution_m(F.col("lat"), F.lit(15)), "metres"))
    return t.withColumn("url", geo.tile_url("https://t.example/", "std", F.col("tile_x"), F.col("tile_y"), 15, ".png"))


@query("crs_02_mercator", "WITH p AS (SELECT c_custkey, (c_custkey * 37 % 360) - 180 AS lon, (c_custkey * 17 % 160) - 80 AS lat FROM customer) SELECT c_custkey, round(radians(lon) * 6378137, 3) AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137, 3) AS y FROM p")
def crs_02(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "customer")
    x, y = geo.to_mercator(((F.col("c_custkey") * 37 % 360) - 180).cast("double"), ((F.col("c_custkey") * 17 % 160) - 80).cast("double"))
    return t.select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("smp_01_voxels", "WITH p AS (SELECT *, row_number() OVER (PARTITION BY floor(l_extendedprice / 1000), floor(l_quantity), floor(l_discount * 100) ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) AS k FROM lineitem) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice FROM p WHERE k = 1")
def smp_01(spark: SparkSession, d: str) -> DataFrame:
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    p = read(spark, d, "lineitem").select(*order, (F.col("l_extendedprice") / 1000).alias("x"), F.col("l_quantity").alias("y"), (F.col("l_discount") * 100).alias("z"))
    return sampling.voxel_first(p, 1.0, order).select(*order)


@query("agg_16_tiles", "WITH p AS (SELECT l_extendedprice / 1000 AS x, l_quantity AS y FROM lineitem), o AS (SELECT min(x) AS x0, min(y) AS y0 FROM p), t AS (SELECT floor((y - y0) / 10)::BIGINT AS tile_y, floor((x - x0) / 10)::BIGINT AS tile_x, count(*) AS n FROM p, o GROUP BY ALL HAVING count(*) >= 32) SELECT *, row_number() OVER (ORDER BY tile_y, tile_x) - 1 AS tile_id FROM t")
def agg_16(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "lineitem").select((F.col("l_extendedprice") / 1000).alias("x"), F.col("l_quantity").alias("y"))
    return sampling.tile_counts(p, 10.0, 32)


@query("join_02_nearest", f"WITH {CELLS}, p AS (SELECT c_custkey, c_custkey % 50 + 0.25 AS x, c_custkey // 60 + 0.5 AS y FROM customer) SELECT c_custkey, round(z, 6) AS z FROM p LEFT JOIN cells ON row = floor(y)::INT AND col = floor(x)::INT")
def join_02(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 50 + 0.25).alias("x"), (F.expr("c_custkey div 60") + 0.5).alias("y"))
    return sampling.nearest(p, cells(spark, d), F.floor("y").cast("int"), F.floor("x").cast("int"), "z").select("c_custkey", r6(F.col("z"), "z"))


@query("join_03_bilinear", f"WITH {CELLS}, p AS (SELECT c_custkey, c_custkey % 50 + 0.25 AS x, c_custkey // 60 + 0.5 AS y FROM customer), n AS (SELECT c_custkey, (CASE WHEN dc = 0 THEN 0.75 ELSE 0.25 END) * 0.5 AS w, c.z AS v FROM p, (SELECT unnest([0,1]) AS dr), (SELECT unnest([0,1]) AS dc) LEFT JOIN cells c ON c.row = floor(y)::INT + dr AND c.col = floor(x)::INT + dc) SELECT c_custkey, round(sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END), 4) AS z FROM n GROUP BY 1")
def join_03(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 50 + 0.25).alias("x"), (F.expr("c_custkey div 60") + 0.5).alias("y"))
    return sampling.bilinear(p, cells(spark, d), "c_custkey", F.col("y"), F.col("x"), "z").select("c_custkey", F.round("z", 4).alias("z"))


@query("join_07_08_footprints", f"WITH {CELLS}, b AS (SELECT p_partkey, p_partkey % 50 - 0.4 AS x0, p_partkey % 50 + 1.7 AS x1, p_size - 0.4 AS y0, p_size + 1.7 AS y1, p_retailprice FROM part) SELECT row, col, arg_max(p_retailprice, p_partkey) AS height FROM cells JOIN b ON col + 0.5 > x0 AND col + 0.5 < x1 AND row + 0.5 > y0 AND row + 0.5 < y1 GROUP BY ALL")
def join_07(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("p_partkey") % 50, F.col("p_size")
    boxes = read(spark, d, "part").select((x - 0.4).alias("min_x"), (x + 1.7).alias("max_x"), (y - 0.4).alias("min_y"), (y + 1.7).alias("max_y"), F.col("p_retailprice").alias("height"), F.col("p_partkey").alias("seq"))
    return sampling.rasterize_boxes(cells(spark, d), boxes, 8, F.col("col") + 0.5, F.col("row") + 0.5)


@query("prj_05_heights", "WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN (event_id % 40) || ' m' WHEN event_id % 3 = 1 THEN 'bogus' END AS height, CASE WHEN event_id % 2 = 0 THEN (event_id % 9)::VARCHAR END AS levels FROM events) SELECT event_id, coalesce(try_cast(nullif(regexp_extract(height, '(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE), try_cast(nullif(regexp_extract(levels, '(\\d+)', 1), '') AS DOUBLE) * 3) AS height_m, CASE WHEN regexp_extract(height, '\\d+') <> '' THEN 'height' WHEN regexp_extract(levels, '\\d+') <> '' THEN 'levels' END AS height_source FROM e")
def prj_05(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id")
    e = read(spark, d, "events").select("event_id", F.when(i % 3 == 0, F.concat((i % 40).cast("string"), F.lit(" m"))).when(i % 3 == 1, "bogus").alias("height"), F.when(i % 2 == 0, (i % 9).cast("string")).alias("levels"))
    h, source = readers.building_height(F.col("height"), F.col("levels"))
    return e.select("event_id", h.alias("height_m"), source.alias("height_source"))


@query("agg_05_coverage", f"WITH {SURFACE} SELECT round(count(dsm) / count(*), 6) AS coverage FROM surface")
def agg_05(spark: SparkSession, d: str) -> DataFrame:
    return with_surface(spark, d).agg(r6(stats.coverage(F.col("dsm")), "coverage"))


_images = ", ".join(f"({i}, '{n}')" for n, i in rules.IMAGE.items())


@query("agg_15_image_classes", f"WITH {EVIDENCE}, d(class_id, class_name) AS (VALUES {_images}), k AS (SELECT ic::INT AS class_id, count(*) AS n, avg(conf::DOUBLE) AS c FROM evidence GROUP BY 1) SELECT class_id, class_name, coalesce(n, 0) AS n, round(coalesce(n, 0) / (SELECT count(*) FROM evidence), 6) AS fraction, round(c, 5) AS mean_confidence FROM d LEFT JOIN k USING (class_id)")
def agg_15(spark: SparkSession, d: str) -> DataFrame:
    e = evidence(spark, d).select(F.col("image_class").cast("int").alias("class_id"), F.col("image_confidence").cast("double").alias("c"))
    n = stats.shares(e, "class_id", {i: n for n, i in rules.IMAGE.items()}).withColumn("fraction", F.round("fraction", 6))
    return n.join(e.groupBy("class_id").agg(F.round(F.avg("c"), 5).alias("mean_confidence")), "class_id", "left")


@query("agg_18_tile_histogram", f"WITH {FUSED}, k AS (SELECT row // 5 AS tile_row, col // 5 AS tile_col, split_part(told, '|', 1)::INT AS fused_class, count(*) AS n FROM f GROUP BY ALL) SELECT tile_row, tile_col, fused_class, round(n / sum(n) OVER (PARTITION BY tile_row, tile_col), 6) AS share FROM k")
def agg_18(spark: SparkSession, d: str) -> DataFrame:
    t = fuse(spark, d).select(F.expr("row div 5").cast("int").alias("tile_row"), F.expr("col div 5").cast("int").alias("tile_col"), F.col("fused_class").cast("int").alias("fused_class"))
    return sampling.class_shares(t, ["tile_row", "tile_col"], "fused_class").withColumn("share", F.round("share", 6))


@query("val_03_surface_over_ground", f"WITH {SURFACE}, a AS (SELECT coalesce(avg((dsm - z - 3 < -0.5)::INT), 1.0) AS n, median(dsm - z - 3) AS m FROM surface WHERE dsm IS NOT NULL) SELECT round(n, 6) AS negative_fraction, round(m, 6) AS median_difference_m, CASE WHEN n < 0.02 THEN 'pass' WHEN n < 0.05 THEN 'warn' ELSE 'fail' END AS status FROM a")
def val_03(spark: SparkSession, d: str) -> DataFrame:
    t = checks.surface_over_ground(with_surface(spark, d), F.col("dsm") - F.col("z") - 3)
    return t.select(r6(F.col("negative_fraction"), "negative_fraction"), r6(F.col("median_difference_m"), "median_difference_m"), "status")


@query("val_04_buildings_are_tall", f"WITH {EVIDENCE}, a AS (SELECT median(h) FILTER (b) AS i, median(h) FILTER (NOT b) AS o, avg((h > 2.5)::INT) FILTER (b AND h IS NOT NULL) AS t FROM evidence) SELECT round(i, 6) AS median_inside_m, round(o, 6) AS median_outside_m, round(t, 6) AS tall_fraction, CASE WHEN i IS NULL OR o IS NULL THEN 'unavailable' WHEN i > o + 1 AND t > 0.5 THEN 'pass' ELSE 'fail' END AS status FROM a")
def val_04(spark: SparkSession, d: str) -> DataFrame:
    t = checks.buildings_are_tall(evidence(spark, d), F.col("object_height"), F.col("in_building"))
    return t.select(*[r6(F.col(c), c) for c in t.columns[:3]], "status")


@query("val_05_colours_agree", "WITH p AS (SELECT l_quantity AS a, l_quantity + l_linenumber % 3 AS b, round(l_discount * 100) AS c, round(l_tax * 100) AS e FROM lineitem), s AS (SELECT count(*) AS n, count_if(a + c + e = 0) AS u, corr(a, b) AS r, avg((abs(a - b) + abs(c - e) + abs(e - c)) / 3) AS m FROM p) SELECT n AS points, u AS unsampled_points, round(r, 6) AS red_correlation, round(m, 6) AS mean_abs_difference, CASE WHEN u = 0 AND r > 0.95 THEN 'pass' WHEN r > 0.8 THEN 'warn' ELSE 'fail' END AS status FROM s")
def val_05(spark: SparkSession, d: str) -> DataFrame:
    red, c, e = F.col("l_quantity"), F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100)
    t = checks.colours_agree(read(spark, d, "lineitem"), [red, c, e], [red + F.col("l_linenumber") % 3, e, c])
    return t.select("points", F.col("unsampled_points").cast("long").alias("unsampled_points"), r6(F.col("red_correlation"), "red_correlation"), r6(F.col("mean_abs_difference"), "mean_abs_difference"), "status")


@query("viz_01_decimate", f"WITH {SURFACE} SELECT row // 4 AS row, col // 4 AS col, round(avg(dsm), 6) AS dsm FROM surface GROUP BY ALL")
def viz_01(spark: SparkSession, d: str) -> DataFrame:
    return display.decimate(with_surface(spark, d), "dsm", 4).withColumn("dsm", F.round("dsm", 6))


@query("viz_02_stretch", f"WITH {SURFACE} SELECT round(quantile_cont(dsm, 0.02), 6) AS low, round(quantile_cont(dsm, 0.98), 6) AS high FROM surface")
def viz_02(spark: SparkSession, d: str) -> DataFrame:
    return display.stretch(with_surface(spark, d), "dsm").select(r6(F.col("low"), "low"), r6(F.col("high"), "high"))


@query("viz_03_histogram", "WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem), k AS (SELECT least(floor((l_quantity - lo) * 60 / (hi - lo)), 59)::INT AS bin, count(*) AS n FROM lineitem, e GROUP BY 1) SELECT r::INT AS bin, coalesce(n, 0) AS n FROM range(60) a(r) LEFT JOIN k ON bin = r")
def viz_03(spark: SparkSession, d: str) -> DataFrame:
    return display.histogram(read(spark, d, "lineitem").select("l_quantity"), "l_quantity")


@query("til_04_tile_range", "SELECT z::INT AS zoom, x::INT AS tile_x, y::INT AS tile_y, (y - 13005) * 256 AS row_offset, (x - 28690) * 256 AS col_offset FROM (SELECT 15 AS z), range(28690, 28697) a(x), range(13005, 13013) b(y)")
def til_04(spark: SparkSession, d: str) -> DataFrame:
    return geo.tile_range(spark, 15, 28690, 13005, 28696, 13012)


@query("src_03_fill_missing", f"WITH {SURFACE}, s AS (SELECT row, col, CASE WHEN o_orderkey % 3 > 0 THEN dsm END AS a, CASE WHEN o_orderkey % 5 > 0 THEN z END AS b, CASE WHEN o_orderkey % 2 > 0 THEN z + 1 END AS c FROM surface) SELECT row, col, round(coalesce(a, b, c), 6) AS z, CASE WHEN a IS NOT NULL THEN 0 WHEN b IS NOT NULL THEN 1 WHEN c IS NOT NULL THEN 2 END AS source FROM s")
def src_03(spark: SparkSession, d: str) -> DataFrame:
    t, k = cells(spark, d, "o_orderkey"), F.col("o_orderkey")
    first = with_surface(spark, d).select("row", "col", F.when((F.col("row") * W + F.col("col")) % 3 > 0, F.col("dsm")).alias("z"))
    return readers.fill_missing(first, [t.filter(k % 5 > 0).select("row", "col", "z"), t.filter(k % 2 > 0).select("row", "col", (F.col("z") + 1).alias("z"))]).withColumn("z", F.round("z", 6))


@query("prj_07_08_project_classes", "WITH s AS (SELECT l_orderkey, (l_partkey % 5)::INT AS source, l_quantity AS p FROM lineitem), g AS (SELECT l_orderkey, (CASE source WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END)::INT AS class_id, sum(p) AS confidence FROM s GROUP BY ALL) SELECT l_orderkey, class_id, round(confidence, 6) AS confidence FROM g QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY confidence DESC, class_id) = 1")
def prj_07(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "lineitem").select("l_orderkey", (F.col("l_partkey") % 5).cast("int").alias("source"), F.col("l_quantity").alias("p"))
    return learning.project_classes(t, ["l_orderkey"], "source", "p", {1: 2, 2: 2, 3: 1}).withColumn("confidence", F.round("confidence", 6))


@query("prj_16_subregion", f"WITH {HORN}, s AS (SELECT z, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope FROM g WHERE row BETWEEN 5 AND 14 AND col BETWEEN 10 AND 29) SELECT count(*) AS cells, round(avg(z), 6) AS mean_z, round(min(z), 6) AS min_z, round(max(z), 6) AS max_z, round(avg(slope), 6) AS mean_slope, round(max(slope), 6) AS max_slope FROM s")
def prj_16(spark: SparkSession, d: str) -> DataFrame:
    # the stencil needs one more row and column on each side, nothing else of the grid
    near = cells(spark, d).filter("row BETWEEN 4 AND 15 AND col BETWEEN 9 AND 30")
    t = terrain.gradients(near, 5.0).filter("row BETWEEN 5 AND 14 AND col BETWEEN 10 AND 29").withColumn("slope", terrain.slope_deg(F.col("dz_dx"), F.col("dz_dy")))
    return t.agg(F.count("*").alias("cells"), r6(F.avg("z"), "mean_z"), r6(F.min("z"), "min_z"), r6(F.max("z"), "max_z"), r6(F.avg("slope"), "mean_slope"), r6(F.max("slope"), "max_slope"))


_draw = "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice"


@query("smp_03_fixed_sample", f"WITH p AS (SELECT l_orderkey, {_draw}, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_draw}) - 1 AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) SELECT l_orderkey, l_partkey, l_linenumber, draw::INT AS draw FROM p, range(4) r(draw) WHERE k = draw % n")
def smp_03(spark: SparkSession, d: str) -> DataFrame:
    t = learning.fixed_sample(read(spark, d, "lineitem"), ["l_orderkey"], 4, [F.col(c) for c in _draw.split(", ")])
    return t.select("l_orderkey", "l_partkey", "l_linenumber", F.col("draw").cast("int").alias("draw"))


@query("ml_11_json_reply", "WITH t AS (SELECT conv_id, turn, conv_id % 4 AS kind FROM conversations WHERE turn = 0) SELECT conv_id, CASE kind WHEN 0 THEN '{\"turn\": ' || turn || '}' WHEN 1 THEN '{\"a\": [1, 2]}' END AS reply FROM t")
def ml_11(spark: SparkSession, d: str) -> DataFrame:
    t, k = read(spark, d, "conversations").filter("turn = 0"), F.col("conv_id") % 4
    said = F.when(k == 0, F.concat(F.lit('<think>{"no": 1}</think>Here: {"turn": '), F.col("turn").cast("string"), F.lit("} so")))
    said = said.when(k == 1, F.lit('Text {x}\n```json\n{"a": [1, 2]}\n``` more')).when(k == 2, "no object").otherwise(F.lit('{"cut": '))
    return t.select("conv_id", readers.json_reply(said).alias("reply"))


# the parser over every row, each reply built around the row's whole text; DuckDB parses it again by its own regular expressions
_said = {
    0: """'<think>{"no": 1} ' || text || '</think>' || text || ' {"turn": ' || turn || ', "text": "' || esc || '"} so'""",
    1: """text || chr(10) || '```json' || chr(10) || '{"a": {"b": [' || turn || ', {"t": "' || esc || '"}]}}' || chr(10) || '``` more'""",
    2: "text",
    3: """text || '{"cut": "' || esc""",
    4: """'{"t": "' || text || '"}'""",
}
_SAID = "CASE (conv_id + turn) % 5 " + " ".join(f"WHEN {k} THEN {v}" for k, v in _said.items()) + " END"
_ESC = "replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"
_ESC = f"replace(replace(replace({_ESC}, chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"


@query("ml_11_json_reply_texts", f"WITH t AS (SELECT *, {_ESC} AS esc FROM conversations), b AS (SELECT conv_id, turn, regexp_replace({_SAID}, '(?s)<think>.*?</think>', '', 'g') AS bare FROM t), p AS (SELECT conv_id, turn, coalesce(nullif(regexp_extract(bare, '(?s)```(?:json)?\\s*(\\{{.*?\\}})\\s*```', 1), ''), regexp_extract(bare, '(?s)\\{{.*\\}}', 0)) AS body FROM b) SELECT conv_id, turn, CASE WHEN json_valid(body) THEN body END AS reply FROM p")
def ml_11_texts(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "conversations").withColumn("esc", F.expr(_ESC))
    return t.select("conv_id", "turn", readers.json_reply(F.expr(_SAID)).alias("reply"))
