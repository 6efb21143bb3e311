import json
import math

import duckdb
import pytest
from conftest import DATA, by_sql, rows
from pyspark.sql import functions as F

from cellweave.functions import geo
from cellweave.operators import learning, rules, sampling, stats, terrain
from cellweave.plans import queries
from cellweave.plans.queries import ORACLE_SQL, QUERIES
from cellweave.sources import readers


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(by_sql(ORACLE_SQL[name]))


def test_plane_has_its_slope_and_aspect(spark):
    t = spark.range(121).select((F.col("id") / 11).cast("int").alias("row"), (F.col("id") % 11).cast("int").alias("col"))
    t = t.withColumn("z", F.col("col") * 0.5)
    got = terrain.gradients(t, 5.0).filter("row BETWEEN 1 AND 9 AND col BETWEEN 1 AND 9").select(terrain.slope_deg(F.col("dz_dx"), F.col("dz_dy")), terrain.aspect_deg(F.col("dz_dx"), F.col("dz_dy"))).collect()
    assert all(abs(a - math.degrees(math.atan(0.1))) < 1e-9 and abs(b - 270) < 1e-9 for a, b in got)


def test_flat_ground_has_no_aspect(spark):
    t = spark.range(9).select((F.col("id") / 3).cast("int").alias("row"), (F.col("id") % 3).cast("int").alias("col"), F.lit(42.0).alias("z"))
    assert {tuple(r) for r in terrain.gradients(t, 1.0).select(terrain.slope_deg(F.col("dz_dx"), F.col("dz_dy")), terrain.aspect_deg(F.col("dz_dx"), F.col("dz_dy"))).collect()} == {(0.0, None)}


def test_unknown_height_is_not_tall_and_exact_threshold_passes(spark):
    t = spark.sql("SELECT * FROM VALUES (3S, 0.35F, CAST(NULL AS DOUBLE)), (1S, 0.9F, 1.0D), (1S, 0.9F, 2.5D), (2S, 0.9F, NULL) AS t(image_class, image_confidence, object_height)")
    t = t.withColumns({c: F.lit(None).cast("boolean") for c in ("in_building", "on_road", "in_water")})
    assert [r[0] for r in t.select(rules.fused(rules.plan())["count_key"]).collect()] == ["image_vegetation_no_height", "image_other_low_confidence", "image_building_tall", "image_road_no_height"]
    assert [r[0] for r in t.select(rules.fused(rules.plan(has_height=False, has_gis=False))["rule"]).collect()] == [7, 3, 3, 9]


def test_transverse_mercator_of_a_known_place(spark):
    e, n = spark.range(1).select(*geo.to_transverse_mercator(F.lit(135.2348), F.lit(34.7284), 134 + 20 / 60, 36.0)).first()
    assert abs(e - 82557.182) < 0.01 and abs(n + 140696.440) < 0.01


@pytest.mark.parametrize("shift", [(4, -5), (-5, 4), (5, 5)])
def test_best_shift_finds_far_shifts(spark, shift):
    h, w = 20, 30
    p = {(r, c) for r in range(h) for c in range(w) if (r * r * 7 + c * c * c * 3 + r * c) % 11 == 0}
    data = [(r, c, (r, c) in p, ((r - shift[0]) % h, (c - shift[1]) % w) in p) for r in range(h) for c in range(w)]
    t = spark.createDataFrame(data, "row int, col int, p boolean, r boolean")
    assert tuple(stats.best_shift(t, "p", "r", h, w, queries.MOST_SHIFT).first()) == (*shift, len(p))


def test_grid_snaps_and_bins():
    assert geo.snap_bounds((0.4, 0.4, 9.2, 9.2), 2.0, 5.0) == (0, 0, 10, 10)
    g = geo.Grid(0, 0, 10, 20, 0.5)
    assert (g.width, g.height) == (20, 40) and g.matches(geo.Grid(0, 0, 10, 20, 0.5 + 1e-9))


def test_xyz_tile_and_elements(spark):
    lines = spark.createDataFrame([("# head", 0), ("0,0,1", 1), ("2 0 2", 2), ("0,2,3", 3), ("0,2,4", 4)], "value string, n int")
    pts = lines.filter(~F.col("value").startswith("#")).select(F.split("value", r"[,\s]+").alias("v"), "n").select(*[F.col("v")[i].cast("double").alias(c) for i, c in enumerate("xyz")], "n")
    assert {tuple(r) for r in readers.xyz_grid(pts, "n").collect()} == {(1, 0, 1.0), (1, 1, 2.0), (0, 0, 4.0)}
    assert readers.xyz_points(lines).count() == 4
    tile = spark.createDataFrame([("1.5,e", 0)], "value string, line_no int")
    assert [r["z"] for r in readers.elevation_tile(tile).orderBy("col").collect()] == [1.5, None]
    ring = '[{"lon":0,"lat":0},{"lon":1,"lat":0},{"lon":1,"lat":1},{"lon":0,"lat":0}]'
    js = spark.createDataFrame([(f'{{"elements":[{{"type":"way","id":1,"tags":{{"building":"yes"}},"geometry":{ring}}},{{"type":"way","id":2,"tags":{{}},"geometry":{ring}}},{{"type":"node","id":3}}]}}',)], "value string")
    assert {(r["osm_id"], r["kind"]) for r in readers.map_elements(js).collect()} == {("way/1", "polygon"), ("way/2", "line")}


def test_replies(spark):
    t = spark.createDataFrame([('x {"a": 1} y',), ('<think>{}</think>```json\n{"b": 2}\n```',), ("none",), (None,)], "t string")
    assert [r[0] for r in t.select(readers.json_reply(F.col("t"))).collect()] == ['{"a": 1}', '{"b": 2}', None, None]


def test_replies_around_every_whole_text(spark):
    said = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()}
    got = {(r.conv_id, r.turn): r.reply for r in QUERIES["ml_11_json_reply_texts"](spark, DATA).collect()}
    assert got.keys() == said.keys() and {t for _, t in got} != {0}
    for (c, t), text in said.items():
        want = [{"turn": t, "text": text}, {"a": {"b": [t, {"t": text}]}}, None, None, None if "\n" in text else {"t": text}][(c + t) % 5]
        assert (got[c, t] and json.loads(got[c, t])) == want


def test_replies_around_odd_texts(spark, tmp_path):
    odd = [None, "", "{", "a } b", '"q" \\ {x}', "<think>", "tab\t\r\n", "x" * 200_000, "{" * 500 + "}" * 500, "```json\n{}\n```", "é\U0001f600 {"]
    spark.createDataFrame([(i, k, "user", t) for i, t in enumerate(odd) for k in range(5)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert rows(QUERIES["ml_11_json_reply_texts"](spark, str(tmp_path)).toPandas()) == rows(c.sql(ORACLE_SQL["ml_11_json_reply_texts"]).df())


def test_ring_line_voxel_and_sample(spark):
    p = spark.createDataFrame([(0, 0.5, 0.5, 0.0), (1, 0.6, 0.6, 0.0), (2, 5.0, 5.0, 0.0)], "idx int, x double, y double, z double")
    ring = F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))])
    assert [r[0] for r in p.orderBy("idx").select(sampling.ring_contains(F.col("x"), F.col("y"), ring)).collect()] == [True, True, False]
    assert [r[0] for r in p.orderBy("idx").select(sampling.line_within(F.col("x"), F.col("y"), ring, 0.55)).collect()] == [True, False, False]
    assert {r["idx"] for r in sampling.voxel_first(p, 1.0, ["idx"]).collect()} == {0, 2}
    assert sampling.exact_sample(p, 2, "idx", 1).count() == 2
    assert p.agg(*stats.describe(F.col("x"))).first()["count"] == 3


def test_shapes_burn_by_their_own_outline(spark):
    cells = spark.range(900).select(F.expr("cast(id div 30 as int)").alias("row"), (F.col("id") % 30).cast("int").alias("col"))
    shape = lambda *p: [{"x": float(a), "y": float(b)} for a, b in p]
    kind = "points array<struct<x: double, y: double>>, height double, seq int"
    at = (F.col("col") + 0.5, F.col("row") + 0.5)
    burn = lambda shapes, **more: {(r.row, r.col): r.height for r in sampling.rasterize_shapes(cells, spark.createDataFrame(shapes, kind), 7, *at, **more).collect()}
    # two triangles, the second over the first
    got = burn([(shape((0, 0), (20.5, 0), (0, 20.5), (0, 0)), 3.0, 1), (shape((10.25, 0), (29, 0), (29, 18.75), (10.25, 0)), 4.0, 2)])
    want = {(r, c): 4.0 if c + 0.5 < 29 and r < c - 10.25 else 3.0 for r in range(30) for c in range(30) if r + c + 1 < 20.5 or (c + 0.5 < 29 and r < c - 10.25)}
    assert got.keys() == want.keys() and got == want
    got = burn([(shape((5, 5), (25, 5), (25, 25)), 1.0, 1)], radius=1.6)
    far = lambda a, b: min(math.hypot(a - min(max(a, 5), 25), b - 5), math.hypot(a - 25, b - min(max(b, 5), 25)))
    assert got.keys() == {(r, c) for r in range(30) for c in range(30) if far(c + 0.5, r + 0.5) <= 1.6}


def test_tile_origins_cover_and_end_at_the_edge():
    assert learning.tile_origins(100, 40, 10) == [0, 30, 60] and learning.tile_origins(110, 40, 10) == [0, 30, 60, 70] and learning.tile_origins(20, 40, 10) == [0]


def test_feature_widths_and_unknown_heights(spark):
    t = spark.sql("SELECT 1 AS tile, 25D AS x, 75D AS y, 10D AS z, 255S AS red, 0S AS green, 51S AS blue, 45D AS slope, CAST(NULL AS DOUBLE) AS aspect, 10D AS relief, double('NaN') AS object_height, 2S AS image_class, 0.5F AS image_confidence, true AS in_building, false AS on_road")
    for name in learning.FEATURE_SETS:
        got = learning.features(t, name, ["tile"], F.lit(0.0), F.lit(50.0), 50.0, 6).first()["features"]
        assert len(got) == learning.feature_dimension(name, 6)
    assert [round(v, 4) for v in got] == [0, 0, 0, 1, 0, 0.2, 0.5, 0, 1, 0.5, 0, 0, 0, 0, 0.5, 0, 0, 0, 1, 0]


def test_blend_weights_taper_to_a_floor_and_average_overlaps(spark):
    at = lambda r, c: learning.blend_weight(F.lit(r), F.lit(c), 8, 3)
    got = spark.range(1).select(at(3, 4), at(0, 3), at(7, 3), at(0, 0), at(2, 5)).first()
    edge = (1 - math.cos(math.pi / 4)) / 2
    assert [round(v, 9) for v in got] == [round(v, 9) for v in (1, edge, edge, 0.05, ((1 - math.cos(math.pi * 3 / 4)) / 2) ** 2)]
    t = spark.createDataFrame([(1, 0, 0.2, 1.0), (1, 0, 0.8, 3.0), (2, 0, 0.5, 0.0)], "cell int, k int, p double, w double")
    assert {r.cell: round(r.p, 9) for r in learning.blended(t, ["cell"], "k", "p", F.col("w")).collect()} == {1: 0.65, 2: 0.0}
