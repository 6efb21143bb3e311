import json
import math

import numpy as np
import pytest
from conftest import DATA, by_sql, rows
from pyspark.sql import functions as F

from cellweave import api, settings
from cellweave.functions import geo
from cellweave.operators import contrast, rasters, rules, stats, terrain, validation
from cellweave.operators.rasters import Raster
from cellweave.plans import fusion, more
from cellweave.plans.queries import ORACLE_SQL, QUERIES
from cellweave.sources import readers

NEW = [n for n, f in QUERIES.items() if f.__module__ == more.__name__]


@pytest.mark.parametrize("name", NEW)
def test_query_matches_sql(spark, name):
    got, want = rows(QUERIES[name](spark, DATA).toPandas()), rows(by_sql(ORACLE_SQL[name]))
    assert got == want and got


def test_projections_go_back():
    for crs in ("EPSG:6673", "EPSG:3857", "EPSG:6669"):
        x, y = geo.transform(135.2348, 34.7284, geo.GEOGRAPHIC, crs, math)
        assert geo.transform(x, y, crs, geo.GEOGRAPHIC, math) == pytest.approx((135.2348, 34.7284), abs=1e-8)
    x, y = geo.transform(135.2348, 34.7284, geo.GEOGRAPHIC, "EPSG:6673", math)
    assert (x, y) == pytest.approx((82557.182, -140696.440), abs=2e-3)
    assert geo.transform(1.0, 2.0, geo.GEOGRAPHIC, geo.GEOGRAPHIC) == (1.0, 2.0)
    for bad in (lambda: geo.check_roles(geo.GEOGRAPHIC), lambda: geo.check_roles("EPSG:6673", "EPSG:3857"), lambda: geo.is_projected("EPSG:1")):
        with pytest.raises(settings.CrsError):
            bad()


def test_regions_grids_and_tiles(spark):
    r = geo.Region.around(135.2348, 34.7284, 100.0)
    fine, coarse = r.grid(0.5), r.grid(5.0)
    assert (fine.min_x, fine.max_y) == (coarse.min_x, coarse.max_y) and fine.max_x == coarse.max_x
    west, south, east, north = r.bounds_in(geo.GEOGRAPHIC)
    assert west < 135.2348 < east and south < 34.7284 < north
    assert r.buffered(10).bounds[0] == r.bounds[0] - 10 and len(list(geo.densify(r.bounds, 20))) == 84
    assert geo.tile_of(135.2348, 34.7284, 15) == (28693, 13009) and geo.tile_of(135.2348, 34.7284, 18) == (229546, 104075)
    x0, y0, x1, y1 = geo.tiles_of_bounds((135.22, 34.72, 135.25, 34.74), 15)
    assert x0 <= 28693 <= x1 and y0 <= 13009 <= y1
    g = geo.Grid(0, 0, 100, 100, 5)
    tiles = list(g.tiles(30))
    assert len(tiles) == 16 and sum((e - w) * (n - s) for w, s, e, n in tiles) == 10000 and tiles[0] == (0, 0, 30, 30)
    cells = g.cells(spark)
    assert sum(cells.filter(geo.in_box(F.col("x"), F.col("y"), t)).count() for t in tiles[:3]) == 36 * 3
    assert g.window((11, 11, 39, 39)) == (12, 17, 2, 7)
    with pytest.raises(settings.NoDataError):
        g.window((200, 0, 300, 10))
    assert geo.lattice_problems({"a": g, "b": geo.Grid(0, 0, 100, 100, 0.5), "c": geo.Grid(2.5, 0, 100, 100, 5)}) == ["c: min_x is 2.5 m off, no whole number of cells"]
    with pytest.raises(settings.AlignmentError):
        geo.assert_aligned([g, geo.Grid(0, 0, 100, 100, 0.5)])


def test_nan_and_absent_cells(spark):
    nan = float("nan")
    t = spark.createDataFrame([(0, 0, 1.0), (0, 1, nan), (0, 2, 2.0), (0, 3, None)], "row int, col int, z double")
    assert t.agg(stats.coverage(F.col("z")).alias("c")).first()["c"] == 0.5
    s = stats.summary(t, F.col("z")).first()
    assert (s["count"], s["mean"], s["p50"], s["max"]) == (2, 1.5, 1.5, 2.0)
    assert stats.summary(t.limit(0), F.col("z")).first()["p50"] is None
    many = spark.createDataFrame([(float(v),) for v in [*range(1000), *[7] * 500]], "z double")
    q = stats.quantiles(many, F.col("z"), {"a": 0.0, "b": 0.333, "c": 1.0}).first()
    assert tuple(q) == pytest.approx(tuple(np.quantile([*range(1000), *[7] * 500], [0, 0.333, 1])))
    # the cell (1, 1) is absent, so its neighbours have no gradient, while the grid's edges replicate
    plane = spark.createDataFrame([(r, c, 2.0 * c) for r in range(5) for c in range(5) if (r, c) != (1, 1)], "row int, col int, z double")
    got = {(r["row"], r["col"]): r["dz_dx"] for r in terrain.gradients(plane, 1.0, shape=(5, 5)).collect()}
    assert all(got[p] is None for p in ((0, 0), (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1), (2, 2)))
    assert got[(3, 2)] == 2.0 and got[(3, 0)] == 1.0
    e = spark.createDataFrame([(1, 0.9, nan), (1, 0.9, 3.0), (1, 0.9, None)], "image_class short, image_confidence float, object_height float")
    e = e.withColumns({c: F.lit(None).cast("boolean") for c in ("in_building", "on_road", "in_water")})
    assert [r["k"] for r in e.select(rules.fused(rules.plan())["count_key"].alias("k")).collect()] == ["image_building_no_height", "image_building_tall", "image_building_no_height"]
    assert len(rules.skipped(False)) == 3 and rules.skipped() == []
    assert [r["k"] for r in e.select(rules.fused(rules.plan(vocabulary={"road": 2}))["rule"].alias("k")).collect()] == [12, 12, 12]


def test_readers_refuse_what_is_no_grid(spark):
    with pytest.raises(Exception, match="two different"):
        readers.xyz_grid(spark.createDataFrame([(1.0, 2.0, 3.0, 0)], "x double, y double, z double, n int"), "n").collect()
    with pytest.raises(Exception, match="256 x 256"):
        readers.standard_tile(spark.createDataFrame([("1,2", 0)], "value string, line_no int")).collect()
    whole = spark.range(256).select(F.array_join(F.array_repeat(F.lit("1.5"), 256), ",").alias("value"), F.col("id").alias("line_no"))
    assert readers.standard_tile(whole).count() == 65536
    assert "way[\"highway\"](1,2,3,4);" in readers.layer_request("road", (2, 1, 4, 3), 25)
    with pytest.raises(settings.UnsupportedError):
        readers.layer_request("sky", (0, 0, 1, 1), 1)


def test_relations_and_promoted_tags(spark):
    ring = [{"lon": 0, "lat": 0}, {"lon": 1, "lat": 0}, {"lon": 1, "lat": 1}, {"lon": 0, "lat": 0}]
    members = [{"role": "outer", "geometry": ring}, {"role": "inner", "geometry": ring}, {"role": "", "geometry": ring}, {"role": "outer", "geometry": ring[:3]}]
    doc = {"elements": [{"type": "relation", "id": 5, "tags": {"building": "yes", "building:levels": "3"}, "members": members}, {"type": "relation", "id": 6, "members": members[3:]}, {"type": "way", "id": 7, "tags": {"area": "yes"}, "geometry": ring}, {"type": "way", "id": 8, "tags": {"water": "lake"}, "geometry": ring}]}
    got = {r["osm_id"]: r for r in readers.map_elements(spark.createDataFrame([(json.dumps(doc),)], "value string")).collect()}
    assert {k: (r["osm_type"], r["kind"], len(r["rings"])) for k, r in got.items()} == {"relation/5": ("relation", "polygon", 2), "way/7": ("way", "polygon", 1), "way/8": ("way", "line", 1)}
    assert got["relation/5"]["building_levels"] == "3" and json.loads(got["way/7"]["tags"]) == {"area": "yes"}


def test_sampling_guards_and_clipping(spark):
    ramp = Raster(geo.Grid(1000, 2000, 1010, 2010, 1).cells(spark).select("row", "col", F.col("col").cast("double").alias("z")), geo.Grid(1000, 2000, 1010, 2010, 1))
    p = spark.createDataFrame([(1, 1000.5, 2005.0), (2, 1004.0, 2005.5), (3, 1011.0, 2005.0)], "k long, x double, y double")
    assert {r["k"]: r["z"] for r in rasters.sample(p, ramp, "z", "k", "EPSG:6673").collect()} == {1: 0.0, 2: 4.0, 3: None}
    assert {r["k"]: r["z"] for r in rasters.sample(p, ramp, "z", "k", "EPSG:6673", "bilinear").collect()} == {1: 0.0, 2: 3.5, 3: None}
    for crs in ("EPSG:3857", ""):
        with pytest.raises(settings.CrsError):
            rasters.sample(p, Raster(ramp.cells, geo.Grid(0, 0, 1, 1, 1, crs)), "z", "k", "EPSG:6673")
    with pytest.raises(settings.NoDataError):
        rasters.choose_surface("dsm", ramp, None)
    with pytest.raises(settings.ResourceError):
        rasters.point_cloud(ramp, None, ramp.grid, 10)
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    t = spark.createDataFrame([([{"x": x, "y": y} for x, y in ring],)], "ring array<struct<x: double, y: double>>")
    cut = t.select(rasters.clip_ring(F.col("ring"), (1, 1, 3, 9)).alias("r")).first()["r"]
    area = abs(sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(cut, cut[1:]))) / 2
    assert area == 6.0 and cut[0] == cut[-1] and t.select(F.size(rasters.clip_ring(F.col("ring"), (9, 9, 10, 10)))).first()[0] == 0


def test_fusion_of_a_scene(spark, tmp_path):
    grid = geo.Grid(0, 0, 10, 10, 1)
    dem = Raster(grid.cells(spark).select("row", "col", F.when(F.col("row") > 0, 100.0).alias("z")), grid)
    half = Raster(geo.Grid(0, 0, 10, 10, 5).cells(spark).select("row", "col", F.when(F.col("col") == 0, 1).otherwise(3).alias("image_class"), F.lit(0.9).alias("image_confidence")), geo.Grid(0, 0, 10, 10, 5))
    told, stat = fusion.build(fusion.Scene(dem, {"image_class": half}, {"on_road": grid.cells(spark).filter("row = 9").select("row", "col")}), str(tmp_path / "fused"))
    assert told.columns == list(fusion.COLUMNS) and told.count() == 90 and stat["cells"] == 90
    assert stat["rule_counts"] == {"image_building_no_height": 45, "image_vegetation_no_height": 45} and len(stat["skipped_conditions"]) == 3
    assert told.filter("on_road").count() == 10 and told.filter("object_height IS NULL AND red = 0").count() == 90
    with pytest.raises(settings.NoDataError):
        fusion.build(fusion.Scene(Raster(dem.cells.filter("row = 0"), grid)))
    with pytest.raises(settings.CrsError):
        fusion.frame(fusion.Scene(dem, {"x": Raster(half.cells, geo.Grid(0, 0, 10, 10, 5, "EPSG:3857"))}))
    part = api.summarize_subregion(dem.cells, grid, (0, 0, 5, 5), fused=fusion.frame(fusion.Scene(dem, {"image_class": half})))
    assert part["cells"] == 25 and part["z_mean"] == 100.0 and part["land_cover"]["building"] == 1.0
    with pytest.raises(settings.NoDataError):
        api.summarize_subregion(dem.cells, grid, (50, 50, 60, 60))
    api.write_raster(dem, str(tmp_path / "dem"))
    assert spark.read.parquet(str(tmp_path / "dem")).count() == 100 and settings.read_json(str(tmp_path / "dem.grid.json"))["resolution"] == 1
    with pytest.raises(settings.AlignmentError):
        api.write_raster(Raster(dem.cells.limit(5), grid), str(tmp_path / "no"))
    assert api.write_layers({"a": dem.cells}, str(tmp_path / "layers")) == {"a": "ok"}


def test_validation_suite(spark):
    cells = spark.range(400).selectExpr("cast(id div 20 as int) AS row", "cast(id % 20 as int) AS col", "id % 20 BETWEEN 4 AND 8 AND id div 20 BETWEEN 4 AND 8 AS p")
    cells = cells.withColumn("r", F.expr("col BETWEEN 6 AND 10 AND row BETWEEN 4 AND 8"))
    v1 = validation.registration(cells, "p", "r", 20, 20, 4.0)
    assert (v1.status, v1.figures["d_row"], v1.figures["d_col"], v1.figures["offset_m"]) == ("pass", 0, 2, 8.0)
    assert validation.registration(cells.withColumn("r", F.lit(False)), "p", "r", 20, 20, 4.0).status == "unavailable"
    v2 = validation.lattice({"a": geo.Grid(0, 0, 10, 10, 1), "b": geo.Grid(0.5, 0, 10, 10, 1)})
    v6 = validation.repeatable(lambda: cells.repartition(7), ["p"])
    assert v2.status == "fail" and v6.status == "pass"
    assert validation.cell_digest(cells, ["p"]) == validation.cell_digest(cells.repartition(3), ["p"]) != validation.cell_digest(cells, ["r"])
    seg = validation.labels_agree({"building": (cells, F.col("p"), F.col("r"))})
    assert seg.status == "fail" or seg.figures["building"]["recall"] == 0.6
    done = validation.run_all({"V2": lambda: v2, "SEG": lambda: seg}, only="v2")
    assert done == [v2] and validation.summarise([v2, v6])["failed"] == ["V2"]
    assert validation.to_markdown([validation.Result("X", "t", "pass", "a|b\nc")]).endswith("| **X** t | `pass` | a/b c |")
    t = spark.createDataFrame([(0.0001,), (-0.0002,), (None,)], "z double")
    one, inputs = validation.results_digest(t, ["z"], "f", {"a": 1})
    assert inputs["moments"]["z"] == {"count": 2, "mean": 0.0, "std": 0.0} and len(one) == 16 and one == validation.results_digest(t.repartition(2), ["z"], "f", {"a": 1})[0]


def test_learning_pieces(spark, tmp_path):
    rng = np.random.default_rng(0)
    pts = rng.random((64, 12))
    out = contrast.augment(pts, np.random.default_rng(1), jitter=0, dropout=0, colour=0, blank=1.0)
    assert out.shape == pts.shape and np.allclose(np.hypot(out[:, 0], out[:, 1]), np.hypot(pts[:, 0], pts[:, 1])) and (out[:, 3:] == 0).all() and np.allclose(out[:, 2], pts[:, 2])
    tiles = spark.createDataFrame([(i, rng.random((16, 3)).tolist()) for i in range(4)], "tile_id long, batch array<array<double>>")
    a, b = (sorted(map(str, contrast.views(t, 3).collect())) for t in (tiles, tiles.repartition(3)))
    assert a == b and len(a) == 8
    x = np.concatenate([rng.normal(0, 0.1, (20, 2)), rng.normal(5, 0.1, (20, 2))])
    rows_ = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "tile_id long, embedding array<double>")
    got = contrast.clusters(rows_, 2, starts=2)
    assert contrast.silhouette(got).first()["silhouette"] > 0.9
    truth = F.col("tile_id") >= 20
    assert contrast.adjusted_mutual_information(got, truth, F.col("label")) == pytest.approx(1.0)
    assert contrast.adjusted_mutual_information(got, F.lit(1), F.col("label")) is None
    mixed = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)] * 3, "a int, b int")
    assert contrast.adjusted_mutual_information(mixed, F.col("a"), F.col("b")) < 0.05
    contrast.write_embeddings(got, str(tmp_path / "e"), "xyz")
    assert spark.read.parquet(str(tmp_path / "e")).count() == 40


def test_settings(tmp_path):
    c = {"a": {"b": 1}, "t": "${NONE_SUCH:-x}"}
    path = tmp_path / "c.json"
    path.write_text(json.dumps(c))
    got = settings.load(str(path), ["a.c=[1, 2]", "n.m=true"])
    assert got == {"a": {"b": 1, "c": [1, 2]}, "t": "x", "n": {"m": True}}
    assert settings.fingerprint({"a": 1, "b": 2}) == settings.fingerprint({"b": 2, "a": 1}) and len(settings.fingerprint(c)) == 16
    with pytest.raises(settings.ConfigurationError):
        settings.with_overrides(c, ["no value"])
    assert settings.region_key("Mt. X/1", (135.0, 34.5), 1000) == "Mt._X_1_34.50000_135.00000_r1000"
    assert settings.stages() == settings.STAGE_ORDER and settings.stages(["gis", "gis", "lidar"]) == ["gis", "lidar"]
    with pytest.raises(settings.UnsupportedError):
        settings.stages(["nope"])

    def fail(run):
        raise settings.SourceError("down")

    done = api.analyze_region({"k": 1}, {"one": lambda r: 1, "two": fail, "three": lambda r: r.results["one"] + 1}, center=(135.2, 34.7), radius_m=100.0, overrides=["k=2"])
    assert done.summary()["stages"] == {"one": "ok", "two": "failed", "three": "ok"} and done.run.results["three"] == 2 and done.config == {"k": 2}
    assert api.payload("r", {"terrain": {"x": 1.23456}})["terrain"] == {"x": 1.2346} and "gis" in api.payload("r", {})["missing"]
