"""Mosaics, images, layers, windows, dispatch of sources, command line and reports."""

import json
import struct
import zlib

import pytest
from conftest import DATA, by_sql, rows
from pyspark.sql import functions as F

from cellweave import api, settings
from cellweave.functions import geo
from cellweave.operators import display, rasters
from cellweave.operators.rasters import Raster
from cellweave.plans import fusion, scenes
from cellweave.plans.queries import ORACLE_SQL, QUERIES
from cellweave.sources import imagery, readers


@pytest.mark.parametrize("name", [n for n, f in QUERIES.items() if f.__module__ == scenes.__name__])
def test_query_matches_sql(spark, name):
    got, want = rows(QUERIES[name](spark, DATA).toPandas()), rows(by_sql(ORACLE_SQL[name]))
    assert got == want and got


def png(path, pixels, grey):
    """A PNG of rows of (r, g, b), or of single values."""
    raw = b"".join(b"\0" + bytes(v if grey else 0 for v in r) if grey else b"\0" + bytes(b for v in r for b in v) for r in pixels)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", len(pixels[0]), len(pixels), 8, 0 if grey else 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images_become_pixels(spark, tmp_path):
    (tmp_path / "i").mkdir()
    png(tmp_path / "i" / "a.png", [[(1, 2, 3), (255, 128, 0)], [(0, 0, 0), (9, 8, 7)], [(4, 5, 6), (7, 7, 7)]], False)
    png(tmp_path / "i" / "b.png", [[5, 0]], True)
    t = imagery.with_validity(imagery.image_pixels(spark.read.format("image").load(str(tmp_path / "i"))))
    got = sorted((r.origin[-5], r.row, r.col, r.red, r.green, r.blue, r.valid) for r in t.collect())
    assert got == [
        ("a", 0, 0, 1, 2, 3, True), ("a", 0, 1, 255, 128, 0, True), ("a", 1, 0, 0, 0, 0, False), ("a", 1, 1, 9, 8, 7, True),
        ("a", 2, 0, 4, 5, 6, True), ("a", 2, 1, 7, 7, 7, True), ("b", 0, 0, 5, 5, 5, True), ("b", 0, 1, 0, 0, 0, False),
    ]


def test_mosaic_keeps_black_and_refuses_too_many(spark):
    t = spark.createDataFrame([(4, 7, r, c, 0) for r in range(2) for c in range(2)] + [(9, 9, 0, 0, 1)], "tile_x int, tile_y int, row int, col int, red int")
    got = {(r.row, r.col): (r.red, r.valid) for r in imagery.whole_mosaic(t, (4, 7, 5, 7), 2, ("red",), 0, 2).collect()}
    assert got == {(r, c): (0, c < 2) for r in range(2) for c in range(4)}
    assert imagery.mosaic_counts(t, (4, 7, 5, 7), 2).first()[:] == (2, 1)
    assert imagery.whole_mosaic(t.limit(0), (4, 7, 5, 7), 2, ("red",), 0, 2).filter("NOT valid").count() == 8
    with pytest.raises(settings.UnsupportedError):
        imagery.whole_mosaic(t, (4, 7, 6, 7), 2, ("red",), 0, 2)


def test_layers_are_cut_to_the_region(spark):
    x0, y0 = 82557.0, -140696.0
    box = (x0, y0, x0 + 100, y0 + 100)
    at = lambda x, y: dict(zip(("lon", "lat"), geo.from_transverse_mercator(x, y, geo.ZONES["EPSG:6673"][1], geo.ZONES["EPSG:6673"][0], m=__import__("math")), strict=True))
    ring = [at(x0 + a, y0 + b) for a, b in ((-50, 20), (50, 20), (50, 80), (-50, 80))]
    ways = [
        {"type": "way", "id": 1, "tags": {"building": "yes"}, "geometry": [*ring, ring[0]]},
        {"type": "way", "id": 2, "tags": {"highway": "path"}, "geometry": [at(x0 - 10, y0 + 50), at(x0 + 110, y0 + 50)]},
        {"type": "way", "id": 3, "tags": {"highway": "path"}, "geometry": [at(x0 - 10, y0 - 50), at(x0 + 110, y0 - 50)]},
    ]
    elements = readers.map_elements(spark.createDataFrame([(json.dumps({"elements": ways}),)], "value string"))
    got = {r.osm_id: [[(round(n.x - x0), round(n.y - y0)) for n in s] for s in r.shapes] for r in imagery.layer(elements, "EPSG:6673", box).collect()}
    assert set(got) == {"way/1", "way/2"} and got["way/2"] == [[(0, 50), (100, 50)]]
    assert set(got["way/1"][0]) == {(0, 20), (50, 20), (50, 80), (0, 80)}


def test_rasters_come_back_and_sources_are_chosen(spark, tmp_path):
    grid = geo.Grid(0, 0, 4, 3, 1)
    r = Raster(grid.cells(spark).select("row", "col", (F.col("row") * 10.0 + F.col("col")).alias("z")), grid)
    path = str(tmp_path / "dem")
    api.write_raster(r, path)
    back = imagery.read_raster(spark, path)
    assert back.grid == grid and {tuple(x) for x in imagery.read_window(back, (1, 0, 3, 2)).select("row", "col", "z").collect()} == {(i, j, i * 10.0 + j) for i in (1, 2) for j in (1, 2)}
    with pytest.raises(settings.ConfigurationError):
        imagery.read_raster(spark, str(tmp_path / "none"))
    made = {"gsi_tile": lambda s, g: Raster(r.cells, g), "local_raster": lambda s, g: Raster(r.cells, g)}
    assert imagery.elevation("dem", {}, grid, made, back)[1]["reused"]
    other = geo.Grid(0, 0, 8, 3, 1)
    assert imagery.elevation("dem", {"provider": "gsi_tile", "is_true_lidar": True}, other, made, back)[1] == {"kind": "dem", "provider": "gsi_tile", "reused": False, "is_true_lidar": False}
    assert imagery.elevation("dem", {"provider": "local_raster", "is_true_lidar": True}, grid, made, back, overwrite=True)[1]["is_true_lidar"]
    for bad, error in (({}, settings.ConfigurationError), ({"provider": "x"}, settings.UnsupportedError)):
        with pytest.raises(error):
            imagery.elevation("dsm", bad, grid, made)
    p = spark.createDataFrame([(i, 1.0, 2.0, 3.0, 257 * i, 0, 65535) for i in range(9)], "id int, x double, y double, z double, red int, green int, blue int")
    assert imagery.point_classes(p) is None and imagery.read_points(p, 4).count() == 4
    assert sorted(x.red for x in imagery.read_points(p).collect()) == list(range(9))


def test_windows_and_display_of_little(spark):
    out = spark.createDataFrame([(99.0, 99.0), (None, 1.0)], "x double, y double")
    grid = geo.Grid(0, 0, 4, 3, 1)
    assert rasters.point_window(out, grid).first()[:] == (None,) * 4
    assert rasters.in_window(grid.cells(spark), rasters.point_window(out, grid)).count() == 0
    p = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 9.0, 9.0, 0.0)], "id int, x double, y double, z double")
    assert [r.id for r in display.painters_order(display.oblique(p), "id").collect()] == [2, 1]
    none = spark.createDataFrame([(0, 0, None, 1.0)], "row int, col int, dsm double, z double")
    assert fusion.negative_fraction(none).first()[0] == 0.0 and fusion.terrain_layers(none, 1.0, dsm="dsm").first()["ndsm"] is None


def test_command_line_and_report(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"a": {"b": 1}}')
    config, given = settings.arguments(["--config", str(path), "--set", "a.b=2", "--overwrite", "terrain", "fusion"])
    assert config == {"a": {"b": 2}} and given.overwrite and given.stages == ["terrain", "fusion"]
    with pytest.raises(settings.ConfigurationError):
        settings.arguments(["--config", str(path), "--log-level", "loud"])
    assert settings.seeded(3).random() == settings.seeded(3).random() and settings.environment(spark)["parallelism"] > 0
    text = api.report_markdown("here", {"measured": ["one", "two"]}, "All well.")
    assert text.count("## ") == 5 and text.count(api.NONE_REPORTED) == 4 and "- one\n- two" in text
