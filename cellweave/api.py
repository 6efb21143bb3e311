"""Entry points for a region: run its stages, look at a part of it, write rasters and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import settings
from .functions import geo
from .operators.rasters import Raster
from .plans import fusion
from .settings import AlignmentError

#: Sections of a report.
SECTIONS = ["terrain", "fusion", "segmentation", "pointcloud", "gis", "pointcloud_ml", "validation"]


class Analysis:
    """A region's run: its configuration, key, stages' outcomes and results."""

    def __init__(self, config: Mapping[str, Any], region: geo.Region, key: str, run: settings.Run):
        self.config, self.region, self.key, self.run = config, region, key, run

    def summary(self) -> dict[str, Any]:
        out = {"key": self.key, "crs": self.region.crs, "bounds": list(self.region.bounds), "fingerprint": settings.fingerprint(self.config)}
        return out | {"stages": {o.stage: o.status for o in self.run.outcomes}, "failed": [o.stage for o in self.run.outcomes if o.status == "failed"]}


def analyze_region(config: Mapping[str, Any], functions: Mapping[str, Callable[[settings.Run], Any]], *, center: tuple[float, float] | None = None,
                   radius_m: float | None = None, box: geo.Box | None = None, name: str = "roi", overrides: Sequence[str] = (), stages: Sequence[str] = ()) -> Analysis:
    """Runs the stages for a circle's square or a box in degrees. Failed stages are recorded, the others run."""
    key = settings.region_key(name, center, radius_m, box)
    region = geo.Region.around(*center, radius_m) if center is not None else geo.Region.of_box(box)
    run = settings.Run(functions)
    run.results |= {"region": region, "config": settings.with_overrides(config, overrides)}
    run.go(stages)
    return Analysis(run.results["config"], region, key, run)


def summarize_subregion(cells: DataFrame, grid: geo.Grid, box: geo.Box, *, geographic: bool = False, fused: DataFrame | None = None) -> dict[str, Any]:
    """Figures of a part of the grid, with its land cover where fused cells are given."""
    from .operators import rules, stats

    out = fusion.subregion(cells, grid, box, geographic).first().asDict()
    if fused is not None:
        r0, r1, c0, c1 = grid.window(geo.transform_bounds(box, geo.GEOGRAPHIC, grid.crs) if geographic else box)
        part = fused.filter(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
        out["land_cover"] = {r["class_name"]: r["fraction"] for r in stats.shares(part, "fused_class", rules.FUSED).collect()}
    return settings.rounded(out)


def payload(key: str, sections: Mapping[str, Any]) -> dict[str, Any]:
    """What the stages told, rounded, with the sections that are missing."""
    return settings.rounded({"key": key, **{s: sections[s] for s in SECTIONS if s in sections}, "missing": [s for s in SECTIONS if s not in sections]})


def write_raster(raster: Raster, path: str, block: int = 256) -> None:
    """A raster's cells, one row group for neighbouring blocks; every cell of the grid must be there once."""
    n = raster.cells.agg(F.count("*").alias("n"), F.countDistinct("row", "col").alias("u")).first()
    if n["n"] != raster.grid.width * raster.grid.height or n["u"] != n["n"]:
        raise AlignmentError(f"{n['n']} cells ({n['u']} different) are not the grid's {raster.grid.width} x {raster.grid.height}")
    blocks = [F.expr(f"{c} div {block}").alias(f"block_{c}") for c in ("row", "col")]
    t = raster.cells.select("*", *blocks).repartitionByRange("block_row", "block_col").sortWithinPartitions("block_row", "block_col", "row", "col")
    t.drop("block_row", "block_col").write.mode("overwrite").option("compression", "zstd").parquet(path)
    settings.write_json(f"{path.rstrip('/')}.grid.json", vars(raster.grid)) if "://" not in path else None


def write_points(points: DataFrame, path: str) -> None:
    """A point table as LAS readers expect its values: colours in 16 bits, classes of 0 to 31, millimetres."""
    made = {c: (F.col(c).cast("int") * 257).alias(c) for c in ("red", "green", "blue") if c in points.columns}
    made |= {c: F.round(F.col(c), 3) for c in ("x", "y", "z")}
    if "classification" in points.columns:
        made["classification"] = F.least(F.greatest(F.col("classification"), F.lit(0)), F.lit(31)).cast("short")
    points.withColumns(made).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_layers(layers: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """One table for each map layer. A layer that fails is told with its reason, the others are written."""
    out = {}
    for name, layer in layers.items():
        try:
            layer.write.mode("overwrite").option("compression", "zstd").parquet(f"{root.rstrip('/')}/{name}")
            out[name] = "ok"
        except Exception as e:  # a source may fail in any way; what it was is kept
            out[name] = f"failed: {str(e).splitlines()[0][:200]}"
    return out


#: A report's sections in order, and what an empty one says.
REPORT = {
    "measured": "Measured (computed by the pipeline)",
    "observed": "Observed (visual interpretation)",
    "inferred": "Inferred (model reasoning)",
    "uncertain": "Uncertain / limitations",
    "recommended_checks": "Recommended checks",
}
NONE_REPORTED = "(none reported)"


def report_markdown(title: str, parts: Mapping[str, Sequence[str]], summary: str = "", by: str = "") -> str:
    """A report of the five sections; those that are not given say so."""
    blocks = [f"# {title}", summary]
    blocks += [f"## {head}\n" + "\n".join(f"- {item}" for item in parts.get(key) or [NONE_REPORTED]) for key, head in REPORT.items()]
    blocks.append(f"_Written by {by}; figures come from the pipeline._" if by else "")
    return "\n\n".join(b for b in blocks if b) + "\n"
