"""The validation suite: checks that give a status, the digest of results, their summary and report."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from . import stats

#: Metres of a block in the search for an offset, cells each way, blocks of tolerance, limits of recall.
BLOCK_M, MOST_SHIFT, TOLERANCE = 4.0, 5, 3
RECALL, RECALL_WARN = 0.6, 0.3
DECIMALS = 3


@dataclass
class Result:
    id: str
    title: str
    status: str
    detail: str
    figures: dict[str, Any] = field(default_factory=dict)


def registration(cells: DataFrame, predicted: str, reference: str, height: int, width: int, resolution: float) -> Result:
    """V1: predicted and mapped buildings lie in the same place, by the best shift of coarse blocks."""
    title = "imagery and map are in register"
    n = cells.agg(F.count_if(predicted).alias("p"), F.count_if(reference).alias("r")).first()
    if not n["p"] or not n["r"]:
        return Result("V1", title, "unavailable", "one of the masks is empty")
    factor = max(1, round(BLOCK_M / resolution))
    coarse = stats.block_majority(cells, predicted, factor, height, width).join(stats.block_majority(cells, reference, factor, height, width), ["row", "col"])
    best = stats.best_shift(coarse, predicted, reference, height // factor, width // factor, MOST_SHIFT).first()
    apart = math.hypot(best["d_row"], best["d_col"]) * resolution * factor
    figures = cells.agg(*stats.agreement(F.col(predicted), F.col(reference))).first().asDict()
    status = "pass" if apart <= TOLERANCE * resolution * factor else "fail"
    return Result("V1", title, status, f"offset {apart:.1f} m", {"offset_m": apart, "d_row": best["d_row"], "d_col": best["d_col"], **figures})


def lattice(grids: Mapping[str, geo.Grid]) -> Result:
    """V2: all rasters share a lattice."""
    title = "all rasters share a lattice"
    if len(grids) < 2:
        return Result("V2", title, "unavailable", "there are fewer than two rasters")
    problems = geo.lattice_problems(dict(grids))
    return Result("V2", title, "fail" if problems else "pass", "; ".join(problems) or f"{len(grids)} rasters", {"grids": len(grids)})


def cell_digest(cells: DataFrame, columns: list[str]) -> str:
    """A digest of the cells that neither their order nor their partitions change."""
    each = F.xxhash64("row", "col", *columns)
    got = cells.agg(F.count("*").alias("n"), F.bit_xor(each).alias("x"), F.bit_xor(F.xxhash64(each)).alias("y")).first()
    return hashlib.sha256(f"{got['n']}:{got['x']}:{got['y']}".encode()).hexdigest()[:16]


def repeatable(build: Callable[[], DataFrame], columns: list[str]) -> Result:
    """V6: the same cells come out twice."""
    one, two = cell_digest(build(), columns), cell_digest(build(), columns)
    return Result("V6", "results are repeatable", "pass" if one == two else "fail", f"{one}, {two}", {"digest": one})


def labels_agree(masks: Mapping[str, tuple[DataFrame, Column, Column]]) -> Result:
    """SEG: predicted classes against mapped ones; recall of buildings decides."""
    figures = {name: t.agg(*stats.agreement(p, r)).first().asDict() for name, (t, p, r) in masks.items()}
    recall = figures.get("building", {}).get("recall", 0.0)
    detail = "; ".join(f"{k}: IoU {v['iou']:.3f} recall {v['recall']:.3f} precision {v['precision']:.3f}" for k, v in figures.items()) or "no layers to compare"
    return Result("SEG", "segmentation agrees with the map", "pass" if recall > RECALL else "warn" if recall > RECALL_WARN else "fail", detail, figures)


def moments(df: DataFrame, names: list[str]) -> DataFrame:
    """name, count, mean and std of the known values of each column, rounded, without a negative zero."""
    tidy = lambda c: F.round(c, DECIMALS) + F.lit(0.0)
    of = lambda c: F.struct(F.lit(c).alias("name"), F.count(stats.finite(F.col(c))).alias("count"), tidy(F.avg(stats.finite(F.col(c).cast("double")))).alias("mean"), tidy(F.stddev_pop(stats.finite(F.col(c).cast("double")))).alias("std"))
    return df.agg(F.array(*map(of, names)).alias("m")).select(F.inline("m"))


def results_digest(df: DataFrame, names: list[str], fingerprint: str, grid: Mapping[str, Any]) -> tuple[str, dict[str, Any]]:
    """16 hex digits that are the same wherever the same configuration, grid and moments come out, and what was hashed."""
    told = {r["name"]: {"count": r["count"], "mean": r["mean"], "std": r["std"]} for r in moments(df, names).collect()}
    inputs = {"config_fingerprint": fingerprint, "grid": dict(grid), "moments": told}
    return hashlib.sha256(json.dumps(inputs, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16], inputs


def run_all(checks: Mapping[str, Callable[[], Result]], only: str | None = None) -> list[Result]:
    """The checks by id, or only one of them; the others don't run."""
    return [f() for name, f in checks.items() if only is None or only.lower() in (name.lower(), f.__name__.lower())]


def summarise(results: list[Result]) -> dict[str, Any]:
    counts = {s: sum(r.status == s for r in results) for s in dict.fromkeys(r.status for r in results)}
    return {"counts": counts, "failed": [r.id for r in results if r.status == "fail"], "checks": [vars(r) for r in results]}


def to_markdown(results: list[Result]) -> str:
    tidy = lambda s: s.replace("\n", " ").replace("|", "/")
    return "\n".join(["| check | status | detail |", "|---|---|---|", *[f"| **{r.id}** {r.title} | `{r.status}` | {tidy(r.detail)} |" for r in results]])
