"""Configuration, keys and stages of a run, and the errors that the library raises."""

from __future__ import annotations

import argparse
import hashlib
import json
import logging
import os
import platform
import random
import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any


class SpatialError(Exception):
    """Any error that the library raises on purpose."""


class ConfigurationError(SpatialError):
    """A setting is missing, malformed or contradicts another."""


class UnsupportedError(SpatialError):
    """The input is of a kind that is not handled."""


class SourceError(SpatialError):
    """A source failed, in another way than having nothing."""


class NoDataError(SpatialError):
    """The source works but has nothing for the region."""


class CrsError(SpatialError):
    """A coordinate system is missing, unknown or another one."""


class AlignmentError(SpatialError):
    """Rasters or points do not share a grid."""


class ResourceError(SpatialError):
    """Memory does not suffice even after what could be done."""


class StageError(SpatialError):
    """A stage of a run failed."""


def scalar(text: str) -> Any:
    """A number, boolean, null, list or object as JSON has it, or the text itself."""
    named = {"true": True, "false": False, "null": None, "~": None, "": None}
    if text.strip().lower() in named:
        return named[text.strip().lower()]
    try:
        return json.loads(text)
    except ValueError:
        return text


def with_overrides(data: Mapping[str, Any], overrides: Sequence[str] = ()) -> dict[str, Any]:
    """A copy with each `dotted.key=value` set; what stands in the way of a key becomes a section."""
    out = json.loads(json.dumps(data))
    for item in overrides:
        dotted, found, value = item.partition("=")
        if not found:
            raise ConfigurationError(f"an override is dotted.key=value, not {item!r}")
        *path, last = dotted.strip().split(".")
        at = out
        for key in path:
            if not isinstance(at.get(key), dict):
                at[key] = {}
            at = at[key]
        at[last] = scalar(value.strip())
    return out


def expanded(node: Any, env: Mapping[str, str] = os.environ) -> Any:
    """${NAME} and ${NAME:-default} in strings replaced, an unset name without default by nothing."""
    if isinstance(node, str):
        return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", lambda m: env.get(m[1], m[2] or ""), node)
    if isinstance(node, dict):
        return {k: expanded(v, env) for k, v in node.items()}
    return [expanded(v, env) for v in node] if isinstance(node, list) else node


def load(path: str, overrides: Sequence[str] = ()) -> dict[str, Any]:
    """A JSON configuration with overrides and environment applied."""
    try:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
    except (OSError, ValueError) as e:
        raise ConfigurationError(f"{path}: {e}") from e
    if not isinstance(data, dict):
        raise ConfigurationError(f"{path} holds no object")
    return expanded(with_overrides(data, overrides))


def fingerprint(config: Mapping[str, Any]) -> str:
    """16 hex digits that tell configurations apart, whatever the order of their keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def region_key(name: str, center: tuple[float, float] | None = None, radius_m: float | None = None, box: Sequence[float] | None = None) -> str:
    """A name for a region's folders: safe letters, then centre (lon, lat) and radius or the box."""
    safe = re.sub(r"[^0-9A-Za-z_.-]+", "_", name).strip("_") or "roi"
    if center is not None:
        return f"{safe}_{center[1]:.5f}_{center[0]:.5f}_r{radius_m:g}"
    if box is None:
        raise ConfigurationError("a region has a centre and radius, or a box")
    return f"{safe}_bbox_" + "_".join(f"{v:.5f}" for v in box)


@dataclass(frozen=True)
class Paths:
    """Where a region's tables lie."""

    root: str
    key: str

    def table(self, kind: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}/{self.key}/{name}"


#: The order of a whole run.
STAGE_ORDER = ["lidar", "imagery", "gis", "pointcloud", "terrain", "segmentation", "fusion", "pointcloud_ml", "vlm", "llm", "validate", "report"]


def stages(requested: Sequence[str] = (), known: Sequence[str] = STAGE_ORDER) -> list[str]:
    """The stages to run, each once, where it is first named; `all`, or nothing, is the whole order."""
    wanted: list[str] = []
    for name in requested or ["all"]:
        if name != "all" and name not in known:
            raise UnsupportedError(f"unknown stage {name!r}; there are {', '.join(known)}")
        wanted += known if name == "all" else [name]
    return list(dict.fromkeys(wanted))


@dataclass
class Outcome:
    stage: str
    status: str
    seconds: float
    error: str | None = None


@dataclass
class Run:
    """Stages as functions of this run; each sees the results of those before it."""

    functions: Mapping[str, Callable[[Run], Any]]
    results: dict[str, Any] = field(default_factory=dict)
    outcomes: list[Outcome] = field(default_factory=list)

    def go(self, requested: Sequence[str] = (), stop_on_error: bool = False) -> list[Outcome]:
        """Runs the stages in turn. A failure is recorded and, unless asked otherwise, the next stage runs."""
        for name in stages(requested, list(self.functions)):
            began = time.time()
            try:
                self.results[name] = self.functions[name](self)
                self.outcomes.append(Outcome(name, "ok", time.time() - began))
            except SpatialError as e:
                self.outcomes.append(Outcome(name, "failed", time.time() - began, str(e)))
                if stop_on_error:
                    break
        return self.outcomes


def rounded(value: Any, digits: int = 4) -> Any:
    """Floats rounded wherever they stand in lists and objects; NaN and infinite ones are null."""
    if isinstance(value, float):
        return round(value, digits) if value - value == 0 else None
    if isinstance(value, Mapping):
        return {k: rounded(v, digits) for k, v in value.items()}
    return [rounded(v, digits) for v in value] if isinstance(value, (list, tuple)) else value


def write_json(path: str, value: Any) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)


def read_json(path: str) -> Any:
    """The document, or None if there is none that can be read."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return None


def arguments(argv: Sequence[str] | None = None) -> tuple[dict[str, Any], argparse.Namespace]:
    """A command line's configuration, with what it overrides, and the other arguments."""
    p = argparse.ArgumentParser(prog="cellweave")
    p.add_argument("--config", required=True, help="JSON configuration")
    p.add_argument("--set", action="append", default=[], metavar="KEY=VALUE", help="override a value, keys joined by dots")
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--overwrite", action="store_true", help="make again what is already there")
    p.add_argument("stages", nargs="*", help="stages to run; none means all")
    given = p.parse_args(argv)
    level = logging.getLevelName(given.log_level.upper())
    if not isinstance(level, int):
        raise ConfigurationError(f"unknown log level {given.log_level!r}")
    logging.getLogger("cellweave").setLevel(level)
    return load(given.config, given.set), given


def seeded(seed: int) -> random.Random:
    """Random numbers of a run's own, the same for the same seed."""
    return random.Random(seed)


def environment(spark: Any = None) -> dict[str, Any]:
    """What a run's record says about where it ran."""
    out = {"python": platform.python_version(), "system": platform.system(), "machine": platform.machine(), "cpus": os.cpu_count()}
    return out if spark is None else out | {"spark": spark.version, "parallelism": spark.sparkContext.defaultParallelism}
