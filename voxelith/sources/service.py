"""Volumes from a configuration: a source, then label map, axes and scale, always in that order."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from voxelith.functions.grid import xyz_box
from voxelith.operators import volume

from . import blocks, n5, slices, tables

SOURCES = ("block-store", "n5", "slice-files", "table")
DEFAULTS: dict[str, Any] = {
    "geometry": {"bounding-box": None, "block-width": 64, "available-scales": [0]},
    "apply-labelmap": None,
    "transpose": "zyx",
    "scale": 0,
    "value": "label",
}


def with_defaults(config: dict, defaults: dict | None = None) -> dict:
    """The configuration with what it leaves out filled in, at every depth."""
    out = dict(config)
    for key, value in (DEFAULTS if defaults is None else defaults).items():
        if key not in out:
            out[key] = value
        elif isinstance(value, dict) and isinstance(out[key], dict):
            out[key] = with_defaults(out[key], value)
    return out


def checked(config: dict) -> dict:
    out = with_defaults(config)
    kinds = [k for k in SOURCES if k in out]
    if len(kinds) != 1:
        raise ValueError(f"a volume names exactly one of {', '.join(SOURCES)}; this one has {kinds}")
    if sorted(out["transpose"].lower()) != ["x", "y", "z"]:
        raise ValueError("transpose is an order of z, y and x")
    box = out["geometry"]["bounding-box"]
    if box is not None and any(a >= b for a, b in zip(*box, strict=True)):
        raise ValueError("the bounding box is empty")
    return out


def dumped(config: dict) -> str:
    """The configuration with all defaults, as JSON in order of its keys: what a run was made with."""
    return json.dumps(checked(config), indent=2, sort_keys=True)


def resolved(config: dict, folder: str) -> dict:
    """Paths that are not absolute and name no store are taken from the configuration's own folder."""
    out = dict(config)
    for key in (*SOURCES, "apply-labelmap"):
        about = out.get(key)
        if about and "path" in about and "://" not in about["path"] and not about["path"].startswith("/"):
            out[key] = about | {"path": f"{folder.rstrip('/')}/{about['path']}"}
    return out


def load(spark: SparkSession, config: dict) -> DataFrame:
    """(z, y, x, value) of a configured volume. Boxes are [[x0, y0, z0], [x1, y1, z1]], in the source's own axes."""
    c = checked(config)
    kind = next(k for k in SOURCES if k in c)
    about, value = c[kind], c["value"]
    box = None if c["geometry"]["bounding-box"] is None else xyz_box(c["geometry"]["bounding-box"])
    native = max((s for s in c["geometry"]["available-scales"] if s <= c["scale"]), default=min(c["geometry"]["available-scales"]))
    # the box is given in full resolution
    scaled = None if box is None else (tuple(a >> native for a in box[0]), tuple(-(-a >> native) for a in box[1]))
    if kind == "block-store":
        if box is None:
            raise ValueError("a block store needs a bounding box")
        df = blocks.read(spark, about["path"], value, native, scaled, c["geometry"]["block-width"])
    elif kind == "n5":
        df = n5.read(spark, n5.at_scale(f"{about['path']}/{about['dataset']}", native), value, scaled)
    elif kind == "slice-files":
        native = 0
        df = slices.read_stack(spark, about["path"], value, *((box[0][0], box[1][0]) if box else (None, None)))
        df = df if box is None else volume.clip(df, box)
    else:
        native = 0
        df = spark.read.parquet(about["path"]).select("z", "y", "x", value)
        df = df if box is None else volume.clip(df, box)
    if c["apply-labelmap"]:
        pairs = tables.read_edges(spark, c["apply-labelmap"]["path"]).toDF("label", "body")
        df = volume.relabel(df, pairs, value)
    if c["transpose"] != "zyx":
        if box is None or any(box[0]):
            raise ValueError("axes are moved on volumes that begin at the origin, with a bounding box")
        df = volume.transpose(df, c["transpose"], scaled[1] if kind in ("block-store", "n5") else box[1])
    return volume.rescale(df, native, c["scale"], value).select("z", "y", "x", value)
