"""`python -m voxelith`: a workflow by name on configured volumes.

    python -m voxelith -l                                    names of the workflows
    python -m voxelith -d create_pyramid                     its options with their defaults, as JSON (-y: as YAML)
    python -m voxelith -c run.yaml create_pyramid            runs it
    python -m voxelith -c run.yaml -v create_pyramid         prints the configuration with all defaults, and runs nothing

A configuration is JSON or YAML: {"input": a volume, "options": {...}, "tables": {"mapping": a Parquet table, ...}, "output": a folder}.
Each result becomes a Parquet table of the output folder. Paths that are not absolute begin at the configuration's folder.
"""

from __future__ import annotations

import argparse
import inspect
import json
import sys
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from voxelith.plans.workflows import WORKFLOWS
from voxelith.sources import service

try:
    import yaml
except ImportError:  # then configurations are JSON
    yaml = None


def options(name: str) -> dict[str, Any]:
    """The options of a workflow that a configuration can give, with their defaults; null for those that have none."""
    plain = (bool, int, float, str, list, tuple, type(None))
    own = list(inspect.signature(WORKFLOWS[name]).parameters.values())[1:]
    defaults = {p.name: None if p.default is p.empty else p.default for p in own if p.kind not in (p.VAR_KEYWORD, p.VAR_POSITIONAL) and p.name != "value"}
    return {k: v for k, v in defaults.items() if isinstance(v, plain)}


def loaded(path: str) -> dict:
    """A configuration with its paths resolved and its volume's defaults filled in."""
    text = Path(path).read_text(encoding="utf-8")
    if yaml is None and not path.endswith(".json"):
        raise SystemExit("there is no YAML here; use JSON")
    config = json.loads(text) if path.endswith(".json") else yaml.safe_load(text)
    if not isinstance(config, dict) or "input" not in config or "output" not in config:
        raise SystemExit("a configuration has an input and an output")
    folder = str(Path(path).resolve().parent)
    whole = lambda p: p if "://" in p or p.startswith("/") else f"{folder}/{p}"
    return {
        "input": service.checked(service.resolved(config["input"], folder)), "options": dict(config.get("options") or {}),
        "tables": {k: whole(v) for k, v in (config.get("tables") or {}).items()}, "output": whole(config["output"]),
    }


def shown(record: dict, as_yaml: bool) -> str:
    plain = json.loads(json.dumps(record))
    return yaml.safe_dump(plain, sort_keys=True) if as_yaml and yaml else json.dumps(plain, indent=2, sort_keys=True)


def run(spark: SparkSession, name: str, config: dict) -> list[str]:
    """The tables that the workflow wrote."""
    known = inspect.signature(WORKFLOWS[name]).parameters
    if unknown := sorted((set(config["options"]) | set(config["tables"])) - set(known) - {"value"}):
        raise SystemExit(f"{name} has no {', '.join(unknown)}; see -d {name}")
    given = {k: tuple(v) if isinstance(v, list) else v for k, v in config["options"].items()} | {k: spark.read.parquet(p) for k, p in config["tables"].items()}
    if "value" in known:
        given.setdefault("value", config["input"]["value"])
    frames = WORKFLOWS[name](service.load(spark, config["input"]), **given)
    for key, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{config['output']}/{key}")
    return sorted(frames)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="voxelith", description="Runs a workflow on configured volumes.")
    parser.add_argument("workflow", nargs="?", choices=sorted(WORKFLOWS))
    parser.add_argument("-c", "--config", help="JSON or YAML")
    parser.add_argument("-l", "--list", action="store_true", help="names of the workflows")
    parser.add_argument("-d", "--defaults", action="store_true", help="the workflow's options with their defaults")
    parser.add_argument("-v", "--verbose-config", action="store_true", help="the configuration with all defaults, without running")
    parser.add_argument("-y", "--yaml", action="store_true", help="print YAML instead of JSON")
    given = parser.parse_args(arguments)
    if given.list:
        print("\n".join(sorted(WORKFLOWS)))
        return 0
    if not given.workflow:
        parser.error("which workflow?")
    if given.defaults:
        print(shown(options(given.workflow), given.yaml))
        return 0
    if not given.config:
        parser.error("-c names a configuration")
    config = loaded(given.config)
    if given.verbose_config:
        config["options"] = options(given.workflow) | config["options"]
        print(shown(config, given.yaml))
        return 0
    print("\n".join(run(spark or SparkSession.builder.appName("voxelith").getOrCreate(), given.workflow, config)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
