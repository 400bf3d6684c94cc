"""Run configuration, catalog and database maps."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession


@dataclass
class Domain:
    name: str
    db_id: str
    sql_dump: str
    id_prefix: str
    target_count: int
    min_rows: int = 1


@dataclass
class Config:
    random_seed: int
    domains: list[Domain]
    provider: dict = field(default_factory=dict)
    generation: dict = field(default_factory=dict)
    output: dict = field(default_factory=dict)


def _required(d: dict, key: str):
    if key not in d:
        raise ValueError(f"missing required key: {key}")
    return d[key]


def load_config(path: str) -> Config:
    """Reads a JSON configuration; paths are relative to its folder; at least one domain is needed; an empty task cycle means ["user"]."""
    p = Path(path)
    raw = json.loads(p.read_text(encoding="utf-8"))
    if not raw.get("domains"):
        raise ValueError("at least one domain is needed")
    domains = []
    for d in raw["domains"]:
        name, dump = _required(d, "name"), Path(_required(d, "sql_dump"))
        domains.append(Domain(name, _required(d, "db_id"), str(dump if dump.is_absolute() else (p.parent / dump).resolve()), d.get("id_prefix", name[:3]), int(_required(d, "target_count")), int(d.get("min_rows", 1))))
    generation = dict(raw.get("generation", {}))
    generation["task_cycle"] = generation.get("task_cycle") or ["user"]
    return Config(int(raw.get("random_seed", 42)), domains, dict(raw.get("provider", {})), generation, dict(raw.get("output", {})))


def database_map(entries: list[str]) -> dict[str, str]:
    """["id=path", ...] -> {id: path}."""
    out = {}
    for e in entries:
        name, sign, path = e.partition("=")
        if not sign:
            raise ValueError(f"expected db_id=path: {e}")
        out[name.strip()] = path.strip()
    return out


def shard_folders(given: list[str] | None, root: str, pattern: str = "*") -> list[str]:
    """The folders given, else those below root that fit the pattern; an error where there are none."""
    found = [str(Path(x)) for x in given] if given else sorted(str(x) for x in Path(root).glob(pattern) if x.is_dir())
    if not found:
        raise FileNotFoundError(f"no shard folders below {root}")
    return found


def catalog(spark: SparkSession, names: list[str] | None = None) -> dict[str, list[str]]:
    """Tables and temporary views, by name, with their columns in declared order (all, or those of ``names``).  Names that are ``sqlite`` and at
    least one character more are the database's own."""
    own = re.compile(r"(?is)sqlite.")
    found = sorted(t.name for t in spark.catalog.listTables() if not own.match(t.name))
    return {n: spark.table(n).columns for n in found if names is None or n in names}
