"""Log configs: one JSON file per log type that declares topic, table and fields."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T

Config = Mapping

# The type names a config may use, and the section that older configs keep
# their table options in.
TYPES = {"string", "int", "integer", "long", "double", "timestamp", "date", "boolean"}
MAP_TYPE = re.compile(r"map<\s*(\w+)\s*,\s*(\w+)\s*>")
TABLE_SECTION = "iceberg"


def load_config(path: str | Path) -> Config:
    return json.loads(Path(path).read_text())


def config_files(folder: str | Path) -> list[Path]:
    """Files that are switched on by their name: those ending in ``.json``."""
    return sorted(Path(folder).glob("*.json"))


def enabled(cfg: Config) -> bool:
    return cfg.get(TABLE_SECTION, {}).get("enabled", True)


def schema_of(cfg: Config) -> T.StructType:
    """The declared fields as a Spark schema; an unknown type is an error."""
    return T.StructType([T.StructField(f["name"], _type(cfg, f)) for f in cfg["fields"]])


def _type(cfg: Config, field: Mapping) -> T.DataType:
    name = field["type"].strip().lower()
    as_map = MAP_TYPE.fullmatch(name)
    if not (name in TYPES or as_map and set(as_map.groups()) <= TYPES):
        raise ValueError(f"{cfg['name']}.{field['name']}: unknown type {field['type']}")
    return T.StructType.fromDDL(f"c {name}")["c"].dataType


def required_of(cfg: Config) -> list[str]:
    return [f["name"] for f in cfg["fields"] if f.get("required")]


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


@dataclass(frozen=True)
class Target:
    """Where the rows of a log type land."""

    database: str
    table: str
    partition_by: tuple[str, ...]
    sort_by: tuple[str, ...]
    retention_days: int | None

    @property
    def full_name(self) -> str:
        return quoted(self.database, self.table)


def target_of(cfg: Config, database: str = "analytics_logs") -> Target:
    """The config's table, its own database or ``database``; named after the log by default.

    Options may stand in the table section or, in newer configs, beside the name.
    """
    own, older = cfg.get("warehouse", {}), cfg.get(TABLE_SECTION, {})
    named, _, table = (own.get("table_name") or cfg["name"].lower()).rpartition(".")
    return Target(
        named or database, table, tuple(older.get("partition_fields") or own.get("partition_by", ())),
        tuple(older.get("sort_fields") or own.get("sort_by", ())), own.get("retention_days"),
    )


def table_of(cfg: Config) -> str:
    return target_of(cfg).table


def topic_of(cfg: Config) -> str:
    return cfg["kafka"]["topic"]


def partition_of(cfg: Config) -> list[str]:
    return list(target_of(cfg).partition_by)


def sort_of(cfg: Config) -> list[str]:
    return list(target_of(cfg).sort_by)


def retention_of(cfg: Config) -> int | None:
    return target_of(cfg).retention_days
