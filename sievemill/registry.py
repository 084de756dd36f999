"""Schema registry: configuration in, Spark types and column lists out."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from sievemill import registry_values as defaults

SPARK_TYPES = {
    "VARCHAR": T.StringType(),
    "DATE": T.DateType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    db_type: str = "VARCHAR"
    aliases: tuple[str, ...] = ()
    clean: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.db_type not in SPARK_TYPES:
            raise ValueError(f"column {self.name!r}: unknown type {self.db_type!r}, use one of {sorted(SPARK_TYPES)}")


@dataclass(frozen=True)
class SchemaSpec:
    name: str
    table: str
    columns: tuple[ColumnSpec, ...] = ()
    keywords: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    source_tag: str = defaults.UNKNOWN_SOURCE_TAG

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, SPARK_TYPES[c.db_type]) for c in self.columns])

    def header_names(self) -> dict[str, list[str]]:
        """Canonical column -> lower-cased header names that fill it, the canonical name first.

        An alias claimed by two columns belongs to the one declared last.
        """
        owner = {alias.lower(): c.name for c in self.columns for alias in c.aliases}
        names: dict[str, list[str]] = {}
        for c in self.columns:
            mine = [c.name] if owner.get(c.name, c.name) == c.name else []
            mine += [a.lower() for a in c.aliases if owner[a.lower()] == c.name and a.lower() != c.name]
            names[c.name] = mine
        return names


@dataclass(frozen=True)
class Registry:
    schemas: dict[str, SchemaSpec]
    fallback: str | None = defaults.FALLBACK_SCHEMA
    quarantine: str = defaults.QUARANTINE_SCHEMA
    rules: dict[str, dict[str, dict]] = field(default_factory=dict)

    @property
    def data_schemas(self) -> list[SchemaSpec]:
        """Schemas that files can have, in configuration order."""
        return [s for n, s in self.schemas.items() if n != self.quarantine]

    @property
    def text_columns(self) -> list[str]:
        """Union of the declared columns of all data schemas, in first-seen order."""
        return list(dict.fromkeys(c for s in self.data_schemas for c in s.column_names))

    @property
    def table_names(self) -> list[str]:
        return list(dict.fromkeys(s.table for s in self.schemas.values()))

    def fallback_name(self) -> str | None:
        return self.fallback if self.fallback in self.schemas else None


def build_registry(
    schemas: Mapping[str, Mapping] | None = None,
    rules: Mapping[str, Mapping] | None = None,
    fallback: str | None = defaults.FALLBACK_SCHEMA,
) -> Registry:
    """Registry from dictionaries shaped like :data:`sievemill.registry_values.SCHEMAS` (the default)."""
    schemas = defaults.SCHEMAS if schemas is None else schemas
    rules = defaults.VALIDATION_RULES if rules is None else rules
    shipped_tags = {n: s["source_tag"] for n, s in defaults.SCHEMAS.items() if "source_tag" in s}
    specs = {}
    for name, d in schemas.items():
        columns = []
        for col_name, c in (d.get("columns_map") or {}).items():
            # Volume is the one column cleaned by default; any column may ask for it with "clean".
            shipped = defaults.SCHEMAS["default_daily"]["columns_map"]["volume"]["clean"] if col_name == "volume" else []
            is_data = name != defaults.QUARANTINE_SCHEMA
            columns.append(
                ColumnSpec(
                    col_name,
                    c.get("db_type", "VARCHAR"),
                    tuple(c.get("aliases", ())),
                    tuple(c.get("clean", shipped if is_data else ())),
                )
            )
        specs[name] = SchemaSpec(
            name=name,
            table=d.get("db_table_name") or name,
            columns=tuple(columns),
            keywords=tuple(d.get("keywords", ())),
            required=tuple(d.get("required_columns", ())),
            primary_key=tuple(d.get("primary_key", ())),
            unique_key=tuple(d.get("unique_key", ())),
            source_tag=d.get("source_tag", shipped_tags.get(name, defaults.UNKNOWN_SOURCE_TAG)),
        )
    return Registry(specs, fallback, rules={k: dict(v) for k, v in rules.items()})


def load_registry(schemas_json: str | None = None, rules_file: str | None = None, **kwargs) -> Registry:
    """Registry from a schema JSON file and a JSON or YAML file holding ``validation_rules``."""
    schemas = rules = None
    if schemas_json:
        with open(schemas_json, encoding="utf-8") as f:
            schemas = json.load(f)
    if rules_file:
        with open(rules_file, encoding="utf-8") as f:
            if rules_file.endswith((".yaml", ".yml")):
                try:
                    import yaml
                except ImportError as e:
                    raise RuntimeError("reading rules from YAML needs PyYAML; use JSON instead") from e
                config = yaml.safe_load(f)
            else:
                config = json.load(f)
        rules = (config or {}).get("validation_rules") or {}
    return build_registry(schemas, rules, **kwargs)
