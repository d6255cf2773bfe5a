"""Data contract: entries, properties, type names and the read schema they imply.

A contract is small configuration (a handful of entries with tens of
properties), so it lives on the driver as frozen dataclasses. Everything that
touches rows is a DataFrame expression built from it elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# The contract's physical type names and the Spark type of each.
# Any other name (including a missing one) means string.
PHYSICAL_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
}

# Opt-in names (``extended_types=True``); by default these fall back to string.
EXTENDED_TYPES: dict[str, T.DataType] = {
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
    "decimal": T.DecimalType(38, 18),
}

FEATURE_ROOT = "feature"


class ContractError(ValueError):
    """A contract entry or property that cannot be used; names the culprit."""


@dataclass(frozen=True)
class Property:
    name: str
    source_path: str | None = None
    physical_type: str | None = None

    def spark_type(self, extended_types: bool = False) -> T.DataType:
        name = (self.physical_type or "string").strip().lower()
        if name in PHYSICAL_TYPES:
            return PHYSICAL_TYPES[name]
        if extended_types and name in EXTENDED_TYPES:
            return EXTENDED_TYPES[name]
        return T.StringType()

    def is_known_type(self, extended_types: bool = False) -> bool:
        name = (self.physical_type or "string").strip().lower()
        return name in PHYSICAL_TYPES or (extended_types and name in EXTENDED_TYPES)


@dataclass(frozen=True)
class Entry:
    name: str
    key: str
    properties: tuple[Property, ...]
    source: str | None = None
    table_name: str | None = None
    folder: str | None = None
    volume: str | None = None
    sequence_by: str | None = None
    #: Columns whose change opens a version (None: all), the condition of a
    #: tombstone, and whether fractions are cut for integer properties.
    track: tuple[str, ...] | None = None
    delete_when: str | None = None
    truncate: bool = False

    @property
    def property_names(self) -> list[str]:
        return [p.name for p in self.properties]


@dataclass(frozen=True)
class Contract:
    entries: tuple[Entry, ...]
    servers: dict[str, Any] = field(default_factory=dict)

    def entry(self, name: str) -> Entry:
        for e in self.entries:
            if e.name == name:
                return e
        raise ContractError(f"no contract entry named {name!r}")

    def server(self, name: str = "development") -> dict[str, Any]:
        return dict((self.servers or {}).get(name) or {})


def _property(raw: dict[str, Any], entry_name: str) -> Property:
    if not isinstance(raw, dict) or not raw.get("name"):
        raise ContractError(f"entry {entry_name!r}: property without a name: {raw!r}")
    return Property(name=str(raw["name"]),
                    source_path=raw.get("sourcePath") or None,
                    physical_type=raw.get("physicalType"))


def contract_from_dict(doc: dict[str, Any]) -> Contract:
    """Build a contract from the parsed YAML document (``schema`` + ``servers``)."""
    entries = []
    for item in doc.get("schema") or []:
        name = item.get("name")
        if not name:
            raise ContractError(f"schema entry without a name: {item!r}")
        if not item.get("key"):
            raise ContractError(f"entry {name!r} has no key")
        props = tuple(_property(p, name) for p in item.get("properties") or [])
        entries.append(Entry(name=name, key=item["key"], properties=props,
                             source=item.get("source"), table_name=item.get("table_name"),
                             folder=item.get("folder"), volume=item.get("volume"),
                             sequence_by=item.get("sequence_by"),
                             track=tuple(item["track"]) if item.get("track") else None,
                             delete_when=item.get("delete_when"), truncate=bool(item.get("truncate"))))
    return Contract(entries=tuple(entries), servers=dict(doc.get("servers") or {}))


def load_contract(text: str | None = None, path: str | None = None, spark=None) -> Contract:
    """Parse a contract from YAML text, a local path, or (with ``spark``) any
    Hadoop-readable path. The file is configuration, a few kilobytes."""
    import yaml

    if text is None:
        if path is None:
            raise ContractError("give the contract text or its path")
        if spark is not None:
            rows = spark.read.text(path, wholetext=True).collect()
            if not rows:
                raise ContractError(f"contract file {path!r} is empty or missing")
            text = rows[0][0]
        else:
            with open(path, encoding="utf-8") as fh:
                text = fh.read()
    doc = yaml.safe_load(text) or {}
    if not isinstance(doc, dict):
        raise ContractError("contract YAML must be a mapping")
    return contract_from_dict(doc)


# --------------------------------------------------------------------------
# Read schema derived from the contract (every leaf read as string)
# --------------------------------------------------------------------------

def _insert(tree: dict, parts: list[str]) -> None:
    node = tree
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        child = node.get(part)
        if last:
            # A leaf asked for directly: read it as JSON text, even if another
            # property asks for one of its children (taken by JSON path later).
            node[part] = "leaf"
        elif child == "leaf":
            return  # parent is already read as text
        else:
            node = node.setdefault(part, {})


def _to_struct(tree: dict) -> T.StructType:
    fields = []
    for name, child in tree.items():
        dtype = T.StringType() if child == "leaf" else _to_struct(child)
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def read_schema(properties: tuple[Property, ...] | list[Property],
                features_col: str = "features", root: str = FEATURE_ROOT,
                extra_paths: tuple[str, ...] = (), feature_lines: bool = False) -> T.StructType:
    """JSON read schema covering exactly the paths the contract names.

    ``feature.a.b`` becomes ``features: array<struct<a: struct<b: string>>>``;
    a path without the ``feature.`` root is a top-level field. Leaves are
    strings so that a bad value survives parsing and can be quarantined, and
    the JSON parser skips every field the contract does not name.

    ``feature_lines=True`` is the schema of one Feature per line (GeoJSON text
    sequence): the feature's own fields at the top level.
    """
    feature_tree: dict = {}
    top_tree: dict = {}
    paths = [p.source_path for p in properties if p.source_path] + list(extra_paths)
    for path in paths:
        parts = path.split(".")
        if parts[0] == root and len(parts) > 1:
            _insert(feature_tree, parts[1:])
        else:
            _insert(top_tree, parts)
    if feature_lines:
        return _to_struct(feature_tree)
    fields = [T.StructField(features_col, T.ArrayType(_to_struct(feature_tree), True), True)]
    fields += list(_to_struct(top_tree).fields)
    return T.StructType(fields)
