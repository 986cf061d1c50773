"""M2: the logger spec (name, topic, events, schema, filters, destination).

A plain dataclass read on the driver from a dict or YAML; camelCase keys as
in the custom resource, unknown keys refused.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


class SpecError(ValueError):
    pass


_TOP_KEYS = {"name", "topic", "events", "schema", "filters", "destination"}
_FILTER_KEYS = {"modelName", "modelVersion"}


@dataclass
class Component:
    type: str
    config: dict[str, Any] = field(default_factory=dict)

    @staticmethod
    def parse(d: Any, what: str) -> "Component":
        if not isinstance(d, dict) or "type" not in d:
            raise SpecError(f"{what}: needs a 'type'")
        extra = set(d) - {"type", "config"}
        if extra:
            raise SpecError(f"{what}: unknown keys {sorted(extra)}")
        return Component(str(d["type"]), dict(d.get("config") or {}))


@dataclass
class LoggerSpec:
    name: str
    topic: str
    events: Component
    destination: Component
    schema: Component | None = None
    filters: dict[str, str] | None = None

    @staticmethod
    def from_dict(d: dict[str, Any]) -> "LoggerSpec":
        if "spec" in d and "metadata" in d:          # a whole custom resource
            d = {"name": d["metadata"]["name"], **d["spec"]}
        extra = set(d) - _TOP_KEYS
        if extra:
            raise SpecError(f"unknown keys {sorted(extra)}")
        for k in ("name", "topic", "events", "destination"):
            if k not in d or d[k] is None:
                raise SpecError(f"missing '{k}'")     # B16: events is required
        filters = d.get("filters")
        if filters is not None:
            bad = set(filters) - _FILTER_KEYS
            if bad:
                raise SpecError(f"filters: unknown keys {sorted(bad)}")
        spec = LoggerSpec(
            name=str(d["name"]), topic=str(d["topic"]),
            events=Component.parse(d["events"], "events"),
            destination=Component.parse(d["destination"], "destination"),
            schema=Component.parse(d["schema"], "schema") if d.get("schema") else None,
            filters=dict(filters) if filters else None,
        )
        names = spec.column_names()
        for side in ("inputs", "outputs"):
            ns = names.get(side)
            if ns is not None and len(set(ns)) != len(ns):
                raise SpecError(f"columnNames.{side}: repeated names")
        return spec

    @staticmethod
    def from_yaml(text: str) -> list["LoggerSpec"]:
        import yaml
        return [LoggerSpec.from_dict(doc) for doc in yaml.safe_load_all(text) if doc]

    def column_names(self) -> dict[str, list[str] | None]:
        cfg = (self.schema.config if self.schema else {}) or {}
        cn = cfg.get("columnNames") or {}
        return {"inputs": cn.get("inputs"), "outputs": cn.get("outputs")}

    @property
    def subject(self) -> str:
        """One schema subject per logger."""
        return f"{self.name}-value"
