"""A request: which layers, how to rename them, where base, versions and output are."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class LayerMap:
    rename_columns: dict[str, str] = field(default_factory=dict)
    drop_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Request:
    unit: str
    layers: tuple[str, ...]
    output_path: str
    column_map: dict[str, LayerMap]
    base_layer: dict[str, str]
    layer_version: str

    @classmethod
    def from_json(cls, text: str) -> Request:
        raw = json.loads(text)
        maps = {k: LayerMap(v.get("rename_columns", {}), tuple(v.get("drop_columns", ()))) for k, v in raw.get("column_map", {}).items()}
        return cls(raw["unit"], tuple(raw["layers"]), raw["output_path"], maps, raw["base_layer"], raw["layer_version"])
