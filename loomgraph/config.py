"""Settings by dotted path, with defaults; a driver-side value, never a DataFrame."""

from __future__ import annotations

import json
from copy import deepcopy
from typing import Any


class Config:
    def __init__(self, values: dict[str, Any] | None = None):
        self.values = deepcopy(values or {})

    @staticmethod
    def load(path: str) -> Config:
        with open(path, encoding="utf-8") as f:
            return Config(json.load(f))

    def get(self, path: str, default: Any = None) -> Any:
        at: Any = self.values
        for name in path.split("."):
            if not isinstance(at, dict) or name not in at:
                return default
            at = at[name]
        return default if at == "None" else at

    def updated(self, path: str, value: Any) -> Config:
        out = Config(self.values)
        *folders, last = path.split(".")
        at = out.values
        for name in folders:
            at = at.setdefault(name, {})
        at[last] = value
        return out

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(self.values, f, ensure_ascii=False, indent=2)

    def problems(self) -> list[str]:
        """Settings that will hurt."""
        out = []
        if not self.get("openai.api_key"):
            out.append("no API key is set")
        if (timeout := self.get("openai.timeout", 60)) < 10:
            out.append(f"a timeout of {timeout} s is short")
        if (size := self.get("chunk_splitter.max_chunk_size", 2000)) < 500:
            out.append(f"chunks of {size} tokens are small")
        return out
