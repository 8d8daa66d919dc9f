"""Layered configuration documents: inheritance, substitution, redaction and a stable digest."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Mapping
from pathlib import Path
from typing import Any

_SECRET = re.compile(r"(token|secret|password|key)$", re.IGNORECASE)
_REFERENCE = re.compile(r"\$\{([^}]+)\}")


def merge(base: Any, over: Any) -> Any:
    """Maps are merged by key, anything else is replaced."""
    if isinstance(base, Mapping) and isinstance(over, Mapping):
        return {k: merge(base[k], over[k]) if k in base and k in over else over.get(k, base.get(k)) for k in {**base, **over}}
    return over


def load(path: str | Path, _above: tuple[Path, ...] = ()) -> dict:
    """A JSON or YAML document merged over the one it ``extends``; a cycle is an error."""
    path = Path(path).resolve()
    if path in _above:
        raise ValueError(f"documents extend each other: {[p.name for p in (*_above, path)]}")
    if path.suffix == ".json":
        own = json.loads(path.read_text())
    else:
        import yaml

        own = yaml.safe_load(path.read_text()) or {}
    parent = own.pop("extends", None)
    return merge(load(path.parent / parent, (*_above, path)), own) if parent else own


def resolve(document: dict, env: Mapping[str, str] | None = None) -> dict:
    """Replaces ``${env:NAME}`` and ``${a.b}``; a reference to itself or to nothing is an error."""
    env = os.environ if env is None else env

    def at(name: str) -> Any:
        value: Any = document
        for part in name.split("."):
            if not isinstance(value, Mapping) or part not in value:
                raise KeyError(f"{name} is not set")
            value = value[part]
        return value

    def fill(value: Any, open_: tuple[str, ...]) -> Any:
        if isinstance(value, Mapping):
            return {k: fill(v, open_) for k, v in value.items()}
        if isinstance(value, list):
            return [fill(v, open_) for v in value]
        if not isinstance(value, str):
            return value

        def one(name: str) -> Any:
            if name.startswith("env:"):
                if name[4:] not in env:
                    raise KeyError(f"{name[4:]} is not in the environment")
                return env[name[4:]]
            if name in open_:
                raise ValueError(f"{name} refers to itself")
            return fill(at(name), (*open_, name))

        whole = _REFERENCE.fullmatch(value)
        return one(whole[1]) if whole else _REFERENCE.sub(lambda m: str(one(m[1])), value)

    return fill(document, ())


def redact(value: Any, key: str = "") -> Any:
    """The document with secret values blanked."""
    if isinstance(value, Mapping):
        return {k: redact(v, k) for k, v in value.items()}
    if isinstance(value, list):
        return [redact(v, key) for v in value]
    return "***" if _SECRET.search(key) and value is not None else value


def digest(document: dict) -> str:
    return hashlib.sha256(json.dumps(redact(document), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def strict(settings: Mapping[str, Any], defaults: Mapping[str, Any]) -> dict:
    """Defaults with settings over them; unknown names are errors."""
    if unknown := sorted(set(settings) - set(defaults)):
        raise ValueError(f"unknown settings: {unknown}")
    return {**defaults, **settings}
