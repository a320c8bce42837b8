"""The runtime config document: published whole or by appending rules, versioned, read by pollers."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from ..functions.rules import compile_rules
from .store import Conflict, Store

RESERVED = ("_id", "version")


class ConfigError(ValueError):
    pass


def union_rules(stored: list[str], fresh: list[str]) -> list[str]:
    """Stored rules as they are, then the new ones that aren't among them."""
    return [*stored, *(r for i, r in enumerate(fresh) if r not in stored and r not in fresh[:i])]


def validate_filter(tree: Any) -> None:
    """Rules of a filter subtree, by a dry run of the compiler."""
    from pyspark.sql import functions as F

    if not isinstance(tree, dict):
        raise ConfigError("filter must be an object")
    for side, rules in tree.items():
        if side not in ("include", "exclude") or not isinstance(rules, list) or not all(isinstance(r, str) for r in rules):
            raise ConfigError(f"filter.{side} must be a list of strings")
        compile_rules(rules, side, F.col("doc"))


class Registry:
    """Subtrees that a config document may have: what checks each, and what puts it in force."""

    def __init__(self) -> None:
        self.checks: dict[str, Callable[[Any], None]] = {"filter": validate_filter}
        self.appliers: dict[str, Callable[[Any], None]] = {}

    def register(self, name: str, check: Callable[[Any], None], apply: Callable[[Any], None]) -> None:
        self.checks[name], self.appliers[name] = check, apply

    def validate(self, doc: dict[str, Any]) -> dict[str, Any]:
        """The document without its own fields; ConfigError or RuleError if it isn't well formed."""
        body = {k: v for k, v in doc.items() if k not in RESERVED}
        if not body:
            raise ConfigError("the config document is empty")
        for name, tree in body.items():
            if name not in self.checks:
                raise ConfigError(f"unknown subtree {name}")
            self.checks[name](tree)
        return body

    def apply(self, doc: dict[str, Any]) -> None:
        """Put all subtrees in force; one that the document lacks is applied as empty."""
        for name, put in self.appliers.items():
            put(doc.get(name) or {})


def merge(stored: dict[str, Any], delta: dict[str, Any]) -> dict[str, Any]:
    out = {k: v for k, v in stored.items() if k not in RESERVED}
    for k, v in delta.items():
        if k in RESERVED:
            continue
        if k == "filter" and isinstance(out.get(k), dict) and isinstance(v, dict):
            sides = {s: union_rules(out[k].get(s, []), v[s]) for s in ("include", "exclude") if s in v}
            out[k] = {**out[k], **sides}
        else:
            out[k] = v
    return out


def version_of(doc: dict[str, Any] | None) -> int:
    try:
        return int((doc or {}).get("version", 0))
    except (TypeError, ValueError):
        return 0


class ConfigStore:
    """One JSON document in the store's file system; a version is written once, under its own name."""

    def __init__(self, spark, root: str, registry: Registry | None = None) -> None:
        self.store, self.registry = Store(spark, root), registry or Registry()

    def _names(self) -> list[str]:
        return sorted(n for n in self.store.list("_config") if n.endswith(".json") and not n.startswith("."))

    def version(self) -> int:
        """Version of the published document, 0 if there is none; only names are read."""
        names = self._names()
        return int(names[-1].removesuffix(".json")) if names else 0

    def fetch(self) -> dict[str, Any] | None:
        names = self._names()
        return json.loads(self.store.read_text(f"_config/{names[-1]}")) if names else None

    def _write(self, body: dict[str, Any], version: int) -> int:
        self.store.create_text(f"_config/{version:012d}.json", json.dumps({**body, "version": version}))  # fails if another writer took it
        return version

    def _next(self, make: Callable[[dict[str, Any]], dict[str, Any]], tries: int = 8) -> int:
        """Write a new version made from the stored one; again if another writer came first."""
        for _ in range(tries):
            stored = self.fetch() or {}
            try:
                return self._write(make(stored), version_of(stored) + 1)
            except Conflict:
                continue
        raise ConfigError("the config document changes too fast")

    def publish(self, doc: dict[str, Any]) -> int:
        body = self.registry.validate(doc)
        return self._next(lambda stored: {**{k: v for k, v in stored.items() if k not in RESERVED}, **body})

    def append(self, delta: dict[str, Any]) -> int:
        self.registry.validate(delta)
        return self._next(lambda stored: self.registry.validate(merge(stored, delta)))


class ConfigWatcher:
    """Applies newer versions only; the version advances even if applying fails. ``ready`` after the first success."""

    def __init__(self, fetch: Callable[[], dict | None], apply: Callable[[dict], None]) -> None:
        self.fetch, self.apply, self.version, self.ready = fetch, apply, 0, False

    def poll(self) -> bool:
        try:
            doc = self.fetch()
        except Exception:
            return False  # read again at the next interval
        if doc is None or version_of(doc) <= self.version:
            return False
        self.version = version_of(doc)
        try:
            self.apply(doc)
        except ValueError:
            return False
        self.ready = True
        return True
