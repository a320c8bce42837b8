"""Settings: defaults, then a file, then the environment (``TIDEFOLD_*``), then flags."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields


@dataclass
class Settings:
    root: str = ""
    include: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    patterns: list[str] = field(default_factory=list)
    host: str = "127.0.0.1"
    port: int = 8080
    interval: str = "5 seconds"
    checkpoint: str = ""
    log_level: str = "WARN"
    mode: str = "batch"
    batch_size: int = 0
    workers: int = 0
    buckets: int = 16
    report_seconds: float = 60.0
    wait_for_config: bool = False
    max_bytes_per_file: int = 64 << 20


def load(text: str | bytes = "", env: Mapping[str, str] = os.environ, **flags) -> Settings:
    """``text`` holds JSON, told by its first character, or a subset of YAML: nested keys, lists of values, comments.

    Keys may be grouped under names of one's choice; only the innermost name counts.
    """
    text = text.decode() if isinstance(text, bytes) else text
    base = _flat(json.loads(text) if text.lstrip().startswith("{") else parse_yaml(text))
    known = {f.name: f for f in fields(Settings)}
    if unknown := base.keys() - known.keys():
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    for name, f in known.items():
        if (value := env.get(f"TIDEFOLD_{name.upper()}")) is not None:
            base[name] = value if f.type == "str" else _value(value)
    return Settings(**{**base, **{k: v for k, v in flags.items() if v is not None}})


def _flat(tree: dict) -> dict:
    out: dict = {}
    for key, value in tree.items():
        out |= _flat(value) if isinstance(value, dict) else {key: value}
    return out


def parse_yaml(text: str) -> dict:
    """Nested mappings and lists of plain, quoted or JSON values."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in map(_uncommented, text.splitlines()) if x.strip() and x.strip() != "---"]

    def block(at: int, indent: int) -> tuple[object, int]:
        out: dict | list = [] if lines[at][1].startswith("- ") or lines[at][1] == "-" else {}
        while at < len(lines) and lines[at][0] == indent:
            body = lines[at][1]
            if isinstance(out, list):
                if not body.startswith("-"):
                    break
                out.append(_value(body[1:].strip()))
                at += 1
                continue
            key, colon, rest = body.partition(":")
            if not colon:
                raise ValueError(f"not a setting: {body!r}")
            at += 1
            if rest.strip():
                out[_value(key.strip())] = _value(rest.strip())
            elif at < len(lines) and (lines[at][0] > indent or lines[at][0] == indent and lines[at][1].startswith("-")):
                out[_value(key.strip())], at = block(at, lines[at][0])
            else:
                out[_value(key.strip())] = None
        if at < len(lines) and lines[at][0] > indent:
            raise ValueError(f"unexpected indent: {lines[at][1]!r}")
        return out, at

    if not lines:
        return {}
    tree, at = block(0, lines[0][0])
    if at < len(lines) or not isinstance(tree, dict):
        raise ValueError("settings must be a mapping")
    return {k: v for k, v in tree.items() if v is not None}


def _uncommented(line: str) -> str:
    """A line without a comment: from a ``#`` outside quotes that begins it or follows a space."""
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"" and (i == 0 or line[i - 1] in " [,:"):
            quote = c
        elif c == "#" and (i == 0 or line[i - 1].isspace()):
            return line[:i]
    return line


def _value(text: str):
    if len(text) > 1 and text[0] == text[-1] == "'":
        return text[1:-1].replace("''", "'")
    try:
        return json.loads(text)
    except ValueError:
        pass
    if text.startswith("[") and text.endswith("]"):
        return [_value(x.strip()) for x in text[1:-1].split(",") if x.strip()]
    return {"yes": True, "no": False, "~": None, "null": None}.get(text.lower(), text)
