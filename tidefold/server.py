"""HTTP face: /healthz, /upload, /ejson, /sql and /config over one engine."""

from __future__ import annotations

import json
from collections.abc import Iterator
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from itertools import chain, islice
from typing import Any
from urllib.parse import parse_qs, urlparse

from .functions.extended_json import encode
from .plans.engine import Engine


class Listed:
    """An answer of one list, whose items come one after another."""

    def __init__(self, name: str, items: Iterator[dict]) -> None:
        first = list(islice(items, 1))  # what fails does so before the answer begins
        self.name, self.items = name, chain(first, items)

    def parts(self) -> Iterator[str]:
        yield f'{{"{self.name}": ['
        for k, item in enumerate(self.items):
            yield (", " if k else "") + encode(item)
        yield "]}"

    def __getitem__(self, name: str) -> list[dict]:
        if name != self.name:
            raise KeyError(name)
        return list(self.items)


def answer(engine: Engine | None, method: str, target: str, body: bytes) -> tuple[int, Any]:
    """Status and JSON answer of one request; without an engine the data routes are unavailable."""
    url = urlparse(target)
    if url.path == "/healthz":
        return 200, {"status": "ok"}
    if url.path not in ("/upload", "/ejson", "/sql", "/config"):
        return 404, {"error": "not found"}
    if engine is None:
        return 503, {"error": "no store is configured"}
    if url.path == "/config" and method == "GET":
        doc = engine.fetch_config()
        return (200, doc) if doc is not None else (404, {"error": "nothing is published yet"})
    if method != "POST":
        return 405, {"error": "POST required"}
    try:
        request = json.loads(body)
        if not isinstance(request, dict):
            raise ValueError("the body must be an object")
    except ValueError as e:
        return 400, {"error": str(e)}
    try:
        if url.path == "/upload":
            lines = [*(request.get("lines") or []), *([request["line"]] if request.get("line") else [])]
            return 200, engine.upload(lines).to_dict()
        if url.path == "/ejson":
            kind, found = engine.ask(request)
            return 200, Listed(kind, found) if kind == "documents" else found
        if url.path == "/sql":
            if not request.get("sql"):
                return 400, {"error": "sql is required"}
            result = engine.sql(request["sql"])
            return 200, Listed("rows", result.documents()) if result.kind == "select" else result.to_dict()
        mode = parse_qs(url.query).get("mode", ["set"])[0]
        if mode not in ("set", "append"):
            return 400, {"error": f"unknown mode {mode}"}
        try:
            return 200, {"version": (engine.publish_config if mode == "set" else engine.append_config)(request)}
        except ValueError as e:
            return 400, {"error": str(e)}
    except Exception as e:
        return 500, {"error": str(e)}


def serve(engine: Engine | None, host: str = "127.0.0.1", port: int = 8080) -> ThreadingHTTPServer:
    class Handler(BaseHTTPRequestHandler):
        def _do(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            status, content = answer(engine, self.command, self.path, body)
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            if isinstance(content, Listed):  # of unknown length: it ends with the connection
                self.send_header("Connection", "close")
                self.end_headers()
                for part in content.parts():
                    self.wfile.write(part.encode())
                self.close_connection = True
                return
            data = encode(content).encode()
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = _do

        def log_message(self, *args: Any) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
