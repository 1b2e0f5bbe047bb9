"""A collector's receiver: OTLP over HTTP into files that ``otel`` and ``readStream`` take.

Every accepted body becomes a file of its own, which appears by one rename, so a reader never sees half of one.
"""

from __future__ import annotations

import gzip
import json
import os
import time
import uuid
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

# The paths of the protocol, and what is kept under them.
PATHS = {"/v1/metrics": "metric", "/v1/traces": "span", "/v1/logs": "log"}
#: bytes of a body that is taken
MAX_BODY = 64 * 1024 * 1024


def store_body(folder: str, kind: str, body: bytes, is_json: bool) -> Path:
    """The body as ``folder/kind/*.jsonl`` or ``*.pb``; JSON is put on one line."""
    if is_json:
        body = json.dumps(json.loads(body), ensure_ascii=False).encode() + b"\n"
    place = Path(folder) / kind
    place.mkdir(parents=True, exist_ok=True)
    name = f"{time.time_ns()}-{uuid.uuid4().hex}.{'jsonl' if is_json else 'pb'}"
    staged = place / f".{name}"
    staged.write_bytes(body)
    os.replace(staged, place / name)
    return place / name


def receiver(folder: str, host: str = "127.0.0.1", port: int = 4318) -> ThreadingHTTPServer:
    """A server that is ready to ``serve_forever``; port 0 takes a free one. Unknown paths get 404, bodies that are
    too large 413, bodies that do not decode 400."""

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self) -> None:  # noqa: N802 - the name that the base class calls
            kind, size = PATHS.get(self.path.split("?")[0]), int(self.headers.get("Content-Length") or 0)
            if kind is None or size > MAX_BODY:
                return self._answer(404 if kind is None else 413)
            body = self.rfile.read(size)
            is_json = "json" in (self.headers.get("Content-Type") or "")
            try:
                if self.headers.get("Content-Encoding") == "gzip":
                    body = gzip.decompress(body)
                store_body(folder, kind, body, is_json)
            except (ValueError, OSError, EOFError):
                return self._answer(400)
            self._answer(200, b"{}" if is_json else b"", "application/json" if is_json else "application/x-protobuf")

        def _answer(self, status: int, body: bytes = b"", kind: str = "text/plain") -> None:
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_) -> None:
            """Requests are not logged."""

    return ThreadingHTTPServer((host, port), Handler)
