"""Command line and HTTP entry points.

    python -m riskloom.cli run TABLE [SAMPLE_ROWS]
    python -m riskloom.cli serve [PORT]
"""

from __future__ import annotations

import json
import sys
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

from riskloom.plans.pipeline import run_table
from riskloom.session import configure_logging, get_session


def respond(params: dict, runner=run_table, spark=None) -> tuple[int, dict]:
    """The answer to /run: status code and JSON body."""
    table = params.get("table_name")
    if not table:
        return 400, {"status": "error", "message": "table_name is required"}
    try:
        run = runner(spark or get_session(), table, int(params.get("sample_rows") or 100))
        return 200, {"status": "success", "run_id": run.run_id, "rows": run.scored.count(), "columns": run.scored.columns, "timestamp": datetime.now(UTC).isoformat()}
    except Exception as e:
        return 500, {"status": "error", "message": str(e)[:500]}


class Handler(BaseHTTPRequestHandler):
    """GET /healthcheck; GET or POST /run."""

    def _send(self, code: int, body: str, kind: str = "application/json") -> None:
        data = body.encode()
        self.send_response(code)
        self.send_header("Content-Type", kind)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def _run(self, params: dict) -> None:
        code, body = respond(params)
        self._send(code, json.dumps(body))

    def do_GET(self) -> None:
        url = urlparse(self.path)
        if url.path == "/healthcheck":
            self._send(200, "I'm ready!", "text/plain")
        elif url.path == "/run":
            self._run({k: v[0] for k, v in parse_qs(url.query).items()})
        else:
            self._send(404, "{}")

    def do_POST(self) -> None:
        if urlparse(self.path).path != "/run":
            return self._send(404, "{}")
        raw = self.rfile.read(int(self.headers.get("Content-Length") or 0))
        try:
            params = json.loads(raw or b"{}")
        except ValueError:
            return self._send(400, json.dumps({"status": "error", "message": "no JSON"}))
        return self._run(params)


def main(args: list[str]) -> int:
    configure_logging()
    if args[:1] == ["run"] and len(args) > 1:
        run = run_table(get_session(), args[1], int(args[2]) if len(args) > 2 else 100)
        run.tiers.show()
        return 0
    if args[:1] == ["serve"]:
        ThreadingHTTPServer(("", int(args[1]) if len(args) > 1 else 8080), Handler).serve_forever()
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
