"""A small HTTP service over the same functions: POST /crop, POST /crop/json, GET /health, GET /gallery.

X-Aspect-Ratio and X-Face-Safety (on unless turned off) shape a crop; without OpenCV and a JPEG encoder
X-Deskew and X-Quality are taken and change nothing.

One request is a lot of one image: its bytes are written to a folder, decoded,
decided and cut by the batch code. Bodies over 50 MB are refused (413); an image
that isn't cropped or left as it is gives 422 with its record.
"""

from __future__ import annotations

import base64
import json
import uuid
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orilla import lot, storage
from orilla.functions.boxes import SIDES
from orilla.sources import images

MAX_BODY = 50_000_000


def crop_bytes(spark: SparkSession, body: bytes, aspect: str | None = None, face_safety: bool = True) -> tuple[dict, bytes | None]:
    """The record of one image and, if it was cut, the crop as PNG; an untouched image comes back as it was."""
    folder = f"{storage.shared_dir(spark)}/request_{uuid.uuid4().hex}"
    try:
        storage.write(f"{folder}/in/image", body)
        decoded, records, _ = lot.records(spark, f"{folder}/in", SIDES, aspect, cache=False, face_safety=face_safety)
        rows = records.collect()
        if not rows:
            return {"status": "failed", "error": "not_an_image"}, None
        record = rows[0].asDict(recursive=True)
        if record["status"] == "noop":
            return record, body
        if record["status"] != "ok":
            return record, None
        images.write_crops(decoded, records.select("source", "status", "crop_box", F.lit("out.png").alias("out_name")), f"{folder}/out")
        return record, storage.read(f"{folder}/out/out.png")
    finally:
        storage.delete(spark, folder)


def server(spark: SparkSession, port: int = 0, host: str = "127.0.0.1", out: str | None = None) -> ThreadingHTTPServer:
    """A server that isn't started yet; ``out`` is the folder whose gallery it shows."""

    def asked_for(value: object, default: bool) -> bool:
        return default if value is None else str(value).strip().lower() in ("1", "true", "yes", "on")

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *a) -> None:  # noqa: ANN002
            pass

        def _send(self, code: int, body: bytes, kind: str = "application/json") -> None:
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def _json(self, code: int, x: dict) -> None:
            self._send(code, json.dumps(x, default=str).encode())

        def do_GET(self) -> None:
            if self.path == "/gallery" and out is not None and storage.exists(spark, f"{out}/gallery.html"):
                return self._send(200, storage.read(f"{out}/gallery.html"), "text/html; charset=utf-8")
            self._json(*((200, {"status": "ok"}) if self.path == "/health" else (404, {"error": "not found"})))

        def do_POST(self) -> None:
            n = int(self.headers.get("Content-Length") or 0)
            if n > MAX_BODY:
                self.close_connection = True
                return self._json(413, {"error": "too large"})
            body = self.rfile.read(n)
            if self.path == "/crop":
                record, cut = crop_bytes(spark, body, self.headers.get("X-Aspect-Ratio"), asked_for(self.headers.get("X-Face-Safety"), True))
                return self._send(200, cut, "application/octet-stream") if cut is not None else self._json(422, record)
            if self.path == "/crop/json":
                try:
                    asked = json.loads(body)
                    raw = base64.b64decode(asked["image_base64"])
                except (ValueError, KeyError, TypeError):
                    return self._json(400, {"error": "image_base64 is needed"})
                record, cut = crop_bytes(spark, raw, asked.get("aspect_ratio"), asked_for(asked.get("face_safety"), True))
                if cut is not None:
                    record["image_base64"] = base64.b64encode(cut).decode()
                return self._json(200 if cut is not None else 422, record)
            return self._json(404, {"error": "not found"})

    return ThreadingHTTPServer((host, port), Handler)
