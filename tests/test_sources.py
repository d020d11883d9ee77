"""Folders, JDBC, CSV exports and paginated HTTP."""

import base64
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from lots import bar, photo
from pyspark.sql import functions as F

from orilla.operators import raster, reports
from orilla.operators.decide import decide
from orilla.sources import csv_export, http_source, images, jdbc


def test_folder_to_crops(spark, tmp_path):
    src = tmp_path / "in"
    (src / "sub").mkdir(parents=True)
    (src / "a.png").write_bytes(images.png(bar(photo(), "bottom", 50)))
    (src / "sub/b.bmp").write_bytes(images.bmp(photo()))
    (src / "noext").write_bytes(images.png(bar(photo(), "left", 40)))
    (src / "junk.png").write_bytes(b"not an image")
    (src / "note.txt").write_text("x")
    files = images.scan(spark, str(src))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in files.collect()) == ["a.png", "b.bmp", "junk.png", "noext"]
    assert images.scan(spark, str(src), limit=1).count() == 1
    decoded = images.decode(spark, str(src))
    good = decoded.where("error IS NULL")
    seen = decide(raster.profile_images(good))
    got = {r["source"].rsplit("/", 1)[1]: (r["status"], tuple(r["crop_box"])) for r in seen.collect()}
    assert got == {"a.png": ("crop", (0, 0, 400, 250)), "b.bmp": ("noop", (0, 0, 400, 300)), "noext": ("crop", (40, 0, 360, 300))}
    assert {r["error"] for r in decoded.where("error IS NOT NULL").collect()} == {"unsupported_format"}
    assert images.decode(spark, str(src), max_pixels=10).where("error = 'image_too_large_blocked'").count() == 3
    out = tmp_path / "out"
    todo = seen.where("status = 'crop'").select("source", F.lit("ok").alias("status"), "crop_box", F.concat(F.regexp_extract("source", "([^/.]+)[^/]*$", 1), F.lit("_crop.png")).alias("out_name"))
    images.write_crops(good, todo, str(out))
    sizes = {r["image"]["origin"].rsplit("/", 1)[1]: (r["image"]["width"], r["image"]["height"]) for r in spark.read.format("image").load(str(out)).collect()}
    assert sizes == {"a_crop.png": (400, 250), "noext_crop.png": (360, 300)}
    e = reports.eda(files, seen, 0.1).first()
    assert e["total_files"] == 4 and e["verdicts"] == {"crop": 2, "noop": 1} and e["resolutions"] == {"400x300": 3}


@pytest.mark.parametrize("bad", ["DELETE FROM t", "SELECT 1; DROP TABLE t", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "DROP TABLE t", "", "INSERT INTO t VALUES (1)"])
def test_guard_refuses(spark, bad):
    with pytest.raises(ValueError):
        jdbc.assert_read_only(spark, bad)


def test_guard_and_scan_on_derby(spark):
    url = "jdbc:derby:memory:lots;create=true"
    df = spark.createDataFrame([(i, bytearray(images.png(photo()[:10, :10]))) for i in range(6)], "ID int, FOTO binary")
    df.write.format("jdbc").option("url", url).option("dbtable", "PEOPLE").option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    assert jdbc.assert_read_only(spark, "﻿ WITH x AS (SELECT 1 AS a) SELECT * FROM x;")
    rows = jdbc.scan(spark, url, "SELECT ID, FOTO FROM PEOPLE WHERE ID < 4", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert rows.count() == 4
    part = jdbc.scan(spark, url, "SELECT ID, FOTO FROM PEOPLE", partition=("ID", 0, 6, 3), driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert part.count() == 6 and part.rdd.getNumPartitions() == 3
    assert [(r["table"], r["column"]) for r in jdbc.candidates(spark, url).collect()] == [("PEOPLE", "FOTO")]
    assert jdbc.plan_scan('a"b', "c")["statement"] == 'SELECT "c" FROM "a""b"'


def test_csv_exports(spark, tmp_path):
    png = images.png(photo()[:6, :6])
    b64 = base64.b64encode(png).decode()
    (tmp_path / "a.csv").write_text("﻿id;cedula;foto;nombre\n1;0102;0x" + png.hex() + ";Ana\n2;0103;" + b64 + ";Eva\n", encoding="utf-8")
    got = {r["delivery_id"]: bytes(r["bytes"]) for r in csv_export.read_export(spark, str(tmp_path / "a.csv"), "foto", "cedula").collect()}
    assert got == {"0102": png, "0103": png}
    (tmp_path / "b.csv").write_text(f"codigo,foto\nA-01,data:image/png;base64,{b64}\nZ-99,\"data:image/png;base64,{b64}\"\n")
    got = {r["delivery_id"]: bytes(r["bytes"]) for r in csv_export.read_export(spark, str(tmp_path / "b.csv"), "foto", "codigo").collect()}
    assert got == {"A-01": png, "Z-99": png}
    assert csv_export.delimiter("a|b|c\n") == "|" and csv_export.delimiter("") == ","
    assert csv_export.resolve(["Id", "La Foto"], "foto") == "La Foto"


def test_http_list(spark):
    calls = {"b": 0}

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *a):
            pass

        def do_GET(self):
            body, code, extra = b"", 200, {}
            if self.path.startswith("/list?2"):
                body = json.dumps({"items": [{"n": 3, "u": "/gone"}], "next": None}).encode()
            elif self.path.startswith("/list"):
                body = json.dumps({"items": [{"n": 1, "u": "/a"}, {"n": 2, "u": "/b"}], "next": "/list?2"}).encode()
            elif self.path == "/a":
                body = b"A" * 10
            elif self.path == "/b":
                calls["b"] += 1
                if calls["b"] == 1:
                    code, extra = 503, {"Retry-After": "0"}
                else:
                    body = b"B"
            else:
                code = 404
            self.send_response(code)
            for k, v in extra.items():
                self.send_header(k, v)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(http_source.HttpList)
        base = {"base_url": f"http://127.0.0.1:{server.server_port}", "list_endpoint": "/list", "id_field": "n", "file_url_field": "u"}
        rows = {r["id"]: r for r in spark.read.format("http_list").options(**base).load().collect()}
        assert bytes(rows["1"]["content"]) == b"A" * 10 and bytes(rows["2"]["content"]) == b"B"
        assert rows["3"]["content"] is None and "404" in rows["3"]["error"]
        assert spark.read.format("http_list").options(**base, limit=1).load().count() == 1
    finally:
        server.shutdown()
    with pytest.raises(ValueError):
        http_source.ListReader({"base_url": "x"})
    assert http_source.backoff(10, 1, 5, 99) == 5 and 0.5 <= http_source.backoff(0, 1) <= 1


def test_stream_of_files(spark, tmp_path):
    from orilla.streaming.lots import run_batches, watch_folder

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.png").write_bytes(images.png(photo()))
    got = []

    def step(df, n):
        got.extend(r["path"].rsplit("/", 1)[1] for r in df.select("path").collect())

    for name in ("b.png", "c.png"):
        q = run_batches(watch_folder(spark, str(src)), step, str(tmp_path / "cp"))
        q.awaitTermination(60)
        (src / name).write_bytes(images.png(photo()))
    assert got == ["a.png", "b.png"]
