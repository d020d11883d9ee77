"""Settings, resources, stopping, storage, sidecars and probes."""

import json
import os
import signal
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from orilla import runtime, storage
from orilla.config import Settings
from orilla.functions import boxes
from orilla.operators import probes, raster
from orilla.sources import csv_export, sidecars


def test_settings(spark):
    s = Settings.read(env={"ORILLA_FREEZE_N": "7", "ORILLA_QUIET": "yes", "ORILLA_PATTERN_TOL": "0.2", "ORILLA_DB_URL": ""})
    assert (s.freeze_n, s.quiet, s.pattern_tol, s.db_url, s.chunk) == (7, True, 0.2, "", 25)
    with pytest.raises(ValueError, match="chunk"):
        Settings.read(env={"ORILLA_CHUNK": "many"})
    spark.conf.set("spark.orilla.chunk", "31")
    try:
        assert Settings.read(spark, {"ORILLA_CHUNK": "4"}).chunk == 31
    finally:
        spark.conf.unset("spark.orilla.chunk")


def test_workers_and_space(tmp_path):
    assert runtime.recommended_workers({"cpu": 8, "free_gb": 4.0}) == 4
    assert runtime.recommended_workers({"cpu": 2, "free_gb": 100}) == 2 and runtime.recommended_workers({"cpu": 8, "free_gb": 0}) == 1
    assert runtime.effective_workers(0, Settings(workers=5)) == 5 and runtime.effective_workers(3, Settings(workers=5)) == 3
    assert runtime.require_space(f"file://{tmp_path}/a/b") > 0 and runtime.free_mb("hdfs://x/y") == float("inf")
    with pytest.raises(runtime.InsufficientSpace):
        runtime.require_space(str(tmp_path), 1e15)


def test_stop_and_retry():
    token, cancelled = runtime.StopToken(), []
    with runtime.stoppable(token, lambda: cancelled.append(1)):
        os.kill(os.getpid(), signal.SIGINT)
        assert token and cancelled == [1]
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no")
        return "yes"

    assert runtime.retry_call(flaky, 3, float, sleep=waits.append) == "yes" and waits == [0.0, 1.0]
    with pytest.raises(ValueError):
        runtime.retry_call(lambda: int("x"), 3, float, sleep=waits.append)


def test_storage(spark, tmp_path):
    path = f"file:{tmp_path}/a/b.txt"
    storage.write(path, b"one")
    storage.write(f"{tmp_path}/a/b.txt", b"two")
    assert storage.read(path) == b"two" and storage.names(f"{tmp_path}/a") == ["b.txt"] and storage.names(f"{tmp_path}/none") == []
    assert storage.exists(spark, path)
    storage.remove(path)
    storage.remove(path)
    assert not storage.exists(spark, path)


def test_sidecars(spark, tmp_path):
    for name, body in {"a.json": {"source": "in/a.png", "status": "ok"}, ".b.json": {"source": "b"}, "checkpoint.json": {"source": "c"}, "d.json": [1], "e.json": {"no": 1}}.items():
        storage.write(f"{tmp_path}/out/{name}", json.dumps(body).encode())
    storage.write(f"{tmp_path}/out/torn.json", b'{"source": ')
    storage.write(f"{tmp_path}/out/quarantine/q.json", b'{"source": "in/q.png", "status": "quarantine", "out_path": "x.png"}')
    got = sidecars.scan(spark, f"{tmp_path}/out")
    assert {r["source"] for r in got.collect()} == {"in/a.png", "in/q.png"}
    for name in ("q.png", "q.jpg"):
        storage.write(f"{tmp_path}/out/quarantine/{name}", b"x")
    found = {r["source"]: r["image"] for r in sidecars.quarantine_images(got, sidecars.listing(spark, f"{tmp_path}/out/quarantine")).collect()}
    assert found["in/q.png"].endswith("/quarantine/q.jpg") and found["in/a.png"] is None
    none = sidecars.quarantine_images(got, sidecars.listing(spark, f"{tmp_path}/nowhere"))
    assert {r["source"]: r["image"] for r in none.collect()}["in/q.png"] == "x.png"
    shape = "path string, stem string"
    b, a, q = (spark.createDataFrame(x, shape) for x in ([("i/1.jpg", "1"), ("i/2.jpg", "2"), ("i/3.jpg", "3")], [("o/1.jpg", "1")], [("q/1.jpg", "1"), ("q/2.jpg", "2")]))
    rows = {r["stem"]: (r["after"], r["in_quarantine"]) for r in sidecars.before_after(b, a, q).collect()}
    assert rows == {"1": ("o/1.jpg", False), "2": ("q/2.jpg", True), "3": (None, False)}


def test_only_test_copies(spark):
    rows = spark.createDataFrame([("/data/Tests/x.png",), ("/data/synth_1.png",), ("/data/ana.png",), ("test",)], "source string")
    assert [r[0] for r in rows.select(boxes.is_test_copy(F.col("source"))).collect()] == [True, True, False, False]
    assert boxes.only_test_copies(rows.limit(2)).count() == 2
    with pytest.raises(Exception, match="ana.png"):
        boxes.only_test_copies(rows.where("source <> 'test'")).collect()


def test_csv_cells_keep_their_places(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text('id,note,foto,x\n2,,"0x4142",y\n3,n,,z\nid,,0x41,\n')
    (tmp_path / "d" / "b.csv").write_text("id,note,foto,x\n4,,data:image/png;base64," + "A" * 20 + ",BBBBBBBBBBBBBBBBBBBB,y\n")
    got = {r["delivery_id"]: r["payload"] for r in csv_export.read_export(spark, str(tmp_path / "d")).collect()}
    assert got == {"2": "0x4142", "3": None, "id": "0x41", "4": "data:image/png;base64," + "A" * 20 + "," + "B" * 20}
    assert csv_export.read_export(spark, str(tmp_path / "d"), limit=2).count() == 2


def _flood(mask):
    """The boxes and sizes of 4-connected regions, by flooding."""
    left, out = set(zip(*np.nonzero(mask))), []
    while left:
        first = min(left)
        left.discard(first)
        todo, seen = deque([first]), [first]
        while todo:
            y, x = todo.popleft()
            for n in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if n in left:
                    left.discard(n)
                    seen.append(n)
                    todo.append(n)
        ys, xs = zip(*seen)
        out.append(((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1), len(seen)))
    return sorted(out)


def test_region_probe_against_flooding():
    rng = np.random.default_rng(5)
    for _ in range(30):
        mask = rng.random((rng.integers(1, 20), rng.integers(1, 20))) < 0.5
        b, n = raster.region_boxes(mask, corners=False)
        assert sorted((tuple(x), int(k)) for x, k in zip(b.tolist(), n)) == [((int(x), int(y), int(w), int(h)), k) for (x, y, w, h), k in _flood(mask)]
    assert probes.largest(np.zeros((3, 3), bool)) is None


def test_border_probe():
    a = np.full((200, 400, 3), 200, np.uint8)
    a[150:] = 8
    a[170:180, 100:160] = 250
    got = probes.border_probe(a)
    bottom = next(s for s in got["sides"] if s["side"] == "bottom")
    assert (bottom["strict_run_90"], bottom["dark_run_90"], bottom["edge_strict_frac"], bottom["scan_depth"]) == (20, 20, 1.0, 70)
    assert bottom["strict_run_50"] == 50
    box = got["dark_regions"][0]
    assert box["bbox_xywh"] == [0, 150, 400, 50] and box["touches"] == ["bottom", "left", "right"] and box["anchor"]["bbox_xywh_abs"] == [100, 170, 59, 9]
    dark, gray = probes.gray_threshold(a)
    assert int(dark.sum()) == 50 * 400 - 600 and gray[0, 0] == 200
    assert probes.thumbnail(a, 100).shape == (50, 100, 3) and probes.thumbnail(a).shape == a.shape
