"""The detector on rasters: measured in numpy, decided in Catalyst."""

import numpy as np
import pandas as pd
import pytest
from lots import bar, glyphs, photo, zone
from pyspark.sql import functions as F

from orilla.operators import d0, raster
from orilla.operators.decide import decide, frozen_check
from orilla.operators.faces import head


def detect(spark, images, allowed=raster.SIDES):
    rows = [{"source": k, **raster.profile(v)} for k, v in images.items()]
    df = spark.createDataFrame(rows, f"source string, {raster.PROFILE}")
    return {r["source"]: r for r in decide(df, allowed).collect()}


@pytest.fixture(scope="module")
def seen(spark):
    p = photo()
    images = {f"bar_{s}": bar(p, s, 60) for s in raster.SIDES}
    images["sides"] = bar(bar(p, "left", 40), "right", 40)
    images["frame"] = p
    for s in raster.SIDES:
        images["frame"] = bar(images["frame"], s, 30)
    for t in (5, 20, 80, 120):
        images[f"thick_{t}"] = bar(p, "bottom", t)
    images["grey_top"] = bar(p, "top", 50, 38)
    images["clean"] = p
    images["dark"] = np.full((300, 400, 3), 20, np.uint8)
    images["block"] = bar(glyphs(zone(p, 200, 260), 210, x0=100, gw=40), "bottom", 40)
    images["narrow_block"] = bar(glyphs(zone(p, 200, 260), 210), "bottom", 40)
    dim = np.full((300, 400, 3), 60, np.uint8)
    dim[40:150, 120:280] = 90
    images["dim"] = bar(dim, "bottom", 50, 20)
    images["dim_clean"] = dim
    images["large"] = bar(np.full((2000, 3000, 3), 200, np.uint8), "bottom", 200)
    images["most"] = bar(bar(bar(p, "left", 150), "right", 100), "bottom", 100)
    return detect(spark, images)


@pytest.mark.parametrize(
    ("name", "box"),
    [
        ("bar_top", (0, 60, 400, 240)), ("bar_bottom", (0, 0, 400, 240)), ("bar_left", (60, 0, 340, 300)), ("bar_right", (0, 0, 340, 300)),
        ("sides", (40, 0, 320, 300)), ("frame", (30, 30, 340, 240)), ("thick_5", (0, 0, 400, 295)), ("thick_20", (0, 0, 400, 280)),
        ("thick_80", (0, 0, 400, 220)), ("thick_120", (0, 0, 400, 180)), ("dim", (0, 0, 400, 250)), ("large", (0, 0, 3000, 1800)),
    ],
)
def test_exact_boxes(seen, name, box):
    assert seen[name]["status"] == "crop"
    assert tuple(seen[name]["crop_box"]) == box
    assert seen[name]["confidence"] > 0.8


def test_other_verdicts(seen):
    assert seen["clean"]["status"] == "noop" and tuple(seen["clean"]["crop_box"]) == (0, 0, 400, 300)
    assert seen["dim_clean"]["status"] != "crop" and tuple(seen["dim_clean"]["crop_box"]) == (0, 0, 400, 300)
    assert (seen["dark"]["status"], seen["dark"]["quarantine_reason"]) == ("quarantine", "uniform_dark_image")
    assert (seen["most"]["status"], seen["most"]["quarantine_reason"]) == ("quarantine", "crop_removes_majority")
    assert seen["grey_top"]["crop_box"]["y"] == 50


def test_text_block_is_cut_above_its_glyphs(seen):
    r = seen["block"]
    assert r["method"] == "projection+glyphs"
    assert r["crop_box"]["y"] == 0 and r["crop_box"]["h"] <= 205
    assert seen["narrow_block"]["status"] == "crop" and seen["narrow_block"]["crop_box"]["h"] <= 205


def test_side_restriction(spark):
    assert detect(spark, {"a": bar(photo(), "top", 60)}, ("left", "right"))["a"]["status"] == "noop"


def test_regions_match_flood_fill():
    rng = np.random.default_rng(4)
    for _ in range(20):
        mask = rng.random((25, 30)) < 0.3
        want, left = [], mask.copy()
        while left.any():
            y, x = (int(v[0]) for v in np.nonzero(left))
            todo, cells = [(y, x)], []
            left[y, x] = False
            while todo:
                a, b = todo.pop()
                cells.append((a, b))
                for i in range(max(0, a - 1), min(25, a + 2)):
                    for j in range(max(0, b - 1), min(30, b + 2)):
                        if left[i, j]:
                            left[i, j] = False
                            todo.append((i, j))
            ys, xs = zip(*cells)
            want.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1))
        want = sorted((b for b in want if b[2] * b[3] >= 6), key=lambda b: (b[1], b[0]))
        got = [tuple(b) for b in raster.regions(mask).tolist()]
        assert sorted(got) == sorted(want) and [b[1::-1] for b in got] == [b[1::-1] for b in want]


def test_frozen_check_agrees_with_the_fold(spark):
    p = bar(photo(), "bottom", 50)
    rows = [{"source": "a", **raster.profile(p)}, {"source": "b", **raster.profile(photo())}]
    df = spark.createDataFrame(rows, f"source string, {raster.PROFILE}").withColumn("t", F.expr("map('bottom', 0.166667D)"))
    got = {r["source"]: r["v"] for r in df.select("source", frozen_check(F.col("width"), F.col("height"), F.col("frozen_step"), F.col("frozen_luma_mean"), F.col("frozen_bright_frac"), F.col("frozen_lines"), F.col("t")).alias("v")).collect()}
    assert tuple(got["a"]["crop_box"]) == (0, 0, 400, 250) and got["b"] is None
    assert d0.cached((0.0, 0.166667, 0.0, 0.0), rows[0])[1] == (0, 0, 400, 250)
    assert d0.cached((0.0, 0.166667, 0.0, 0.0), rows[1]) is None


def test_lot_freezes_after_five(spark):
    images = {f"{i:02d}": bar(photo(), "bottom", 50) for i in range(6)}
    rows = [{"lot": "l", "source": k, **raster.profile(v)} for k, v in images.items()]
    df = spark.createDataFrame(rows, f"lot string, source string, {raster.PROFILE}")
    out = d0.fold_lots(d0.narrow(decide(df))).orderBy("source").collect()
    assert [r["method"] for r in out] == ["projection"] * 5 + ["d0-cache"]
    assert all((r["x"], r["y"], r["w"], r["h"]) == (0, 0, 400, 250) for r in out)


def test_fold_unfreezes_and_recalibrates():
    f = d0.Fold()
    bottom, left = (0.0, 0.1, 0.0, 0.0), (0.0, 0.0, 0.1, 0.0)
    for _ in range(5):
        f.current()
        f.learn("crop", "projection", bottom)
    assert f.frozen == bottom and f.event("ok", None, bottom) == "agree" and f.event("noop", "projection", None) == "agree"
    again = d0.Fold(f.state)
    again.learn("crop", "projection", left)
    assert again.frozen is None and again.window == [left]
    for _ in range(25):
        f.learn("crop", "d0-cache", None)
    assert f.frozen is None
    f.learn("failed", None, None)
    assert f.window == [None]


def test_streamed_fold_equals_batch(spark, tmp_path):
    from orilla.streaming.lots import fold_stream

    rows = []
    for lot in "ab":
        for i in range(12):
            t = 50 if i < 9 else 20
            rows.append({"lot": lot, "source": f"{i:02d}", "width": 400, "height": 300, "status": "crop", "method": "projection", "x": 0, "y": 0, "w": 400, "h": 300 - t, "confidence": 0.9, "quarantine_reason": None, "frozen_step": 1, "frozen_luma_mean": 0.5, "frozen_bright_frac": 0.5, "frozen_lines": raster.profile(bar(photo(), "bottom", t))["frozen_lines"]})
    types = {"frozen_lines": f"map<string,{raster.CHECK}>", "confidence": "double", "frozen_luma_mean": "double", "frozen_bright_frac": "double", **dict.fromkeys(("width", "height", "x", "y", "w", "h", "frozen_step"), "int")}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in d0.NARROW)
    df = spark.createDataFrame(pd.DataFrame(rows)[list(d0.NARROW)].to_dict("records"), schema)
    batch = sorted(map(tuple, d0.fold_lots(df).collect()))
    src = str(tmp_path / "in")
    df.where("source < '07'").coalesce(1).write.parquet(src)
    q = fold_stream(spark.readStream.schema(df.schema).parquet(src)).writeStream.format("memory").queryName("folded").outputMode("append").start()
    q.processAllAvailable()
    df.where("source >= '07'").coalesce(1).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("folded").collect())) == batch


def test_face_gate(spark):
    from orilla.operators.decide import face_gate

    rows = [{"source": k, **raster.profile(bar(photo(), "bottom", t))} for k, t in (("a", 60), ("b", 145))]
    got = {r["source"]: r for r in face_gate(decide(spark.createDataFrame(rows, f"source string, {raster.PROFILE}"))).collect()}
    assert got["a"]["status"] == "crop" and got["a"]["face_detected"]
    assert got["b"]["status"] == "quarantine" and got["b"]["quarantine_reason"].startswith("face_safety_violation: bottom") and not got["b"]["face_safety_ok"]


def test_orientation():
    from orilla.sources.images import exif_orientation

    a = np.arange(24).reshape(2, 4, 3)
    turned = {1: a, 2: a[:, ::-1], 3: a[::-1, ::-1], 4: a[::-1], 5: a.swapaxes(0, 1), 6: np.rot90(a, -1), 7: np.rot90(a, -1)[::-1], 8: np.rot90(a)}
    for o, want in turned.items():
        assert (raster.upright(a, o) == want).all(), o
    for order, mark in (("big", b"MM"), ("little", b"II")):
        n = lambda v, k: v.to_bytes(k, order)  # noqa: B023, E731
        tiff = mark + n(42, 2) + n(8, 4) + n(1, 2) + n(0x0112, 2) + n(3, 2) + n(1, 4) + n(6, 2) + n(0, 2)
        part = b"Exif\x00\x00" + tiff
        assert exif_orientation(b"\xff\xd8\xff\xe1" + (len(part) + 2).to_bytes(2, "big") + part + b"\xff\xda") == 6
    assert exif_orientation(b"\xff\xd8\xff\xda") == 1 and exif_orientation(b"") == 1


def test_head_without_opencv():
    f = head(photo())
    assert f["bbox"]["x"] <= 120 and f["chin_y"] > 100
    assert head(np.full((300, 400, 3), 200, np.uint8)) is None


def test_line_profiles_of_all_sides_look_once(monkeypatch):
    rng = np.random.default_rng(5)
    for a in (bar(photo(), "left", 30), rng.integers(0, 256, (300, 37, 3)).astype(np.uint8)):
        both = raster.all_line_profiles(a, (0.1, 0.5))
        for s in raster.SIDES:
            want = raster.line_profile(raster.turned(a, s), (0.1, 0.5))
            for k, v in both["rows" if s in ("top", "bottom") else "cols"].items():
                assert np.allclose(v[::-1] if s in ("bottom", "right") else v, want[k], rtol=0, atol=1e-7)
    seen, luma = [], raster.luma
    monkeypatch.setattr(raster, "luma", lambda rgb: seen.append(rgb.size // 3) or luma(rgb))
    framed = photo()
    for s in raster.SIDES:
        framed = bar(framed, s, 30)
    assert set(raster.profile(framed)["candidates"]) == set(raster.SIDES)
    assert sum(seen) <= 2 * 300 * 400  # the detection and the frozen check


def test_bright_rasters_are_not_put_in_order(monkeypatch):
    rng = np.random.default_rng(6)

    def plain(grid):
        lo, hi = (float(x) for x in np.percentile(grid, (2, 98)))
        return None if hi >= raster.EXPOSURE_TRIGGER or hi - lo < 1e-3 else (lo, hi)

    for n in (1, 2, 49, 50, 51, 99, 100, 101, 5000):
        for lit in (0, 0.01, 0.019, 0.02, 0.021, 0.03, 0.5):
            for kind in (np.float32, np.float64):
                grid = (rng.random(n) * 0.55).astype(kind)
                grid[: round(n * lit)] = rng.choice([0.55, 0.5500001, 0.9])
                assert raster.anchors(grid) == plain(grid), (n, lit)
    monkeypatch.setattr(np, "percentile", lambda *_: pytest.fail("a bright raster was put in order"))
    assert raster.anchors(raster.luma(bar(photo(), "bottom", 60))) is None


def test_regions_of_winding_masks():
    spiral = np.array([[c == "#" for c in line] for line in ("#######", "......#", "#####.#", "#...#.#", "#.###.#", "#.....#", "#######")])
    boxes, area = raster.region_boxes(spiral, corners=False)
    assert boxes.tolist() == [[0, 0, 7, 7]] and area.tolist() == [spiral.sum()]
    comb = np.ones((40, 41), bool)
    comb[:-1, 1::2] = False
    assert raster.region_boxes(comb)[0].tolist() == [[0, 0, 41, 40]]
