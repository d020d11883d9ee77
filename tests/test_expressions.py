"""Payload, box and ledger expressions."""

import base64

import pytest
from pyspark.sql import functions as F

from orilla.functions import boxes, payload
from orilla.operators import ledger, reports

PNG = b"\x89PNG\r\n\x1a\n" + bytes(range(40))


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ("0x" + PNG.hex(), PNG), ("\\x" + PNG.hex().upper(), PNG), ("data:image/png;base64," + base64.b64encode(PNG).decode(), PNG),
        (base64.urlsafe_b64encode(PNG).decode(), PNG), ("\n".join(base64.encodebytes(PNG).decode().split()), PNG),
        ("short", b"short"), ("a" * 40, b"a" * 40), ("0xzz", b"0xzz"), (" x ", b"x"), (None, None),
    ],
)
def test_payload_forms(spark, cell, want):
    got = one(spark, payload.decode_text(F.lit(cell).cast("string")))
    assert (bytes(got) if got is not None else None) == want


def test_magic_and_names(spark):
    ext = lambda b: one(spark, payload.image_ext(F.unhex(F.lit(b.hex()))))
    assert [ext(b) for b in (b"\xff\xd8\xff\xe0", PNG, b"RIFF0000WEBPVP8 ", b"BM00", b"II*\x00", b"MM\x00*", b"??")] == [".jpg", ".png", ".webp", ".bmp", ".tiff", ".tiff", ".jpg"]
    assert one(spark, payload.safe_id(F.lit('  a/b: "c"  d '))) == "a_b___c__d"
    assert one(spark, payload.safe_id(F.lit(""))) == "sin_id"
    assert one(spark, payload.stem(F.lit("x/y.z/foto.a.jpg"))) == "foto.a"
    assert one(spark, payload.file_ext(F.lit("x.y/foto"))) == ""
    assert one(spark, payload.duration(F.lit(3725.9))) == "01h 02m 06s"
    assert one(spark, payload.delivery_name(F.lit(7), F.lit("A-01"), F.lit(".PNG"))) == "000007_A-01_crop.png"


def test_split_cells_are_rejoined(spark):
    cells = F.array(*(F.lit(x) for x in ("1", "data:image/png;base64", "A" * 20, "B" * 16, "x y", "C" * 20)))
    assert one(spark, payload.repair_split_cells(cells, 1)) == "data:image/png;base64," + "A" * 20 + "," + "B" * 16


def test_boxes(spark):
    b = boxes.box(F.lit(0), F.lit(0), F.lit(400), F.lit(240))
    inside = boxes.box(F.lit(0), F.lit(0), F.lit(400), F.lit(240))
    assert tuple(one(spark, boxes.fit_ratio(b, 1, 1, inside))) == (80, 0, 240, 240)
    face = F.struct(boxes.box(F.lit(100), F.lit(50), F.lit(80), F.lit(100)).alias("bbox"), F.lit(150).alias("chin_y"), F.lit(0.7).alias("confidence"))
    gate = lambda x, y, w, h: one(spark, boxes.face_violation(boxes.box(F.lit(x), F.lit(y), F.lit(w), F.lit(h)), face, F.lit(400), F.lit(300)))
    assert [gate(0, 0, 400, 160), gate(0, 40, 400, 260), gate(90, 0, 310, 300), gate(0, 0, 190, 300), gate(0, 0, 400, 166)] == ["bottom", "top", "left", "right", None]
    assert tuple(one(spark, boxes.rescale(boxes.box(F.lit(1), F.lit(3), F.lit(5), F.lit(7)), F.lit(2), F.lit(2), F.lit(1), F.lit(1)))) == (0, 2, 2, 4)


@pytest.mark.parametrize(
    ("reply", "ok"),
    [
        ('{"bbox_xywh":[0,0,10,10],"kind":"text","confidence":0.5}', True), ('{"bbox_xywh":[0,0,10],"kind":"text","confidence":0.5}', False),
        ('{"bbox_xywh":[0,0,10,-1],"kind":"text","confidence":0.5}', False), ('{"bbox_xywh":[0,0,10,true],"kind":"text","confidence":0.5}', False),
        ('{"bbox_xywh":[0,0,1.5,1],"kind":"text","confidence":0.5}', False), ('{"bbox_xywh":[0,0,10,10],"kind":"face","confidence":0.5}', False),
        ('{"bbox_xywh":[0,0,10,10],"kind":"text","confidence":1.5}', False), ('{"bbox_xywh":[0,0,10,10],"kind":"text","confidence":0.5,"x":1}', False),
        ('{"bbox_xywh":[0,0,10,10],"kind":"text"}', False), ("nonsense", False), (None, False),
    ],
)
def test_opinions(spark, reply, ok):
    assert one(spark, boxes.valid_opinion(F.lit(reply).cast("string"))) is ok


def test_ledger_round_trip_with_torn_line(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rec = spark.createDataFrame([("a", "ok", 1), ("b", "failed", 2), ("a", "noop", 3)], "source string, status string, seq long")
    ledger.append(rec, path)
    (tmp_path / "ledger" / "torn.json").write_text('{"source": "c", "status": "ok"}\n{"source": "d", "sta')
    back = ledger.read_ledger(spark, path)
    assert sorted(r["source"] for r in back.collect()) == ["a", "a", "b", "c"]
    assert {r["source"]: r["status"] for r in ledger.latest(back, "source", ("seq",)).collect()} == {"a": "noop", "b": "failed", "c": "ok"}
    files = spark.createDataFrame([(x,) for x in "abcd"], "source string")
    assert [r["source"] for r in ledger.todo(files, back).collect()] == ["d"]
    assert sorted(r["source"] for r in ledger.todo(files, back, retry_failed=True).collect()) == ["b", "d"]
    assert {r["kind"]: r["n"] for r in ledger.reconcile(files, back).collect()} == {"duplicate": 1, "matched": 2, "missing": 1}
    assert ledger.audit(back).columns == ["source", "sha256", "status", "method", "confidence", "crop_box", "elapsed_ms", "error"]


def test_manifest_file(spark, tmp_path):
    rows = [("in/z.png", "Z 99", "ok", None, "m"), ("in/a.png", None, "noop", None, "m"), ("in/x.png", None, "failed", None, None)]
    rec = spark.createDataFrame(rows, "source string, delivery_id string, status string, out_path string, method string")
    path = tmp_path / "manifest.csv"
    assert reports.write_manifest(reports.manifest(rec), str(path)) == 3
    text = path.read_bytes()
    assert text.startswith(b"\xef\xbb\xbf")
    assert text.decode("utf-8-sig").split() == ["orden,id,archivo_limpio,estado,origen", "1,a,000001_a_crop.png,noop,in/a.png", "2,Z_99,000002_Z_99_crop.png,ok,in/z.png", ",x,,failed,in/x.png"]
    reports.gallery(rec, str(tmp_path / "g.html"))
    assert "in/z.png" in (tmp_path / "g.html").read_text()
