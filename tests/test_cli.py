"""A folder through the command line: batch, resume, reports."""

import json

from lots import bar, photo

from orilla import cli
from orilla.sources import images


def test_batch_resume_and_reports(spark, tmp_path, capsys):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for i in range(3):
        (src / f"{i}.png").write_bytes(images.png(bar(photo(), "bottom", 50)))
    (src / "bad.png").write_bytes(b"\x89PNG junk")
    run = lambda *a: (cli.main(list(a)), [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith(("{", "["))])
    code, shown = run("batch", str(src), "--out", str(out))
    pack = shown[-1].pop("delivery")
    assert (pack["delivered"], pack["total_manifest"]) == (3, 4)
    assert code == 0 and shown[-1] == {"total": 4, "ok": 3, "noop": 0, "quarantine": 0, "failed": 1, "processed": 4, "skipped": 0}
    (src / "new.bmp").write_bytes(images.bmp(photo()))
    code, shown = run("batch", str(src), "--out", str(out), "--resume")
    assert shown[-1]["processed"] == 1 and shown[-1]["skipped"] == 4 and shown[-1]["noop"] == 1
    code, shown = run("qa", "--out", str(out))
    assert shown[-1]["total"] == 5 and shown[-1]["quarantine_sources"] == []
    assert len(list((out / "crops").glob("*_crop.png"))) == 3
    assert (out / "manifest_import.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    assert json.loads((out / "checkpoint.json").read_text())["percent"] == 100.0
    code, shown = run("crop", str(src / "0.png"), "--aspect-ratio", "1:1")
    assert code == 0 and shown[-1]["crop_box"] == {"x": 75, "y": 0, "w": 250, "h": 250}
    assert run("sql")[0] == 2
    sidecars = [json.loads(p.read_text()) for p in sorted(out.glob("*.json")) if p.name != "checkpoint.json"]
    assert len(sidecars) == 4 and {s["status"] for s in sidecars} == {"ok", "noop"} and len(list((out / "failed").glob("bad_*.json"))) == 1
    assert len(list((out / "delivery").glob("*_crop.*"))) == 4
    (out / "delivery" / "000009_gone_crop.png").write_bytes(b"x")
    assert run("deliver", "--out", str(out))[1][-1]["delivered"] == 4
    assert not (out / "delivery" / "000009_gone_crop.png").exists()
    assert run("restart", "--out", str(out))[1][-1]["processed"] == 0 and run("restart", "--out", str(tmp_path / "no"))[0] == 2
    found = run("inspect", str(src / "0.png"))[1][-1]
    assert found["sides"]["bottom"]["bar_run_px"] == 50 and found["skew_angle_deg"] == 0.0
    assert run("workers", "--workers", "3")[1][-1]["workers"] == 3
    assert run("eda", str(src))[1][-1]["total_files"] == 5
    assert run("gallery", "--out", str(out))[0] == 0 and (out / "gallery.html").exists()


def test_csv_to_crops(spark, tmp_path, capsys):
    import base64

    cell = base64.b64encode(images.png(bar(photo(), "bottom", 50))).decode()
    clean = base64.b64encode(images.png(photo())).decode()
    (tmp_path / "a.csv").write_text(f"id,note,foto,last\n7,,data:image/png;base64,{cell},x\n8,n,\"data:image/png;base64,{clean}\",\n7,,,\n")
    code = cli.main(["csv", str(tmp_path / "a.csv"), "--out", str(tmp_path / "out")])
    shown = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert code == 0 and (shown["ok"], shown["noop"]) == (1, 1) and shown["delivery"]["delivered"] == 2


def test_no_space(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("ORILLA_MIN_FREE_MB", "1e15")
    (tmp_path / "in").mkdir()
    assert cli.main(["batch", str(tmp_path / "in"), "--out", str(tmp_path / "out")]) == 3
