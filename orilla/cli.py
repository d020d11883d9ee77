"""Command line over folders, databases, exports and HTTP lists. Results are JSON on stdout.

Exit codes: 0 done, 1 a file failed, 2 wrong use, 3 no disk space, 130 stopped.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla import lot, runtime, sinks, storage
from orilla.config import Settings
from orilla.functions import boxes, payload
from orilla.operators import ledger, probes, raster, reports
from orilla.operators.decide import decide
from orilla.shipping import ship
from orilla.sources import csv_export, http_source, images, jdbc

SIDE_CHOICES = ("auto", "all", *boxes.SIDES)


def session() -> SparkSession:
    spark = SparkSession.builder.appName("orilla").getOrCreate()
    ship(spark)
    return spark


def show(x: object) -> None:
    print(json.dumps(x, ensure_ascii=False, default=str))


def sides(choice: str) -> tuple[str, ...]:
    return boxes.SIDES if choice in ("auto", "all") else (choice,)


def local(path: str) -> str:
    """Absolute, where a path names no file system of its own."""
    return path if ":/" in path else os.path.abspath(path)


def run_lot(spark: SparkSession, a: argparse.Namespace, folder: str, **more: object) -> int:
    """One run over a folder within the disk reserve; an interrupt stops it between steps."""
    settings = Settings.read(spark)
    out, token = local(a.out), runtime.StopToken()
    try:
        runtime.require_space(out, reserve_mb=settings.min_free_mb)
        with runtime.stoppable(token, spark.sparkContext.cancelAllJobs):
            found = lot.run(spark, folder, out, settings, sides(a.side), a.aspect_ratio, a.resume, a.dry_run, a.lots == "subfolder", not a.no_face_safety, stop=token, **more)
    except runtime.InsufficientSpace as e:
        print(e, file=sys.stderr)
        return runtime.NO_SPACE
    except (KeyboardInterrupt, Exception):
        if token:
            return runtime.STOPPED
        raise
    show(found)
    return runtime.STOPPED if token else 0


def cmd_batch(a: argparse.Namespace) -> int:
    return run_lot(session(), a, local(a.src))


def cmd_restart(a: argparse.Namespace) -> int:
    """Goes on from the checkpoint in ``out``; without one there is nothing to go on with."""
    spark = session()
    path = f"{local(a.out)}/checkpoint.json"
    if not storage.exists(spark, path):
        print(f"no checkpoint at {path}", file=sys.stderr)
        return 2
    try:
        a.src, a.resume = json.loads(storage.read(path))["src"], True
    except (ValueError, KeyError, TypeError):
        print(f"the checkpoint at {path} can't be read", file=sys.stderr)
        return 2
    return run_lot(spark, a, a.src)


def cmd_crop(a: argparse.Namespace) -> int:
    spark = session()
    _, records, _ = lot.records(spark, local(a.src), sides(a.side), a.aspect_ratio, cache=False, settings=Settings.read(spark))
    rows = [r.asDict(recursive=True) for r in records.collect()]
    for r in rows:
        show(r)
    return int(any(r["status"] == "failed" for r in rows))


def cmd_inspect(a: argparse.Namespace) -> int:
    spark = session()
    decoded = images.decode(spark, local(a.src)).where("error IS NULL").select("source", "orientation", "image.*")

    def look(frames):  # noqa: ANN001, ANN202
        import pandas as pd

        for f in frames:
            turned = [raster.upright(raster.to_rgb(r.data, r.height, r.width, r.nChannels), r.orientation) for r in f.itertuples()]
            yield pd.DataFrame({"found": [json.dumps({"file": s} | probes.inspect(t)) for s, t in zip(f["source"], turned)]})

    for r in decoded.mapInPandas(look, "found string").toLocalIterator():
        print(r["found"])
    return 0


def cmd_eda(a: argparse.Namespace) -> int:
    spark = session()
    sample = reports.seeded_sample(images.decode(spark, a.src), "source", a.sample).persist()
    t = time.time()
    good = decide(raster.profile_images(sample.where("error IS NULL"))).select("width", "height", "status")
    none = F.lit(None).cast("int")
    seen = good.unionByName(sample.where("error IS NOT NULL").select(none.alias("width"), none.alias("height"), F.lit("failed").alias("status"))).persist()
    n = max(seen.count(), 1)
    row = reports.eda(images.scan(spark, a.src).select("path", "length"), seen, (time.time() - t) / n).first().asDict(recursive=True)
    if a.out:
        sinks.write_report(row, f"{local(a.out)}/eda_report.json", "Exploratory report")
    show(row)
    return 0


def cmd_qa(a: argparse.Namespace) -> int:
    spark = session()
    show(reports.qa(ledger.latest(ledger.read_ledger(spark, f"{a.out}/ledger"), "source", ("run_id", "seq"))).first().asDict(recursive=True))
    return 0


def cmd_gallery(a: argparse.Namespace) -> int:
    spark = session()
    reports.gallery(ledger.latest(ledger.read_ledger(spark, f"{a.out}/ledger"), "source", ("run_id", "seq")), f"{a.out}/gallery.html", a.limit)
    return 0


def cmd_sql(a: argparse.Namespace) -> int:
    spark = session()
    if not a.url:
        print("no database URL given", file=sys.stderr)
        return 2
    try:
        if not a.confirm:
            rows = jdbc.candidates(spark, a.url).collect()
            for r in rows:
                show(r.asDict() | {"plan": jdbc.plan_scan(r["table"], r["column"], Settings.read(spark).sql_batch)})
            return 0
        rows = jdbc.scan(spark, a.url, a.statement, Settings.read(spark).sql_batch)
        image = a.column or rows.columns[-1]
        ident = payload.safe_id(F.col(a.id)) if a.id else F.substring(F.sha2(F.col(image).cast("binary"), 256), 1, 16)
        found = payload.decode_payload(rows.withColumn("delivery_id", ident), image).select("delivery_id", "bytes", "ext")
    except Exception as e:  # noqa: BLE001  the driver's messages name no password
        print(f"{type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
        return 2
    if not a.out:
        show(found.select(payload.has_image_magic(F.col("bytes")).alias("image")).groupBy("image").count().toPandas().to_dict("records"))
        return 0
    return crop_rows(spark, a, found)


def cmd_csv(a: argparse.Namespace) -> int:
    spark = session()
    return crop_rows(spark, a, csv_export.read_export(spark, local(a.src), a.column, a.id, a.limit).select("delivery_id", "bytes", "ext"))


def crop_rows(spark: SparkSession, a: argparse.Namespace, rows: DataFrame) -> int:
    """Decoded payloads (delivery_id, bytes, ext) to files in ``out/inbox``, then a run over them; names repeat with a suffix."""
    folder = f"{local(a.out)}/inbox"
    numbered = ledger.numbered(rows.withColumn("h", F.sha2("bytes", 256)), "delivery_id", ("h",))
    sinks.stage(numbered.select(F.concat("unique_name", "ext").alias("name"), F.col("bytes").alias("content")), folder)
    return run_lot(spark, a, folder)


def cmd_api(a: argparse.Namespace) -> int:
    spark = session()
    spark.dataSource.register(http_source.HttpList)
    settings = Settings.read(spark)
    with open(a.config, encoding="utf-8") as f:
        options = {"retries": str(settings.api_retries), "timeout": str(settings.api_timeout)} | {k: str(v) for k, v in json.load(f).items()}
    rows = spark.read.format("http_list").options(**options).load()
    if not a.out:
        show(rows.agg(F.count("*").alias("total"), F.count("content").alias("read"), F.count("error").alias("failed")).first().asDict())
        return 0
    return crop_rows(spark, a, rows.where(F.col("content").isNotNull()).select(payload.safe_id(F.col("id")).alias("delivery_id"), F.col("content").alias("bytes"), payload.image_ext(F.col("content")).alias("ext")))


def cmd_deliver(a: argparse.Namespace) -> int:
    spark = session()
    show(sinks.deliver(spark, local(a.out)))
    return 0


def cmd_workers(a: argparse.Namespace) -> int:
    show(runtime.machine() | {"workers": runtime.effective_workers(a.workers, Settings.read())})
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="orilla", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, f, *flags: tuple) -> None:  # noqa: ANN001
        s = sub.add_parser(name)
        for names, options in flags:
            s.add_argument(*names, **options)
        s.set_defaults(run=f)

    src, out, maybe_out = (("src",), {}), (("--out",), {"required": True}), (("--out",), {"default": None})
    shape = ((("--side",), {"choices": SIDE_CHOICES, "default": "auto"}), (("--aspect-ratio",), {"default": None}))
    flag = lambda name: ((name,), {"action": "store_true"})
    how = (*shape, flag("--resume"), flag("--dry-run"), flag("--no-face-safety"), (("--lots",), {"choices": ("folder", "subfolder"), "default": "folder"}))
    limit = (("--limit",), {"type": int, "default": None})
    add("eda", cmd_eda, src, maybe_out, (("--sample",), {"type": int, "default": 100}))
    add("inspect", cmd_inspect, src)
    add("crop", cmd_crop, src, *shape)
    add("batch", cmd_batch, src, out, *how)
    add("restart", cmd_restart, out, *how)
    add("sql", cmd_sql, (("--url",), {"default": Settings.read().db_url}), (("--statement",), {"default": ""}), flag("--confirm"), (("--column",), {"default": None}), (("--id",), {"default": None}), maybe_out, *how)
    add("csv", cmd_csv, src, out, (("--column",), {"default": "foto"}), (("--id",), {"default": "id"}), limit, *how)
    add("api", cmd_api, (("config",), {}), maybe_out, *how)
    add("gallery", cmd_gallery, out, (("--limit",), {"type": int, "default": 500}))
    add("deliver", cmd_deliver, out)
    add("qa", cmd_qa, out)
    add("workers", cmd_workers, (("--workers",), {"type": int, "default": None}))
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.run(a)


if __name__ == "__main__":
    sys.exit(main())
