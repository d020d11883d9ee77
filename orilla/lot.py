"""One lot from pixels to records: profiles, decisions, the lot fold, gates, ratio."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla import sinks, storage
from orilla.config import Settings
from orilla.functions import boxes, payload
from orilla.operators import d0, ledger, raster, reports
from orilla.operators.decide import decide, face_gate
from orilla.sources import images

FOLD = ("source", "status", "method", "confidence", "quarantine_reason", "seq")


def crop_name(source: Column) -> Column:
    """A crop's file name: unique for each source; BMP stays BMP, all else becomes PNG."""
    return F.concat(sinks.unique_stem(source), F.lit("_crop"), F.when(payload.file_ext(source) == ".bmp", ".bmp").otherwise(".png"))


def profiles(spark: SparkSession, decoded: DataFrame, allowed: tuple[str, ...], face_safety: bool, lot: Column) -> DataFrame:
    """Decided rows without pixels, written to the shared folder once: pixels are looked at a single time."""
    seen = decide(raster.profile_images(decoded.where("error IS NULL"), sides=allowed), allowed)
    seen = face_gate(seen) if face_safety else seen.withColumn("face_detected", F.col("face").isNotNull())
    path = f"{storage.shared_dir(spark)}/profiles_{uuid.uuid4().hex}"
    seen.withColumn("lot", lot).write.parquet(path)
    return spark.read.parquet(path)


def records(
    spark: SparkSession, folder: str, allowed: tuple[str, ...] = boxes.SIDES, aspect: str | None = None, skip: DataFrame | None = None,
    cache: bool = True, face_safety: bool = True, by_subfolder: bool = False, settings: Settings = Settings(), delivery_ids: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, int]:
    """(decoded images, ledger records, how many were skipped) of a folder.

    ``by_subfolder`` makes each sub-folder a lot of its own, so that lots are folded side by side; else the
    folder is one. delivery_ids: source and delivery_id, where sources have one.
    """
    decoded = images.decode(spark, folder, settings.max_pixels)
    skipped = 0
    if skip is not None:
        skipped = ledger.skipped(decoded.select("source"), skip).count()
        decoded = ledger.todo(decoded, skip)
    lot = F.regexp_extract("source", "^(.*)/", 1) if by_subfolder else F.lit(folder)
    seen = profiles(spark, decoded, allowed, face_safety, lot)
    if cache:
        box = boxes.box(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("crop_box")
        found = d0.fold_lots(d0.narrow(seen)).select(*FOLD, box)
    else:
        found = seen.withColumn("seq", F.lit(0).cast("long")).select(*FOLD, "crop_box")
    found = found.join(seen.select("source", "width", "height", "face", "face_detected"), "source")
    found = ratio_kept(found, aspect, face_safety)
    b = F.col("crop_box")
    cut = {"top": b["y"] > 0, "bottom": b["y"] + b["h"] < F.col("height"), "left": b["x"] > 0, "right": b["x"] + b["w"] < F.col("width")}
    place = F.when(F.col("status") == "crop", crop_name(F.col("source"))).otherwise(F.col("source"))
    ok = found.select(
        "source", F.struct(F.col("width").alias("w"), F.col("height").alias("h")).alias("orig_wh"), "crop_box", "method", "confidence", "face_detected", "quarantine_reason", "seq",
        F.filter(F.array(*(F.when(c, F.lit(s)) for s, c in cut.items())), lambda s: s.isNotNull()).alias("sides"), (F.col("status") != "quarantine").alias("face_safety_ok"),
        F.when(F.col("status") == "crop", "ok").otherwise(F.col("status")).alias("status"), F.lit(None).cast("string").alias("error"), place.alias("out_path"),
    )
    bad = decoded.where("error IS NOT NULL").select("source", F.lit("failed").alias("status"), "error")
    sha = images.fingerprints(images.scan(spark, folder)).select(F.col("path").alias("source"), "sha256")
    out = ok.unionByName(bad, allowMissingColumns=True).join(sha, "source", "left")
    return decoded, out if delivery_ids is None else out.join(delivery_ids, "source", "left"), skipped


def ratio_kept(found: DataFrame, aspect: str | None, face_safety: bool) -> DataFrame:
    """Crops trimmed to the ratio inside what is left; where that would cut a face the crop stays as it was."""
    if not aspect:
        return found
    rw, rh = (float(x) for x in aspect.split(":"))
    b, face = F.col("crop_box"), F.col("face")
    fitted = boxes.fit_ratio(b, rw, rh, b)
    if face_safety:
        fitted = F.when(boxes.face_violation(fitted, face, F.col("width"), F.col("height")).isNull(), fitted).otherwise(b)
    return found.withColumn("crop_box", F.when(F.col("status") == "crop", fitted).otherwise(b))


def run(
    spark: SparkSession, folder: str, out: str, settings: Settings, allowed: tuple[str, ...] = boxes.SIDES, aspect: str | None = None, resume: bool = False,
    dry_run: bool = False, by_subfolder: bool = False, face_safety: bool = True, delivery_ids: DataFrame | None = None, stop: object = False,
) -> dict:
    """A whole run: ledger, crops, sidecars, queues, checkpoint, audit and delivery; ``stop`` is asked between the steps.

    What the ledger has isn't done again on resume, so a run that was stopped goes on with the next one.
    """
    started, path = time.time(), f"{out}/ledger"
    done = ledger.read_ledger(spark, path) if resume and storage.exists(spark, path) else None
    decoded, rows, skipped = records(spark, folder, allowed, aspect, done, face_safety=face_safety, by_subfolder=by_subfolder, settings=settings, delivery_ids=delivery_ids)
    name = time.strftime("%Y%m%dT%H%M%S")
    ledger.append(rows.withColumn("run_id", F.lit(name)).withColumn("dry_run", F.lit(dry_run)), path)
    mine = ledger.read_ledger(spark, path).where(F.col("run_id") == name)
    # a record's out_path is a name below out for crops, the source itself for others
    full = mine.withColumn("out_path", F.when(F.col("status") == "ok", F.concat(F.lit(f"{out}/crops/"), F.col("out_path"))).otherwise(F.col("out_path")))
    steps = [] if dry_run else [
        lambda: images.write_crops(decoded.where("error IS NULL"), mine.select("source", "status", "crop_box", F.col("out_path").alias("out_name")), f"{out}/crops"),
        lambda: sinks.write_quarantine(mine, out),
        lambda: sinks.write_sidecars(full, out),
    ]
    for step in steps:
        if not stop:
            step()
    latest = ledger.latest(ledger.read_ledger(spark, path), "source", ("run_id", "seq"))
    tally = ledger.status_tally(latest).first().asDict()
    n = mine.count()
    state = ledger.progress(tally["total"], n, tally["total"], time.time() - started) | {"status": "stopped" if stop else "done", "src": folder, "out": out, "summary": tally}
    sinks.write_report(state, f"{out}/checkpoint.json", "Checkpoint")
    ledger.audit(mine).write.mode("append").option("header", True).csv(f"{out}/audit")
    found = tally | {"processed": n, "skipped": skipped}
    if stop or dry_run:
        reports.write_manifest(reports.manifest(latest), f"{out}/manifest_import.csv")
        return found | {"stopped": bool(stop)}
    placed = latest.withColumn("out_path", F.when(F.col("status") == "ok", F.concat(F.lit(f"{out}/crops/"), F.col("out_path"))).otherwise(F.col("out_path")))
    return found | {"delivery": sinks.deliver(spark, out, placed)}
