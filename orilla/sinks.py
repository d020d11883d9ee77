"""What a run leaves as files: sidecars, the quarantine and failed queues, the delivery pack.

Rows are written by the tasks that hold them, each file whole or not at all, so a task
that is run again writes the same files again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orilla import storage
from orilla.functions import payload
from orilla.operators import ledger, reports
from orilla.sources import sidecars

QUEUES = {"quarantine": "quarantine/", "failed": "failed/"}


def unique_stem(source: Column) -> Column:
    """A name that no other source has: the stem and a part of the path's digest."""
    return F.concat(payload.safe_id(payload.stem(source)), F.lit("_"), F.substring(F.sha2(source, 256), 1, 8))


def write_sidecars(records: DataFrame, out: str) -> None:
    """One JSON file a record: beside the crops, or in the queue of its status."""
    folder = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in QUEUES.items() for x in kv)), F.col("status")), F.lit(""))
    rows = records.select(F.concat(F.lit(f"{out}/"), folder, unique_stem(F.col("source")), F.lit(".json")).alias("path"), F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("body"))

    def save(part: Iterator) -> None:
        for r in part:
            storage.write(r["path"], r["body"].encode())

    rows.foreachPartition(save)


def copy_files(pairs: DataFrame) -> DataFrame:
    """Copies each row's file ``src`` to ``dst``; adds ``copied``. The copies are made when the result is read."""
    names = [*pairs.columns, "copied"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = []
            for src, dst in zip(f["src"], f["dst"]):
                try:
                    if src is None or dst is None:
                        raise FileNotFoundError(src)
                    storage.write(dst, storage.read(src))
                    done.append(True)
                except OSError:
                    done.append(False)
            yield f.assign(copied=done)[names]

    return pairs.mapInPandas(run, T.StructType([*pairs.schema.fields, T.StructField("copied", T.BooleanType())]))


def write_quarantine(records: DataFrame, out: str) -> int:
    """Copies the images of records in quarantine, as they are, into its folder; how many there are."""
    held = records.where("status = 'quarantine'")
    ext = F.when(payload.file_ext(F.col("source")) == "", ".jpg").otherwise(payload.file_ext(F.col("source")))
    pairs = held.select(F.col("source").alias("src"), F.concat(F.lit(f"{out}/quarantine/"), payload.safe_id(payload.stem(F.col("source"))), ext).alias("dst"))
    return copy_files(pairs).where("copied").count()


def deliver(spark: SparkSession, out: str, records: DataFrame | None = None) -> dict:
    """Copies the usable images into ``delivery`` under ranked names, writes the manifest, removes files it no longer names.

    Without ``records`` the sidecars are read. A row whose file can't be copied has no file name.
    """
    rows = sidecars.scan(spark, out) if records is None else records
    rows = ledger.latest(rows, "source", ("run_id", "seq"))
    rows = sidecars.quarantine_images(rows, sidecars.listing(spark, f"{out}/quarantine")).drop("out_path").withColumnRenamed("image", "out_path")
    ranked = reports.manifest(rows).join(rows.select(F.col("source").alias("origen"), F.col("out_path").alias("src")), "origen")
    table = f"{storage.shared_dir(spark)}/delivery_{uuid.uuid4().hex}"
    pairs = ranked.withColumn("dst", F.concat(F.lit(f"{out}/delivery/"), F.col("archivo_limpio")))
    try:
        copy_files(pairs).write.parquet(table)
        done = spark.read.parquet(table).withColumn("archivo_limpio", F.when(F.col("copied"), F.col("archivo_limpio")))
        total = reports.write_manifest(done.select("orden", "id", "archivo_limpio", "estado", "origen"), f"{out}/manifest_import.csv")
        delivered = done.where(F.col("archivo_limpio").isNotNull())
        there = sidecars.listing(spark, f"{out}/delivery").select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"))
        old = reports.orphans(there, delivered.select(F.col("archivo_limpio").alias("name")))
        
        def sweep(part: Iterator) -> None:
            for r in part:
                storage.remove(f"{out}/delivery/{r['name']}")

        old.foreachPartition(sweep)
        return {"delivery_dir": f"{out}/delivery", "manifest": f"{out}/manifest_import.csv", "delivered": delivered.count(), "total_manifest": total}
    finally:
        storage.delete(spark, table)


def stage(rows: DataFrame, folder: str) -> int:
    """Writes rows (name, content) as files below a folder, for sources that aren't folders; how many were written."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content in zip(f["name"], f["content"]):
                storage.write(f"{folder}/{name}", bytes(content))
            yield pd.DataFrame({"n": [len(f)]})

    got = rows.where(F.col("content").isNotNull()).select("name", "content").mapInPandas(run, "n long").agg(F.sum("n")).first()[0]
    return int(got or 0)


def write_report(row: dict, path: str, title: str) -> None:
    """A small report as JSON, and as Markdown beside it."""
    storage.write(path, json.dumps(row, ensure_ascii=False, indent=2, default=str).encode())
    lines = [f"# {title}", ""]
    for k, v in row.items():
        if isinstance(v, dict):
            lines += ["", f"## {k}", "", "| value | n |", "|-|-|", *(f"| {a} | {b} |" for a, b in v.items())]
        else:
            lines.append(f"- {k}: {v}")
    storage.write(path.removesuffix(".json") + ".md", ("\n".join(lines) + "\n").encode())
