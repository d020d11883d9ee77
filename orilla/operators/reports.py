"""Reports over the ledger and over folders: QA, exploratory profile, manifest, gallery."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orilla.functions import boxes, payload

USABLE = ("ok", "noop", "quarantine")


def qa(records: DataFrame) -> DataFrame:
    """total, a count per status, and the sorted sources in quarantine."""
    return records.agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in (*USABLE, "failed")), F.array_sort(F.collect_list(F.when(F.col("status") == "quarantine", F.col("source")))).alias("quarantine_sources"))


def top_modes(rows: DataFrame, value: str, n: int = 5) -> DataFrame:
    """The n commonest values; ties by value."""
    return rows.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc("n"), value).limit(n)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The same n rows for the same seed, whatever the partitioning."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary")), key).limit(n)


def eda(files: DataFrame, profiles: DataFrame, seconds_per_image: float, workers: tuple[int, ...] = (1, 4, 8), scaling: tuple[float, ...] = (1.0, 1.40, 1.67)) -> DataFrame:
    """One row on a folder: sizes, formats, verdicts and resolutions of the sample, estimated times.

    files: path, length. profiles: width, height and status of the sample, "failed" where an image can't be
    read. The scaling factors are measured ones.
    """
    form = files.groupBy(payload.file_ext(F.col("path")).alias("ext")).agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("ext", "n")))).alias("formats"))
    size = files.agg(F.count("*").alias("total_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
    tally = lambda rows, key: rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("m"))
    counts = lambda rows, value: rows.groupBy(value.alias("k")).agg(F.count("*").alias("n"))
    read = profiles.where("status <> 'failed'")
    size_of = F.concat_ws("x", F.col("width").cast("int"), F.col("height").cast("int"))
    parts = {"verdicts": counts(profiles, F.col("status")), "ratios": counts(read, boxes.ratio_label(F.col("width"), F.col("height"))), "resolutions": top_modes(read.withColumn("k", size_of), "k")}
    means = profiles.agg(F.count("*").alias("sampled"), F.count_if(F.col("status") == "failed").alias("corrupt"), *(F.coalesce(F.bround(F.avg(F.when(F.col("status") != "failed", F.col(c)))), F.lit(0)).cast("long").alias(f"avg_{c}") for c in ("width", "height")))
    out = size
    for one in (form, means, *(tally(rows, "k").withColumnRenamed("m", name) for name, rows in parts.items())):  # one row each
        out = out.join(F.broadcast(one))
    for n, k in zip(workers, scaling):
        out = out.withColumn(f"eta_{n}_workers", payload.duration(F.col("total_files") * seconds_per_image / k))
    return out.withColumn("disk_mb", F.round(F.col("total_bytes") * 0.9 / 1e6, 1))


def manifest(records: DataFrame) -> DataFrame:
    """orden, id, archivo_limpio, estado, origen: usable rows ranked by lower id, failed ones after them.

    The rank is counted in two steps: within ranges of the ordered ids, then over the
    ranges' sizes, so that no single task sorts all rows.
    """
    ident = payload.safe_id(payload.delivery_id(F.col("delivery_id"), F.col("source")))
    own = records.withColumn("id", ident).withColumn("ext", payload.file_ext(F.coalesce("out_path", "source")))
    good = ranked(own.where(F.col("status").isin(*USABLE)), [F.lower("id"), F.col("source")], "orden")
    name = payload.delivery_name(F.col("orden"), F.col("id"), F.col("ext"))
    first = good.select(F.col("orden").cast("int").alias("orden"), "id", name.alias("archivo_limpio"), F.col("status").alias("estado"), F.col("source").alias("origen"))
    bad = own.where(F.col("status") == "failed").select(F.lit(None).cast("int").alias("orden"), "id", F.lit(None).cast("string").alias("archivo_limpio"), F.col("status").alias("estado"), F.col("source").alias("origen"))
    return first.unionByName(bad)


def ranked(rows: DataFrame, order: list, name: str) -> DataFrame:
    """1..n over all rows in a total order, without a window over one partition."""
    keys = [f"_k{i}" for i in range(len(order))]
    cut = rows.select("*", *(c.alias(k) for c, k in zip(order, keys))).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    sizes = cut.groupBy("_part").agg(F.count("*").alias("_n"))  # one row for each partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cut.withColumn("_w", within).join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part").withColumn(name, F.col("_w") + F.col("_before")).drop("_part", "_w", "_before", *keys)


def write_manifest(rows: DataFrame, path: str) -> int:
    """The manifest as one UTF-8 CSV file with a byte order mark, rows streamed through the driver."""
    import csv

    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(["orden", "id", "archivo_limpio", "estado", "origen"])
        for r in rows.orderBy(F.col("orden").isNull(), "orden", "origen").toLocalIterator():
            w.writerow(["" if v is None else v for v in r])
            n += 1
    return n


def orphans(existing: DataFrame, wanted: DataFrame, name: str = "name") -> DataFrame:
    """Delivered files that the manifest no longer has."""
    return existing.where(F.col(name).rlike(r"_crop\.[^.]*$")).select(name).subtract(wanted.select(name))


def gallery(records: DataFrame, path: str, limit: int = 500) -> None:
    """A static page with counts and one card per record, in order of the source."""
    counts = {r["status"]: r["n"] for r in records.groupBy("status").agg(F.count("*").alias("n")).collect()}
    with open(path, "w", encoding="utf-8") as f:
        f.write("<!DOCTYPE html><meta charset=utf-8><title>Gallery</title><h1>" + html.escape(json.dumps(counts, sort_keys=True)) + "</h1>\n")
        for r in records.orderBy("source").limit(limit).toLocalIterator():
            label = html.escape(f"{r['source']} | {r['status']} | {r['method']}")
            f.write(f'<figure class="{html.escape(r["status"] or "")}"><img loading=lazy src="{html.escape(r["out_path"] or "")}"><figcaption>{label}</figcaption></figure>\n')


def write_json(row: dict, path: str) -> None:
    """A small report, written beside and then renamed."""
    part = Path(f"{path}.part")
    part.write_text(json.dumps(row, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    part.replace(path)
