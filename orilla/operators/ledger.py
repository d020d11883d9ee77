"""The ledger of processed sources: resume, latest record, audit, checkpoint, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = (
    "source string, sha256 string, orig_wh struct<w:int,h:int>, crop_box struct<x:int,y:int,w:int,h:int>, sides array<string>, method string, confidence double, face_safety_ok boolean, face_detected boolean, skew_angle double, elapsed_ms bigint, status string, error string, quarantine_reason string, out_path string, dry_run boolean, delivery_id string, run_id string, seq bigint"
)
STATUSES = ("ok", "noop", "quarantine", "failed")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All intact records of a JSON-lines ledger; a torn last line is left out."""
    return spark.read.schema(RECORD).option("mode", "DROPMALFORMED").json(path).where(F.col("source").isNotNull())


def append(records: DataFrame, path: str) -> None:
    """Appends records in the fixed schema; the commit protocol makes it all or nothing."""
    have = {f.name for f in records.schema.fields}
    fields = records.sparkSession.createDataFrame([], RECORD).schema.fields
    records.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields)).write.mode("append").json(path)


def todo(files: DataFrame, done: DataFrame, key: str = "source", retry_failed: bool = False) -> DataFrame:
    """Files that the ledger has no record of: a left anti join."""
    seen = done.where(F.col("status") != "failed") if retry_failed else done
    return files.join(seen.select(key), key, "left_anti")


def skipped(files: DataFrame, done: DataFrame, key: str = "source") -> DataFrame:
    return files.join(done.select(key), key, "left_semi")


def latest(records: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The last record of each key, by one map-side combined aggregation."""
    rest = [c for c in records.columns if c != key]
    return records.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def status_tally(records: DataFrame, status: str = "status", values: tuple[str, ...] = STATUSES) -> DataFrame:
    return records.agg(F.count("*").alias("total"), *(F.count_if(F.col(status) == v).alias(v) for v in values))


def audit(records: DataFrame) -> DataFrame:
    """The audit's eight columns."""
    b = F.col("crop_box")
    return records.select("source", "sha256", "status", "method", "confidence", F.when(b.isNotNull(), F.concat_ws(",", b["x"], b["y"], b["w"], b["h"])).alias("crop_box"), "elapsed_ms", "error")


def reconcile(sources: DataFrame, records: DataFrame, key: str = "source") -> DataFrame:
    """Per kind of difference the number of keys: missing, unexpected, duplicate, matched."""
    a = sources.select(key).distinct().withColumn("in_sources", F.lit(True))
    b = records.groupBy(key).agg(F.count("*").alias("n_records"))
    kind = F.when(F.col("n_records").isNull(), "missing").when(F.col("in_sources").isNull(), "unexpected").when(F.col("n_records") > 1, "duplicate").otherwise("matched")
    return a.join(b, key, "full_outer").select(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def progress(done: int, this_run: int, total: int, seconds: float) -> dict:
    """Speed, remaining time and percentage of a run."""
    speed = this_run / seconds if seconds > 0 else 0.0
    left = max(total - done, 0)
    return {"total_files": total, "total_completed": done, "processed_this_run": this_run, "percent": round(100 * done / total, 2) if total else 100.0, "speed_fps": round(speed, 3), "eta_seconds": int(left / speed) if speed else 0}


def running(records: DataFrame, lot: str, at: str) -> DataFrame:
    """Per lot and time the number of records, how many are done by then, and the percentage.

    Records are counted before the window, which sees one row for each time.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(lot)
    done = F.sum("n").over(w.orderBy(at))
    counted = records.groupBy(lot, at).agg(F.count("*").alias("n"))
    return counted.select(lot, at, "n", done.alias("done"), F.round(100.0 * done / F.sum("n").over(w), 2).alias("percent"))


def numbered(records: DataFrame, name: str, order: tuple[str, ...]) -> DataFrame:
    """Duplicate names get a running suffix: name, name_1, name_2, ..."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(name).orderBy(*order)) - 1
    return records.withColumn("n", n).withColumn("unique_name", F.when(F.col("n") == 0, F.col(name)).otherwise(F.concat_ws("_", F.col(name), F.col("n"))))
