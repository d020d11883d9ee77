"""Sidecar files of earlier runs, and the images that belong to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla.functions import payload
from orilla.operators.ledger import RECORD

# fixed values: reports that aren't sidecars
IGNORED = ("checkpoint.json", "checkpoint.jsonl", "eda_report.json", "inspect.json", "row_probe.json")


def is_sidecar_name(path: Column) -> Column:
    """JSON files that aren't hidden and aren't reports."""
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    return name.endswith(".json") & ~name.startswith(".") & ~name.isin(*IGNORED)


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all sidecars below a folder: objects with a source; unreadable files are left out."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(folder, wholetext=True).withColumn("path", F.input_file_name())
    found = files.where(is_sidecar_name(F.col("path"))).select(F.from_json("value", RECORD).alias("r")).where(F.col("r.source").isNotNull())
    return found.select("r.*")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """path and stem of a folder's files, contents unread; no rows if there is no folder."""
    from orilla import storage

    if not storage.exists(spark, folder):
        return spark.createDataFrame([], "path string, stem string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", payload.stem(F.col("path")).alias("stem"))


def quarantine_images(records: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``image``: the first file in quarantine that has the source's stem, else out_path.

    files: path and stem of the quarantine folder.
    """
    first = files.where(~F.lower("path").endswith(".json")).groupBy("stem").agg(F.min("path").alias("_image"))
    own = records.withColumn("_stem", payload.safe_id(payload.stem(F.col("source"))))
    found = own.join(first.withColumnRenamed("stem", "_stem"), "_stem", "left")
    image = F.when(F.col("status") == "quarantine", F.coalesce("_image", F.nullif(F.col("out_path"), F.lit("")))).otherwise(F.nullif(F.col("out_path"), F.lit("")))
    return found.withColumn("image", image).drop("_stem", "_image")


def before_after(inputs: DataFrame, results: DataFrame, quarantine: DataFrame) -> DataFrame:
    """before, after, in_quarantine: each input with the result of its stem, else with its file in quarantine, else with none.

    All three have path and stem; of several results the first counts.
    """
    first = lambda files, name: files.groupBy("stem").agg(F.min("path").alias(name))
    both = inputs.select(F.col("path").alias("before"), "stem").join(first(results, "_done"), "stem", "left").join(first(quarantine, "_held"), "stem", "left")
    return both.select("stem", "before", F.coalesce("_done", "_held").alias("after"), (F.col("_done").isNull() & F.col("_held").isNotNull()).alias("in_quarantine"))
