"""Shared storage for intermediate tables.

Lineage is cut by writing Parquet to a folder that driver and executors share,
never by localCheckpoint. The folder comes from ``spark.checkpoint.dir``; only
where that is unset (tests, a laptop) the warehouse folder is used.
"""

from __future__ import annotations

import atexit
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_orilla"
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; removed when the driver ends."""
    path = f"{shared_dir(spark)}/orilla_{name}_{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_sweep)
    _made.append((spark, path))
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _sweep() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                drop(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone by now
            return


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: later stages neither
    recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _path_of[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove materialised tables that nothing reads any more, so that their disk is free before the driver ends."""
    for t in tables:
        drop(t.sparkSession, _path_of.pop(t))
