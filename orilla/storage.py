"""Files beside tables, on whatever storage Spark's paths name: the driver and all executors see the same."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share: spark.checkpoint.dir, else below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (base or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_orilla").rstrip("/")


def _hadoop(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def _open(path: str):  # noqa: ANN202
    """The file system of a path and the path within it; works on executors, too."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write(path: str, data: bytes) -> None:
    """Writes a file beside its place and moves it there: it appears whole or not at all."""
    f, p = _open(path)
    f.create_dir(p.rpartition("/")[0] or ".", recursive=True)
    part = f"{p}.{uuid.uuid4().hex}.part"
    with f.open_output_stream(part) as out:
        out.write(data)
    f.move(part, p)


def read(path: str) -> bytes:
    f, p = _open(path)
    with f.open_input_stream(p) as source:
        return source.read()


def remove(path: str) -> None:
    """Removes a file if it is there."""
    f, p = _open(path)
    try:
        f.delete_file(p)
    except FileNotFoundError:
        pass


def names(path: str) -> list[str]:
    """The names of a folder's files; none if it isn't there."""
    from pyarrow import fs

    f, p = _open(path)
    return sorted(x.base_name for x in f.get_file_info(fs.FileSelector(p, allow_not_found=True)) if x.is_file)
