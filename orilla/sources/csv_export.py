"""CSV exports of unknown make: delimiter, columns, cells that were split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla.functions import payload

DELIMITERS = (",", ";", "\t", "|")


def delimiter(head: str) -> str:
    """The delimiter that splits the header into most cells; comma if none does."""
    line = head.lstrip("﻿").splitlines()[0] if head.strip() else ""
    return max(DELIMITERS, key=lambda d: (line.count(d), -DELIMITERS.index(d))) if line else ","


def resolve(columns: list[str], wanted: str) -> str:
    """The column of that name, else the first whose name holds it, whatever the case."""
    for c in columns:
        if c.strip().lower() == wanted.lower():
            return c
    for c in columns:
        if wanted.lower() in c.lower():
            return c
    raise ValueError(f"no column like {wanted!r} among {columns}")


def read_export(spark: SparkSession, path: str, image: str = "foto", ident: str = "id", limit: int | None = None) -> DataFrame:
    """delivery_id, payload and decoded bytes of every row of a file, or of all CSV files in a folder with one header.

    The delimiter is sniffed from the first line. A data-URL that was split at an unquoted comma is put
    together again from the cells after it, as many as a line has; other cells keep their places, empty or not.
    """
    lines = spark.read.text(path, lineSep="\n")
    first = lines.limit(1).first()
    sep = delimiter((first["value"] if first else "").rstrip("\r"))
    options = {"sep": sep, "multiLine": True, "escape": '"', "maxCharsPerColumn": -1, "enforceSchema": True}
    head = spark.read.options(header=True, **options).csv(path).columns
    names = [c.lstrip("\ufeff") for c in head]
    col, key = resolve(names, image), resolve(names, ident)
    at, own = names.index(col), names.index(key)
    # no line has more cells than separators and one
    most = lines.agg(F.max(F.size(F.split("value", "\\Q" + sep + "\\E", -1))).alias("n")).first()["n"] or 1
    columns = [f"c{i}" for i in range(max(len(names), most))]
    raw = spark.read.options(header=False, **options).schema(", ".join(f"{c} string" for c in columns)).csv(path)
    title = [F.coalesce(F.regexp_replace(F.col(c), "\ufeff", ""), F.lit("")) == n for c, n in zip(columns, head if head == names else names)]
    rows = raw.where(~reduce(Column.__and__, title)).select(F.array(*columns).alias("cells"))
    moved = payload.split_fragments(F.col("cells"), at) if own > at else F.lit(0)
    rows = rows.select(F.get("cells", F.lit(own) + moved).alias("id"), payload.repair_split_cells(F.col("cells"), at).alias("payload"))
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(payload.safe_id(F.col("id")).alias("delivery_id"), "payload", payload.decode_text(F.col("payload")).alias("bytes")).withColumn("ext", payload.image_ext(F.col("bytes")))
