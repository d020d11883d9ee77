"""Read-only SQL sources: guard, column candidates, scan plan, scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: what image columns are often called, and their types
NAME_HINTS = ("blob", "longblob", "mediumblob", "bytea", "image", "photo", "foto", "path", "file", "data")
TYPE_HINTS = ("blob", "bytea", "largebinary", "varbinary")
COMMANDS = ("Command", "InsertInto", "DeleteFrom", "UpdateTable", "MergeInto", "CreateTable", "DropTable", "AlterTable", "Truncate", "ReplaceTable", "Call", "SetCatalog", "UseNamespace", "CompoundBody")


def assert_read_only(spark: SparkSession, statement: str) -> str:
    """The statement, if it is one query; else ValueError.

    Spark's parser takes exactly one statement; writing nodes are refused wherever they stand.
    """
    text = statement.lstrip("﻿ \t\r\n").rstrip("; \t\r\n")
    if not text[:6].lower().startswith(("select", "with", "(selec")):
        raise ValueError("only SELECT or WITH statements are allowed")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:
        raise ValueError("not a single readable query") from e
    shown = plan.treeString()
    nodes = [line.lstrip(" +-:'!").split(" ")[0] for line in shown.splitlines()]
    if any(n.startswith(c) or n.endswith("Command") for n in nodes for c in COMMANDS):
        raise ValueError("the statement writes")
    return text


def candidates(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> DataFrame:
    """table, column, type of the columns that may hold images, by name or type; reads no data."""
    jvm = spark.sparkContext._jvm
    p = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        p.setProperty(k, v)
    con = jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry and jvm.java.sql.DriverManager.getConnection(url, p)
    rows = []
    try:
        cols = con.getMetaData().getColumns(None, None, "%", "%")
        while cols.next():
            table, name, kind = cols.getString("TABLE_NAME"), cols.getString("COLUMN_NAME"), cols.getString("TYPE_NAME")
            if not (cols.getString("TABLE_SCHEM") or "").upper().startswith("SYS") and (any(h in name.lower() for h in NAME_HINTS) or any(h in kind.lower() for h in TYPE_HINTS)):
                rows.append((table, name, kind))
    finally:
        con.close()
    return spark.createDataFrame(rows, "table string, column string, type string")


def plan_scan(table: str, column: str, batch: int = 50, quote: str = '"') -> dict:
    """What a scan will run, to be shown before it does."""
    q = lambda s: quote + s.replace(quote, quote * 2) + quote
    return {"table": table, "column": column, "statement": f"SELECT {q(column)} FROM {q(table)}", "streaming": True, "batch": batch, "mode": "read-only"}


def scan(spark: SparkSession, url: str, statement: str, batch: int = 50, partition: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A guarded query's rows; ``partition`` is (column, lower, upper, number) for parallel reads."""
    text = assert_read_only(spark, statement)
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", batch).options(**options)
    if partition is None:
        return reader.option("query", text).load()
    column, lower, upper, n = partition
    return reader.option("dbtable", f"({text}) q").option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", n).load()
