"""Token counts through a digest cache (operator 6).

A text's normalised content (null counts as empty) is digested, and so are the
tokenizer's file and the library's version. Stored counts are joined by both
digests; each distinct text that has none is encoded once by the library, and
its count is appended to the cache.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Rows that repeat,
null ids and further columns change nothing: one row comes out for each row in,
with the id column as it was. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla.llm import pieces, workspace
from orilla.llm import textkernel as tk

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer's version: its file's content and the library's release."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()[:32]


def content_digest(text: Column) -> Column:
    """128 bits of the normalised content's SHA-256."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def encode_counts(texts: DataFrame, path: str, keep_space: bool, lower: bool) -> DataFrame:
    """(digest, n_tokens) of (digest, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = pieces.encoder(path, keep_space, lower)
        for b in batches:
            text, counts = b.column("text"), np.zeros(b.num_rows, np.int64)
            for a, z in pieces.row_slices(text):
                counts[a:z] = enc.encode(text.slice(a, z - a), want_ids=False)[0]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(counts)], ["digest", "n_tokens"])

    return texts.mapInArrow(tk.released(run), "digest binary, n_tokens long")


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """The stored counts of one tokenizer version; None if there is no cache yet."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == version).select("digest", "n_tokens")


def count_tokens(docs: DataFrame, path: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, keep_space: bool = True, lower: bool = False) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row; ``cache`` is a folder that grows by the misses.

    The texts are shuffled once, deduplicated before the shuffle; ids only meet the counts.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    cache = cache or workspace.fresh_path(spark, "token_cache")
    rows = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", content_digest(F.col("text")))
    known = read_cache(spark, cache, version)
    missing = rows.select("digest", "text")
    if known is not None:
        missing = missing.join(known.select("digest"), "digest", "left_anti")
    misses = missing.groupBy("digest").agg(F.first("text").alias("text"))
    encode_counts(misses, path, keep_space, lower).withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache)
    stored = read_cache(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    out = rows.select(id_col, "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(stored, "digest")
    return out.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
