"""The stages of the corpus pipeline, each one operator's decision on documents.

Defined cases, the same in all stages: documents with a null or empty text are clean, share nothing, and stay until
they are packed as one end token; rows that repeat are kept or dropped alike, but near_dups keeps one of them; null
ids come last where ids decide; further columns, whatever their names, are carried along untouched; empty tables
give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla.llm import decontaminate, line_dedup, ngram_join, packing, toxicity
from orilla.shipping import ship


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't mark at its own threshold; it is fitted on sf_dir's labelled training rows."""
    ship(spark)
    model = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    flag = "predicted"
    while flag in docs.columns:
        flag += "_"
    return toxicity.score(docs, model, carry=flag).where(F.col(flag) == 0).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without blocks that an earlier one has; n_chars follows the text.

    A document that loses a block and has no word left is dropped; one that had none stays.
    """
    ship(spark)
    # the operator's own columns replace any of their names, so those travel beside it
    done = line_dedup.dedup_lines(docs.select("doc_id", "text", F.struct(*(docs[c] for c in docs.columns)).alias("row")))
    left = done.where((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_removed_lines") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
    return left.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def near_dups_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    ship(spark)
    return ngram_join.keep_first(docs, width=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no benchmark item contaminates."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of what is left."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
