"""The corpus pipeline: five stages of the llm subpackage over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet to the shared folder and reads it back as the
next one's input. All but the last return the columns of documents. What
language-model labels and benchmark items the stages need, they read from sf_dir.

toxicity     documents that the classifier marks as toxic go
line_dedup   aligned blocks that an earlier document has go; so do documents of which no word is left
near_dups    of each group of near duplicates (5-word shingles, Jaccard 0.8) the smallest id stays
decontaminate  documents that hold half a benchmark item or more go
packing      what is left is cut and packed into sequences of 4096 tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orilla.llm import pipeline_stages as stages
from orilla.llm import workspace
from orilla.shipping import ship

STAGES = [
    ("toxicity", stages.toxicity_stage),
    ("line_dedup", stages.line_dedup_stage),
    ("near_dups", stages.near_dups_stage),
    ("decontaminate", stages.decontaminate_stage),
    ("packing", stages.packing_stage),
]
#: SQL can't train the classifier nor encode tokens; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over the whole table."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workspace.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
