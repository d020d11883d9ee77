"""Streams: new image files as they arrive, and the lot fold as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orilla.operators.d0 import OUT, Fold, outcome


def watch_folder(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    """A stream of new files: path, modificationTime, length, content."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).option("maxFilesPerTrigger", per_trigger).load(folder)


def _fold(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    fold = Fold(state.get[0] if state.exists else None)
    rows = pd.concat(list(frames)).sort_values("source", kind="stable")
    out = [outcome(fold, r) for r in rows.to_dict("records")]
    state.update((fold.state,))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])


def fold_stream(rows: DataFrame) -> DataFrame:
    """The fold of ``d0`` over a stream of narrow rows; within a trigger a lot's rows go by source."""
    return rows.groupBy("lot").applyInPandasWithState(_fold, OUT, "state string", "append", GroupStateTimeout.NoTimeout)


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str):  # noqa: ANN201
    """Feeds micro-batches of what is there to ``step`` and stops; a restart goes on where it ended."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
