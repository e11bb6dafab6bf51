"""What every micro-batch sink shares."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

logger = logging.getLogger(__name__)


def batch_name(batch: DataFrame, batch_id: int, checkpoint: str) -> str:
    """A name unique to checkpoint and micro-batch, equal when it is replayed.

    The query id is kept in the checkpoint, so a new one there starts new names.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    owner = query or hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    return f"{owner}_{batch_id:012d}"


def for_each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, str], None],
    checkpoint: str,
    mode: str = "append",
    skip_empty: bool = True,
    sample: int = 0,
    **trigger,
) -> StreamingQuery:
    """Start a query that hands each micro-batch and its name to ``write``.

    An empty batch is skipped unless asked for. ``sample`` rows of each batch are
    printed for inspection. ``trigger`` is that of ``DataStreamWriter``; by
    default the query works off what is there and stops.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not (skip_empty and batch.isEmpty()):
            if sample:
                batch.show(sample, truncate=False)
            write(batch, batch_name(batch, batch_id, checkpoint))

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def counted(rows: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """``rows`` with counters that are filled by the first action on them.

    ``seen`` counts all rows, the others those that meet a condition; read them
    from the observation's ``get`` after the action. No extra job is run.
    """
    metrics = [F.count(F.when(condition, 1)).alias(name) for name, condition in conditions.items()]
    observation = Observation()
    return rows.observe(observation, F.count(F.lit(1)).alias("seen"), *metrics), observation


def log_counts(name: str, counts: dict[str, int]) -> None:
    """The usual ``report``: one line per micro-batch."""
    logger.info("%s %s", name, counts)
