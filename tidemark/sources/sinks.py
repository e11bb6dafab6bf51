"""Sinks that give the same result when a write is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.dedup import absent_from, one_per_id
from tidemark.operators.upsert import upsert
from tidemark.sources.id_index import store_ids
from tidemark.sources.stored import BATCH, read_stored

EDIT_DATE = "edit_date"


def edit_store_schema(edits: DataFrame) -> T.StructType:
    return T.StructType([*edits.schema, T.StructField(EDIT_DATE, T.DateType()), T.StructField(BATCH, T.StringType())])


def write_edits(
    edits: DataFrame,
    path: str,
    batch: str,
    ties: tuple[str, ...] = ("raw",),
    same_date: bool = False,
) -> None:
    """Store the edits of one micro-batch, each id once over all batches and dates.

    ``batch`` must be unique to checkpoint and micro-batch, and the same when the
    micro-batch is replayed: it owns a folder, which a replay replaces whole, and
    its own earlier output is not among the rows an id counts as stored in. An index
    of ids tells which are redelivered; it is built when a store has none (see
    ``IdIndex``). ``same_date=True`` asks the rows of the batch's dates instead, for
    feeds that always redeliver an id with its first time. The batch is worked out
    once, into a folder that the next one reuses.
    """
    spark = edits.sparkSession
    # A leading underscore hides the folder from readers of the store.
    staged = f"{path}/_staged/{batch.rsplit('_', 1)[0]}"
    one_per_id(edits, ties=ties).withColumn(EDIT_DATE, F.to_date("dt")).write.mode("overwrite").parquet(staged)
    fresh = spark.read.schema(T.StructType([*edits.schema, T.StructField(EDIT_DATE, T.DateType())])).parquet(staged)
    schema = edit_store_schema(edits)
    index = store_ids(spark, path, schema)
    if same_date:
        dates = fresh.select(F.col(EDIT_DATE).alias("_date")).distinct()
        stored = read_stored(spark, path, schema).where(F.col(BATCH) != batch)
        stored = stored.join(dates, F.col(EDIT_DATE).eqNullSafe(F.col("_date")), "left_semi")
    else:
        stored = index.held(fresh, batch)
    home = f"{path}/{BATCH}={batch}"
    (
        absent_from(fresh, stored)
        .hint("rebalance", EDIT_DATE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(EDIT_DATE)
        .parquet(home)
    )
    # Last: a write that is cut short before is replayed, and takes the batch's ids anew.
    index.add(batch, read_stored(spark, home, fresh.schema))


def merge_batches(spark: SparkSession, path: str, schema: T.StructType, merged: str) -> None:
    """Copy a store of many small batches to ``merged``, in one batch of few files per date.

    Readers and the next run then use ``merged``; the old store stays as it is.
    """
    (
        read_stored(spark, path, schema)
        .drop(BATCH)
        .hint("rebalance", EDIT_DATE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(EDIT_DATE)
        .parquet(f"{merged}/{BATCH}=merged_0")
    )


def write_batch(rows: DataFrame, path: str, batch: str) -> None:
    """Store the rows of one micro-batch in a folder of their own."""
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def stage_upsert(
    updates: DataFrame,
    path: str,
    staged: str,
    keys: list[str],
    update_cols: list[str],
    order_by: list[str],
    partition: str,
) -> None:
    """Write the partitions of ``path`` that ``updates`` changes to ``staged``.

    ``partition`` must follow from the keys, as a date does from a timestamp; null
    is a partition like any other. Only the partitions named in the updates are
    kept for the merge, and none is touched.
    """
    touched = updates.select(F.col(partition).alias("_touched")).distinct()
    target = read_stored(updates.sparkSession, path, updates.schema)
    target = target.join(touched, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
    merged = upsert(target, updates, keys, update_cols, order_by)
    merged.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(staged)


def apply_staged(spark: SparkSession, staged: str, path: str, partition: str, schema: T.StructType) -> None:
    """Replace partitions of ``path`` by the staged ones; may be repeated.

    ``schema`` is that of the updates: it can't be told from folder names alone.
    """
    (
        read_stored(spark, staged, schema)
        .hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def as_messages(rows: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text for a topic; null fields are kept out of the text."""
    value = F.to_json(F.struct(*rows.columns)).alias("value")
    return rows.select(value) if key is None else rows.select(F.col(key).cast("string").alias("key"), value)


def forward(rows: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None) -> DataStreamWriter:
    """Send a stream to a Kafka topic; the connector must be on the class path."""
    return (
        as_messages(rows, key)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
