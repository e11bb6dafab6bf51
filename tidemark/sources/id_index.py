"""Which ids a store holds, without reading all of them for every batch.

The ids of a batch are a run of a levelled store (see ``levels``). Merged runs are
cut into bucket folders by a hash of the id, each with a bitmap of a second hash of
its ids. A batch reads the bitmaps of the buckets it has ids for, and opens only those
buckets of a run in which a bit of one of its ids is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.levels import Levels, Run, spans, split_name
from tidemark.sources.stored import BATCH, read_stored

BUCKET = "bucket"
PART = 32_768  # bits of one bitmap, as Spark's bitmap functions have them


class IdIndex:
    """Ids below ``path``; ``bits`` of bitmap per id, in ``buckets`` folders of a merged run."""

    def __init__(self, spark: SparkSession, path: str, key: str = "meta_id", buckets: int = 64, bits: int = 16, fan: int = 8):
        self.spark, self.key, self.buckets, self.bits = spark, key, buckets, bits
        self.levels = Levels(spark, path, fan, self._save)
        self.schema = T.StructType.fromDDL(f"`{key}` string, {BATCH} string")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _slot(self, slots: int) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit("slot")), F.lit(slots))

    def _save(self, rows: DataFrame, folder: str, level: int) -> None:
        """A small run is one table; a merged one has bucket folders and their bitmaps."""
        if not level:
            rows.coalesce(1).write.mode("overwrite").parquet(folder)
            return
        rows = rows.withColumn(BUCKET, self._bucket())
        rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        written = self._read_run(folder)
        slots = self._slots(written.count())
        slot = self._slot(slots)
        (
            written.groupBy(BUCKET, F.floor(slot / PART).alias("part"))
            .agg(F.bitmap_construct_agg((slot % PART).cast("long")).alias("bitmap"))
            .withColumn("slots", F.lit(slots))
            .hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .partitionBy(BUCKET)
            .parquet(f"{folder}-bitmaps")
        )

    def _slots(self, ids: int) -> int:
        """Bits of a bucket's bitmaps: a power of two, PART at least."""
        return max(PART, 1 << max(0, (ids * self.bits // self.buckets - 1)).bit_length())

    def _read_run(self, folder: str) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)

    def _bitmaps(self, run: Run) -> DataFrame:
        return self.spark.read.schema(f"part bigint, bitmap binary, slots bigint, {BUCKET} int").parquet(f"{run.folder}-bitmaps")

    def met(self, ids: DataFrame) -> dict[Run, list[int]]:
        """The buckets of each merged run that may hold one of ``ids``; at most buckets * runs pairs."""
        runs = [r for r in self.levels.runs() if r.level]
        if not runs:
            return {}
        touched = [r[0] for r in ids.select(self._bucket()).distinct().collect()]
        asked = ids.select(self.key, self._bucket().alias(BUCKET))
        found = None
        for k, run in enumerate(runs):
            maps = self._bitmaps(run).where(F.col(BUCKET).isin(touched))
            slots = F.col("slots")
            slot = F.pmod(F.xxhash64(self.key, F.lit("slot")), slots)
            byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            sized = asked.join(F.broadcast(maps.select(BUCKET, "slots").distinct()), BUCKET)
            placed = sized.select(BUCKET, F.floor(slot / PART).alias("part"), (slot % PART).alias("at"))
            hit = placed.join(maps.drop("slots"), [BUCKET, "part"]).where(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1)
            some = hit.select(F.lit(k).alias("run"), BUCKET).distinct()
            found = some if found is None else found.unionByName(some)
        out: dict[Run, list[int]] = {}
        for r in found.collect():
            out.setdefault(runs[r["run"]], []).append(r[BUCKET])
        return out

    def held(self, ids: DataFrame, other_than: str) -> DataFrame:
        """The ids among ``ids`` that another batch than ``other_than`` has stored."""
        small = [r for r in self.levels.runs() if not r.level]
        rows = self.levels.read(small, self.schema)
        for run, buckets in self.met(ids).items():
            folders = [f"{run.folder}/{BUCKET}={b}" for b in sorted(buckets)]
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(*folders))
        return rows.where(F.col(BATCH) != other_than).select(self.key).join(ids.select(self.key), self.key, "left_semi")

    def add(self, batch: str, ids: DataFrame) -> None:
        """Take ``ids`` as those that ``batch`` has stored, in place of any it had before."""
        for run in self.levels.runs():
            if run.level and run.holds(batch):
                self.levels.replace(run, self._read_run(run.folder).where(F.col(BATCH) != batch).drop(BUCKET))
        self.levels.add(batch, ids.select(self.key, F.lit(batch).alias(BATCH)))
        self.levels.compact(lambda rows: rows.select(self.key, BATCH))

    def build(self, stored: DataFrame) -> None:
        """Take over a store that has no index yet; ``stored`` has the key and the batch of all its rows."""
        if self.levels.state()[0]:
            return
        names = [r[0] for r in stored.select(BATCH).distinct().collect()]
        if names:
            whole = Run(1, f"{self.levels.path}/run-level1-1", spans([(o, n, n) for o, n in map(split_name, names)]))
            self._save(stored.select(self.key, BATCH), whole.folder, 1)
            self.levels.swap(1, [whole], [])


def store_ids(spark: SparkSession, path: str, stored_schema: T.StructType, key: str = "meta_id", **options) -> IdIndex:
    """The index of a store of batches, built from its rows if it has none."""
    index = IdIndex(spark, f"{path}/_ids", key, **options)
    index.build(read_stored(spark, path, stored_schema))
    return index
