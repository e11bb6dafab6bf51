"""Helpers shared by the operators: Arrow text, running totals, files, components."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import run_dir, written

#: Translates A-Z to lower case and leaves all other bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

Batches = Iterator[pa.RecordBatch]


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's UTF-8 bytes, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def spare(name: str, taken: list[str]) -> str:
    """``name``, or a variant of it that no column of ``taken`` has."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless PYTHONPATH already leads them to it."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _SHIPPED:
        return
    name = f"{tempfile.mkdtemp(prefix='tidemark-')}/tidemark"
    context.addPyFile(shutil.make_archive(name, "zip", root, "tidemark"))
    _SHIPPED.add(context.applicationId)


_KEPT: dict[str, object] = {}


def keep(name: str, make: Callable[[], object]):
    """What a worker process keeps from task to task, one thing at a time."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    _KEPT.clear()


def in_arrow(df: DataFrame, function: Callable[[Batches], Batches], schema: str, keeps: bool = False) -> DataFrame:
    """``mapInArrow``: one pass, no shuffle.

    Workers are used again by later stages; one whose task ``keeps`` nothing gives
    back what an earlier operator's tasks have kept.
    """
    ship(df.sparkSession)

    def run(batches: Batches) -> Batches:
        if not keeps:
            forget()
        yield from function(batches)

    return df.mapInArrow(run, schema)


def with_columns(
    df: DataFrame, source: Column, added: dict[str, str], function: Callable[[pa.Array], list[pa.Array]], keeps: bool = False,
    most: int = 4_000_000,
) -> DataFrame:
    """``df`` with the columns ``added`` (name to type), which ``function`` makes from slices of ``source``.

    A slice holds rows of at most ``most`` bytes or entries in total, or one larger
    row. Columns of ``df`` with an added name are replaced, others pass through.
    """
    new = {name.lower() for name in added}
    rest = [c for c in df.columns if c.lower() not in new]
    # Names of their own: Spark's Python operators don't take all names that columns may have.
    given = [f"c{i}" for i in range(len(rest))]
    made = [f"d{i}" for i in range(len(added))]
    rows = df.select(*(F.col(f"`{c}`").alias(g) for c, g in zip(rest, given, strict=True)), source.alias("given"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
            for begin, end in row_runs(np.asarray(length(column).fill_null(0)), most):
                some = batch.slice(begin, end - begin)
                columns = [*some.columns[:-1], *function(some.column(some.num_columns - 1))]
                yield pa.RecordBatch.from_arrays(columns, names=[*given, *made])

    kinds = [*(f.dataType.simpleString() for f in rows.schema.fields[:-1]), *added.values()]
    ddl = ", ".join(f"{name} {kind}" for name, kind in zip([*given, *made], kinds, strict=True))
    return in_arrow(rows, run, ddl, keeps).toDF(*rest, *added)


def row_runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of rows of at most ``most`` in total size; a row larger than that is alone."""
    begin, total = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > begin and total + n > most:
            yield begin, k
            begin, total = k, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def summed(parts: DataFrame, column: str, size: int) -> np.ndarray:
    """The sum of the tasks' arrays of ``size`` numbers, place by place.

    Spark adds the places up, so no task or group holds more than its own array.
    """
    each = parts.select(F.posexplode(column).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[each.column("at").to_numpy()] = each.column("v").to_numpy()
    return out


def poly_hash(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` word hashes."""
    out = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        out = (out + words[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits evenly; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x100000001B3  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept per process in steps of two."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(buffer: bytes, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes, starts and ends of the runs of bytes marked by ``word_byte``.

    A word's hash is a polynomial in its bytes, had from running sums: two
    different words share it with a chance of about 2**-64.
    """
    data = np.frombuffer(buffer, np.uint8)
    if not len(data):
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty
    gaps = np.flatnonzero(np.frombuffer(buffer.translate((~word_byte).tobytes()), bool))
    starts, ends = np.concatenate(([0], gaps + 1)), np.append(gaps, len(data))
    words = ends > starts
    starts, ends = starts[words], ends[words]
    hashes = np.empty(len(starts), np.uint64)
    # Pieces of whole words keep the table of powers small and the sums in the cache.
    step = 1 << 16
    sums, first = np.zeros(step + 1, np.uint64), 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + step, "right")))
        size = int(ends[last - 1] - low)
        if size >= len(sums):
            sums = np.zeros(size + 1, np.uint64)
        up, down = _powers(size + 1)
        each = sums[1 : size + 1]
        np.add(data[low : low + size], 1, out=each, dtype=np.uint64)
        each *= up[:size]
        np.cumsum(each, out=each)
        s, e = starts[first:last] - low, ends[first:last] - low
        hashes[first:last] = mix((sums.take(e) - sums.take(s)) * down.take(s) + (e - s).view(np.uint64))
        first = last
    return hashes, starts, ends


def bytes_where(*ranges: tuple[int, int], invert: bool = False) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return ~found if invert else found


#: Bytes of words cut at space and 0x09 to 0x0D.
SPACED = bytes_where((0x20, 0x20), (0x09, 0x0D), invert=True)


def start_totals(df: DataFrame, ordinal: str, value: str, new: str, block: int = 4096) -> DataFrame:
    """Adds the sum of ``value`` over all smaller ordinals, for one row per ordinal.

    Totals are run within blocks of ordinals and then over the blocks, so the
    largest group has ``block`` rows and the one over blocks 1/block of them.
    """
    from pyspark.sql import Window

    part = F.floor(F.col(ordinal) / block)
    rows = df.withColumn("_block", part)
    blocks = rows.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_block").orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(blocks, "_block")
        .withColumn(new, (F.col("_in") + F.col("_base")).cast("long"))
        .drop("_block", "_in", "_base")
    )


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of each connected component, for nodes in edges.

    Alternates the large-star and small-star steps: each round reads the edges
    once per step, keeps at most one edge per (node, neighbour) and halves the
    distance to the root. Each step groups by node with minima that are combined
    before the shuffle, so a hub with any number of neighbours costs no single
    task more than its own rows' minima. Every round is written to the shared
    folder, which cuts the lineage.
    """
    spark = edges.sparkSession
    pairs = written(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    for _ in range(rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours above a node go to its smallest neighbour.
        up = pairs.select(F.col("v").alias("u"), F.col("u").alias("x")).join(lowest, "u").select(
            F.col("x").alias("u"), F.col("m").alias("v")
        )
        # Small star: a node and its lower neighbours go to the smallest of them.
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*")
        new = written(down.where("u != v").distinct(), "edges")
        done = (
            new.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
            == pairs.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        )
        pairs = new
        if done:
            nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def one_by_one(files: DataFrame, count: int, key: str = "path", most: int = 20_000) -> DataFrame:
    """A list of ``count`` files dealt out so that tasks get one file each, or an equal share of very many.

    Ranges of so few keys are cut exactly; adaptive execution leaves a stated number
    of partitions as it is, where it would merge those of a short list.
    """
    return files.repartitionByRange(max(1, min(count, most)), key)


def new_folder(df: DataFrame, name: str) -> str:
    return run_dir(df.sparkSession, name)


def put_file(folder: str, name: str, content: bytes) -> str:
    """Write one file so that a repeated or lost task leaves a whole file or none.

    The content goes to a name of its own and is then moved to its place.
    """
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{uuid.uuid4().hex}"
    with store.open_output_stream(draft, compression=None) as out:
        out.write(content)
    store.move(draft, f"{path}/{name}")
    return f"{path}/{name}"


def file_system(uri: str):
    """The store and path of a URI; a plain path is local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
