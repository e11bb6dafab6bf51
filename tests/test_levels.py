"""The levelled store and the index of ids."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.sources.id_index import IdIndex
from tidemark.sources.levels import Levels
from tidemark.sources.sinks import BATCH, edit_store_schema, write_edits
from tidemark.sources.stored import read_stored


def _sums(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def _total(store):
    return {r.k: r.n for r in _sums(store.read()).collect()}


@pytest.fixture
def store(spark, tmp_path):
    return Levels(spark, str(tmp_path / "store"), fan=3)


def _batch(rows, number):
    return rows([("a", number), ("b", 1)], "k string, n bigint").coalesce(1)


def test_batches_are_merged_level_by_level(store, rows):
    for number in range(11):
        store.add(f"q_{number:012d}", _batch(rows, number))
        store.compact(_sums)
        # The newest batch stays alone; every level has fewer than ``fan`` merged runs.
        assert len(store.runs()) <= 3 * (1 + math.log(number + 1, 3)) + 1
    assert _total(store) == {"a": sum(range(11)), "b": 11}
    assert len(store.read().inputFiles()) <= 10
    spans = [(low, high) for r in store.runs() for _, low, high in r.batches]
    assert sorted(n for low, high in spans for n in range(low, high + 1)) == list(range(11))


def test_replayed_and_cut_short_batches(store, rows, monkeypatch):
    store.add("q_0", _batch(rows, 5))
    store.add("q_0", _batch(rows, 7))
    assert _total(store) == {"a": 7, "b": 1}
    for number in range(1, 4):
        store.add(f"q_{number}", _batch(rows, number))

    # A crash between a merge's rows and the list, and between a batch's rows and the list.
    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "swap", crash)
        for step in (lambda: store.compact(_sums), lambda: store.add("q_4", _batch(rows, 100))):
            with pytest.raises(RuntimeError, match="lost"):
                step()
    assert _total(store) == {"a": 13, "b": 4}
    store.add("q_4", _batch(rows, 4))
    assert store.compact(_sums) == 1
    assert _total(store) == {"a": 17, "b": 5} and [r.level for r in store.runs()] == [1, 0]


def test_owners_and_vacuum(store, rows):
    for owner in ("p", "q"):
        for number in range(4):
            store.add(f"{owner}_{number}", _batch(rows, number))
    store.compact(_sums)
    assert _total(store) == {"a": 12, "b": 8}
    # The newest batch of both owners is still a run of its own.
    assert sorted(r.batches[0][0] for r in store.runs() if not r.level) == ["p", "q"]
    assert store.vacuum() == 6 and store.vacuum() == 0
    assert _total(store) == {"a": 12, "b": 8}
    store.add("q_3", _batch(rows, 10))
    assert _total(store) == {"a": 19, "b": 8}


def _ids(rows, numbers):
    return rows([(f"id{n}",) for n in numbers], "meta_id string").coalesce(1)


def test_index_opens_only_buckets_it_may_meet(spark, rows, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), buckets=8, fan=4)
    for number in range(14):
        index.add(f"q_{number}", _ids(rows, range(20 * number, 20 * number + 20)))
    assert index.held(_ids(rows, range(440, 460)), "q_22").count() == 0
    merged = [r for r in index.levels.runs() if r.level]
    small = [r for r in index.levels.runs() if not r.level]
    assert len(merged) <= 6 and len(small) <= 5
    # Ids that were never stored set few bits: hardly a bucket is opened for them.
    strange = _ids(rows, range(5000, 5040))
    assert sum(map(len, index.met(strange).values())) <= 4
    again = _ids(rows, [3, 270, 5000])
    assert {r[0] for r in index.held(again, "q_50").collect()} == {"id3", "id270"}
    opened = {run.level: buckets for run, buckets in index.met(_ids(rows, [3])).items()}
    assert sum(map(len, opened.values())) <= 2
    # A batch doesn't count as the holder of its own ids, even when it was merged long ago.
    assert index.held(_ids(rows, [3]), "q_0").count() == 0
    index.add("q_0", _ids(rows, [1]))
    assert {r[0] for r in index.held(_ids(rows, [1, 3, 25]), "q_50").collect()} == {"id1", "id25"}


def test_files_read_by_a_batch_do_not_grow(spark, rows, tmp_path):
    """Fifty batches, then one with an id that comes again under another date."""
    path = str(tmp_path / "stored")

    def edits(data):
        return rows(data, "meta_id string, raw string, day string").withColumn("dt", F.col("day").cast("timestamp")).drop("day")

    index = IdIndex(spark, f"{path}/_ids")
    for number in range(50):
        index.add(f"q_{number:012d}", rows([(f"{number}-{k}",) for k in range(4)], "meta_id string").coalesce(1))
    fresh = edits([("3-1", "r", "2025-05-05"), ("new", "r", "2025-05-05")])
    files = index.held(fresh, "q_50").inputFiles()
    assert 0 < sum("/run-" in f for f in files) <= 12
    write_edits(fresh, path, "q_50")
    assert [r.meta_id for r in read_stored(spark, path, edit_store_schema(edits([]))).collect()] == ["new"]


def test_index_of_a_store_that_has_none(spark, rows, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), buckets=4)
    rows_of = rows([("x", "a_0"), ("y", "a_1"), ("z", "b_0")], f"meta_id string, {BATCH} string")
    index.build(rows_of)
    index.build(rows_of)
    asked = rows([("x",), ("y",), ("w",)], "meta_id string")
    assert {r[0] for r in index.held(asked, "a_1").collect()} == {"x"}
    index.add("c_0", rows([("w",)], "meta_id string"))
    assert {r[0] for r in index.held(asked, "d_0").collect()} == {"w", "x", "y"}
