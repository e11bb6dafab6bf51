"""Updates that are merged on reading, against the plain upsert batch by batch."""

import random

import pytest

from tidemark.operators.upsert import upsert
from tidemark.sources import deltas
from tidemark.sources.levels import Levels

COLUMNS = ["k", "j", "value", "price", "source", "at"]
DDL = "k string, j int, value int, price double, source string, at int"
KEYS, UPDATED = ["k", "j"], ["value", "price"]


def _batch(rnd, rows):
    data = [
        (f"k{rnd.randint(0, 6)}", rnd.randint(0, 1), rnd.choice([None, 1, 2, 3]), rnd.choice([None, 0.5]), rnd.choice("abc"), n)
        for n in range(rnd.randint(1, 6))
    ]
    return rows(data, DDL).coalesce(1)


def _set(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def test_like_upsert_batch_by_batch(spark, rows, tmp_path):
    rnd, path, table = random.Random(3), str(tmp_path / "t"), rows([], DDL)
    for number in range(7):
        batch = _batch(rnd, rows)
        deltas.add_updates(batch, path, f"q_{number}", KEYS, UPDATED, ["at"], fan=3)
        table = spark.createDataFrame(upsert(table, batch, KEYS, UPDATED, ["at"]).collect(), DDL)
    assert _set(deltas.merged_table(spark, path, KEYS, COLUMNS)) == _set(table)
    assert any(r.level for r in Levels(spark, path).runs()) and len(Levels(spark, path).runs()) <= 4


def test_replay_interrupted_merge_and_null_keys(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def add(number, *data):
        deltas.add_updates(rows(list(data), DDL).coalesce(1), path, f"q_{number}", KEYS, UPDATED, ["at"], fan=2)

    add(0, ("a", 1, 1, 1.0, "first", 0), (None, None, 1, 1.0, "first", 0))
    add(1, ("a", 1, 9, 9.0, "wrong", 0))
    add(1, ("a", 1, None, 2.0, "second", 0), (None, None, 5, 5.0, "second", 0))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Levels, "compact", crash)
        with pytest.raises(RuntimeError, match="lost"):
            add(2, ("b", 1, 7, 7.0, "third", 0))
    add(2, ("b", 1, 8, 8.0, "third", 0))
    got = _set(deltas.merged_table(spark, path, KEYS, COLUMNS))
    assert got == sorted(
        [("a", 1, None, 2.0, "first", 0), (None, None, 5, 5.0, "first", 0), ("b", 1, 8, 8.0, "third", 0)], key=repr
    )
