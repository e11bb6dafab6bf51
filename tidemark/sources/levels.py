"""A store of runs that are merged level by level, so that readers open few folders.

Every batch adds a run of level 0. When a level has ``fan`` runs they are merged
into one of the next level, so n batches leave at most about fan * log(n) runs. A list
of the live runs is written last, in one file of two slots in turn: readers see the
store before or after a step, and a step that is cut short is made anew. Runs that a
merge or a replay has replaced stay until ``vacuum``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.stored import read_stored

LIST = "version bigint, level int, folder string, owner string, low bigint, high bigint, note bigint, live boolean"


@dataclass(frozen=True)
class Run:
    """A folder with the rows of batches low to high of each owner; ``note`` is a number kept with it."""

    level: int
    folder: str
    batches: tuple[tuple[str, int, int], ...]
    note: int | None = None

    def holds(self, batch: str) -> bool:
        owner, number = split_name(batch)
        return any(o == owner and low <= number <= high for o, low, high in self.batches)


def split_name(batch: str) -> tuple[str, int]:
    """Owner and number of a batch name, which ends with ``_`` and the number."""
    owner, number = batch.rsplit("_", 1)
    return owner, int(number)


def spans(batches: list[tuple[str, int, int]]) -> tuple[tuple[str, int, int], ...]:
    """One span per owner."""
    found: dict[str, tuple[int, int]] = {}
    for owner, low, high in batches:
        a, b = found.get(owner, (low, high))
        found[owner] = min(a, low), max(b, high)
    return tuple((owner, *span) for owner, span in sorted(found.items()))


def _save(rows: DataFrame, folder: str, level: int) -> None:
    rows.write.mode("overwrite").parquet(folder)


class Levels:
    """The store below ``path``, for one writer. ``save`` writes a run's rows, by default as one table.

    An object knows the store as of its first look and its own steps since; a new one
    sees what others have written.
    """

    def __init__(self, spark: SparkSession, path: str, fan: int = 8, save: Callable[[DataFrame, str, int], None] = _save):
        self.spark, self.path, self.fan, self.save = spark, path, fan, save
        self.known: tuple[int, list[Run], list[Run]] | None = None

    def _load(self) -> tuple[int, list[Run], list[Run]]:
        """The newest list: its version, the live runs oldest first, and those that were replaced."""
        if self.known is not None:
            return self.known
        slots = [read_stored(self.spark, f"{self.path}/_list/slot_{slot}", LIST) for slot in (0, 1)]
        rows = slots[0].unionByName(slots[1]).collect()
        version = max((r.version for r in rows), default=0)
        found: dict[bool, dict[str, Run]] = {True: {}, False: {}}
        for r in rows:
            if r.version == version:
                known = found[r.live].get(r.folder, Run(r.level, r.folder, (), r.note))
                found[r.live][r.folder] = replace(known, batches=spans([*known.batches, (r.owner, r.low, r.high)]))
        live = sorted(found[True].values(), key=lambda run: (-run.level, run.batches))
        self.known = version, live, list(found[False].values())
        return self.known

    def state(self) -> tuple[int, list[Run]]:
        """The version and its live runs; version 0 is an empty store."""
        return self._load()[:2]

    def runs(self) -> list[Run]:
        return self.state()[1]

    def swap(self, version: int, runs: list[Run], gone: list[Run]) -> None:
        """Make ``runs`` the live ones; ``gone`` are named for ``vacuum`` as long as the list stands."""
        rows = [
            (version, run.level, run.folder, *span, run.note, live)
            for some, live in ((runs, True), (gone, False))
            for run in some
            for span in run.batches
        ]
        self.spark.createDataFrame(rows, LIST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_list/slot_{version % 2}")
        self.known = version, sorted(runs, key=lambda run: (-run.level, run.batches)), gone

    def add(self, batch: str, rows: DataFrame, note: Callable[[], int | None] = lambda: None) -> Run:
        """Add a batch's rows as a run of level 0; an earlier one of the same batch is replaced.

        ``note`` is asked for when the rows are written.
        """
        version, runs, dead = self._load()
        owner, number = split_name(batch)
        # A folder of its own: what readers of the old list read stays as it is.
        run = Run(0, f"{self.path}/run-{batch}-{version + 1}", ((owner, number, number),))
        self.save(rows, run.folder, 0)
        run = replace(run, note=note())
        old = [r for r in runs if r.level == 0 and r.holds(batch)]
        self.swap(version + 1, [*(r for r in runs if r not in old), run], [*dead, *old])
        return run

    def replace(self, old: Run, rows: DataFrame, note: int | None = None) -> Run:
        """Put ``rows`` in the place of a run."""
        version, runs, dead = self._load()
        new = replace(old, folder=f"{self.path}/run-level{old.level}-{version + 1}", note=note)
        self.save(rows, new.folder, new.level)
        self.swap(version + 1, [new if r.folder == old.folder else r for r in runs], [*dead, old])
        return new

    def compact(self, combine: Callable[[DataFrame], DataFrame], note: Callable[[list[Run]], int | None] = lambda runs: None) -> int:
        """Merge full levels; the number of merges.

        The newest batch of each owner is the only one that can be replayed, so it
        stays a run of its own.
        """
        merges, level = 0, 0
        version, runs, dead = self._load()
        while True:
            if level > max((r.level for r in runs), default=-1):
                return merges
            newest = {o: max(high for r in runs for owner, _, high in r.batches if owner == o) for r in runs for o, _, _ in r.batches}
            ready = [r for r in runs if r.level == level and not (level == 0 and r.batches[0][2] == newest[r.batches[0][0]])]
            if len(ready) < self.fan:
                level += 1
                continue
            merged = Run(
                level + 1, f"{self.path}/run-level{level + 1}-{version + 1}", spans([b for r in ready for b in r.batches]), note(ready)
            )
            self.save(combine(self.read(ready)), merged.folder, merged.level)
            version, runs, dead = version + 1, [*(r for r in runs if r not in ready), merged], [*dead, *ready]
            self.swap(version, runs, dead)
            merges += 1

    def read(self, runs: list[Run] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The rows of the given runs or of all live ones; without any, an empty table of ``schema``."""
        chosen = self.runs() if runs is None else runs
        if not chosen:
            return self.spark.createDataFrame([], schema or T.StructType())
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        # One by one, as runs may have partition folders of their own.
        return reduce(DataFrame.unionByName, [reader.parquet(r.folder) for r in chosen])

    def vacuum(self) -> int:
        """Empty the folders of replaced runs, to be called while nothing reads the store; their number."""
        version, runs, dead = self._load()
        for run in dead:
            self.spark.createDataFrame([], "emptied boolean").write.mode("overwrite").parquet(run.folder)
        if dead:
            # Both slots are written, so that no list names an emptied folder.
            self.swap(version + 1, runs, [])
            self.swap(version + 2, runs, [])
        return len(dead)
